"""Sharding: a uniform shuffle with exact shard sizes, from a hypergeometric communication matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from pageframe.llm.common import saved, without

PIECE_ROWS = 1_000_000   # rows that are ordered together inside a shard


def _uniform(*parts) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def hypergeometric(draws: str, good: str, total: str, u: str) -> str:
    """SQL for the number of good items among `draws` of `total` without replacement, at quantile `u`.

    The distribution is walked over its support within nine standard deviations of the mean (all of it
    when that is narrower): weights relative to the first value follow from the ratio of neighbours, and
    the answer is the first value at which their sum reaches u times the whole.
    """
    mean = f"({draws} * ({good} / {total}))"
    reach = f"(9D * sqrt(greatest(0D, {mean} * (1 - {good} / {total}) * ({total} - {draws}) / greatest({total} - 1, 1))) + 9)"
    low = f"greatest(0L, {draws} - ({total} - {good}), cast(floor({mean} - {reach}) as bigint))"
    high = f"least({draws}, {good}, cast(ceil({mean} + {reach}) as bigint))"
    ratio = f"((cast({good} - x as double) * ({draws} - x)) / (cast(x + 1 as double) * ({total} - {good} - {draws} + x + 1)))"
    steps = f"if(r.low < r.high, sequence(r.low, r.high - 1), array())"
    whole = (f"aggregate({steps}, named_struct('w', 1D, 's', 1D), (a, x) -> named_struct('w', a.w * {ratio}, "
             f"'s', a.s + a.w * {ratio}), a -> a.s)")
    pick = (f"aggregate({steps}, named_struct('w', 1D, 's', 1D, 'v', r.low), (a, x) -> named_struct('w', a.w * {ratio}, "
            f"'s', a.s + a.w * {ratio}, 'v', if(a.s < r.goal, x + 1, a.v)), a -> a.v)")
    bounds = f"transform(array(named_struct('low', {low}, 'high', {high})), r -> named_struct('low', r.low, 'high', r.high, 'goal', {u} * {whole}))"
    return f"if({total} = 0, 0L, transform({bounds}, r -> {pick})[0])"


def communication_matrix(counts: DataFrame, shards: int, blocks: int, seed: int = 0) -> DataFrame:
    """(block, cells, total): how many rows each block sends to each shard, drawn as a uniform shuffle would.

    `counts` holds (block, n).  Shards get sizes that differ by one at most.  The matrix is drawn by
    halving: a node of the tree knows the sizes of its blocks and how many rows of each shard they
    hold; the left half's share is a multivariate hypergeometric draw, shard after shard, and the right
    half keeps the rest.  Every level deals its nodes out to as many tasks as it has nodes, up to the cores of the
    cluster, and draws once a node; the first levels have few nodes and long draws, the cost of a level grows with the
    root of its nodes.  The list of block sizes, one number a block, is in one row at the root only.
    """
    listed = counts.agg(F.array_sort(F.collect_list(F.struct("block", "n"))).alias("blocks"),
                        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"))
    sizes = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                        lambda j: F.expr(f"total div {shards}") + F.when(j < F.col("total") % shards, 1).otherwise(0))
    nodes = listed.select("blocks", "total", sizes.cast("array<bigint>").alias("cells"))
    draw = hypergeometric("s.want", "cells[j]", "s.rest", "chance[j]")
    share = (f"aggregate(sequence(0, {shards - 1}), named_struct('want', want, 'rest', held, 'got', cast(array() as array<bigint>)), "
             f"(s, j) -> transform(array({draw}), x -> named_struct('want', s.want - x, 'rest', s.rest - cells[j], "
             f"'got', concat(s.got, array(x))))[0], s -> s.got)")
    level, width, cores = 0, 1, max(2, counts.sparkSession.sparkContext.defaultParallelism)
    while width < blocks:
        half = F.expr("cast(ceil(size(blocks) / 2) as int)")
        chance = F.array(*[_uniform(F.lit(seed), F.lit(level), F.col("blocks")[0]["block"], F.lit(j)) for j in range(shards)])
        nodes = (nodes.withColumn("left_blocks", F.slice("blocks", F.lit(1), half))
                 .withColumn("want", F.aggregate("left_blocks", F.lit(0).cast("long"), lambda a, b: a + b["n"]))
                 .withColumn("held", F.aggregate("cells", F.lit(0).cast("long"), lambda a, b: a + b))
                 .withColumn("chance", chance)
                 .withColumn("left_cells", F.expr(share)).drop("chance", "want", "held")
                 .repartition(min(2 * width, cores), F.col("blocks")[0]["block"])     # a draw is made before the shuffle, once
                 .withColumn("node", F.explode(F.expr(
                     "if(size(blocks) > 1, array(named_struct('blocks', left_blocks, 'cells', left_cells), "
                     "named_struct('blocks', slice(blocks, size(left_blocks) + 1, size(blocks)), "
                     "'cells', zip_with(cells, left_cells, (c, l) -> c - l))), array(named_struct('blocks', blocks, 'cells', cells)))")))
                 .select("node.blocks", "total", "node.cells"))
        level, width = level + 1, 2 * width
    return nodes.where("size(blocks) = 1").select(F.col("blocks")[0]["block"].alias("block"), "cells", "total")


def shuffle(df: DataFrame, shards: int, *, seed: int = 0, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """All columns of `df` and shard (0 to shards - 1) and slot (gapless from 0 in its shard).

    1. Blocks are the partitions that `df` arrives in; rows get a number when they are written once, so
       that a lost executor can't change an order already drawn.
    2. `communication_matrix` fixes how many rows every block sends to every shard.
    3. Each block is permuted by a hash of row number and seed, and cut at its row of the matrix.
    4. Each shard is permuted again by another hash, in pieces of about `piece_rows` rows: a row's slot is
       the rows in earlier pieces and its rank in its own.  No shard is ever one task's work.

    Every order of rows over slots is equally likely, as far as the hashes are random, and shard sizes
    differ by one at most.  DataFrame functions only.  Texts move only if `df` carries them: project
    first.  Columns named shard or slot are replaced; null and repeated rows are rows like any other;
    an empty table gives an empty table.
    """
    base = without(df, "shard", "slot")
    rows = saved(base.select(F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("_row"))
                 .withColumn("_at", F.monotonically_increasing_id()), "rows")
    blocked = rows.withColumn("block", F.shiftright("_at", 33))
    counts = saved(blocked.groupBy("block").agg(F.count("*").alias("n")), "counts")
    matrix = saved(communication_matrix(counts, shards, counts.count(), seed), "matrix")
    local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "_at"), "_at")
    ends = F.expr(f"transform(sequence(1, {shards}), j -> aggregate(slice(cells, 1, j), 0L, (a, c) -> a + c))")
    rank = F.row_number().over(local)
    dealt = (blocked.withColumn("_rank", rank).join(matrix.withColumn("ends", ends), "block")
             .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("_rank"))))
             .withColumn("_key", F.xxhash64(F.lit(seed), F.lit("shard"), "_at"))
             .withColumn("_piece", F.expr(f"cast(floor(shiftrightunsigned(_key, 11) / {float(1 << 53)}D * "
                                          f"ceil(total / {shards * piece_rows}D)) as int)")))
    dealt = saved(dealt.select("_row", "_at", "shard", "_key", "_piece"), "dealt")
    earlier = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (dealt.groupBy("shard", "_piece").agg(F.count("*").alias("n"))
              .select("shard", "_piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    inside = Window.partitionBy("shard", "_piece").orderBy("_key", "_at")
    placed = dealt.withColumn("_slot", F.row_number().over(inside) - 1).join(pieces, ["shard", "_piece"])
    return placed.select("_row.*", "shard", (F.col("before") + F.col("_slot")).cast("long").alias("slot"))
