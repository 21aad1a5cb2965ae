from __future__ import annotations

import random
from functools import reduce
from itertools import product

import pytest
from brute import cheapest_edits, damage, repair
from cases import prose

from pageframe.llm import conversations as C
from pageframe.llm.queries import QUERIES

FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "n_rows")
SCHEMA = "conv_id long, turn long, role string, text string, copies string, kind int, digest int, first string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "f") for r in rows], SCHEMA).repartition(5)


def expected(rows):
    return {conv: repair(after) for conv, after in damage(rows).items()}


def found(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[f] for f in FIELDS) for r in rows}
    assert len(out) == len(rows)
    return out


def sample(seed=3, conversations=150):
    rng, rows = random.Random(seed), []
    for conv in range(conversations):
        roles = (["system"] if rng.random() < 0.3 else []) + ["user", "assistant"] * rng.randint(1, 6)
        for turn, role in enumerate(roles):
            if rng.random() < 0.1:
                role = rng.choice(["user", "assistant", "system", "tool", "", None, "uncle"])
            text = rng.choice([prose(rng, 8), prose(rng, 5), "Yes.", "Yes.", "No", "", None, " \n", "Ends! \t"])
            rows.append((conv, rng.choice([turn] * 12 + [None, turn + 3, 1]), role, text))
    return rows


def test_cells_are_the_cheapest_of_all_edits():
    for n in range(4):
        for kinds in product(["s", "u", "a!", "-", "D1"], repeat=n):
            whole = C.Spans()
            for k in kinds:
                whole.add(k)
            assert C.best_edits(whole.cell()) == cheapest_edits(kinds), kinds


def test_cells_do_not_depend_on_the_cuts():
    rng = random.Random(1)
    for n in (5, 17, 70, 140):
        kinds = [rng.choice(["s", "u", "u!", "a", "a!", "-", "D1", "D3"]) for _ in range(n)]
        cells = [C.leaf(k) for k in kinds]
        spans = C.Spans()
        for k in kinds:
            spans.add(k)
        assert spans.cell() == list(reduce(C.joined, cells))
        if n <= 40:
            assert spans.cell() == list(C.chart(cells))


def test_conversations_match_brute_force(spark):
    rows = sample()
    assert found(C.repaired(table(spark, rows))) == expected(rows)


def test_long_and_hot_conversations(spark):
    rng = random.Random(9)
    long = [(1, t, rng.choice(["user", "assistant", "system"]), prose(rng, 6)) for t in range(900)]
    same = [(2, None, "user", "Again and again.")] * 700 + [(2, t, "user", "Again and again.") for t in range(300)]
    rows = long + same + [(3, 0, "user", "x" * 3_000_000 + " " * 300_000 + "."), (3, 1, "assistant", "Fine.")]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(C.repaired(table(spark, rows))) == expected(rows)
        assert C.spans(C.distinct_rows(C.damaged(table(spark, rows)))).where("conv_id = 1").count() > 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("rows", [
    [], [(None, None, None, None)] * 3, [(None, 1, "user", "A."), (5, None, "user", "B."), (5, None, "assistant", "C."), (5, None, None, "")],
    [(c, 0, "user", "Hi.") for c in range(60)], [(7, 2**62, "user", "Far."), (7, -2**62, "assistant", "Away.")],
    [(1, 0, "user", "é̂.!? "), (1, 0, "user", "é̂.!? "), (1, 1, "assistant", "\x00\x0b\x0c")]])
def test_odd_tables(spark, rows):
    assert found(C.repaired(table(spark, rows))) == expected(rows)


def test_query(spark):
    data = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_interval_repair"](spark, data)) == expected(rows)
