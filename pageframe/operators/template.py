"""Rendering data tables through HTML templates."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escape_html, interpolate


def values_map(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Row values as the string map the interpolation expects."""
    names = df.columns if columns is None else columns
    pairs = []
    for n in names:
        pairs += [F.lit(n), F.col(n).cast("string")]
    return F.create_map(*pairs)


def _fill(template: str, columns: list[str]) -> Column:
    """A template known at plan time is a plain concatenation of literals and escaped columns."""
    parts = []
    for piece in re.findall(r"\{[^{}]*\}|[^{]+|\{", template):
        known = piece[1:-1] in columns and piece[0] == "{"
        parts.append(F.coalesce(escape_html(F.col(piece[1:-1]).cast("string")), F.lit(piece)) if known else F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def render_rows(df: DataFrame, template: str | Column, columns: list[str] | None = None,
                escape: bool = True, name: str = "html", mode=None) -> DataFrame:
    """One rendered fragment per data row; a narrow projection, whatever the table size.

    ``mode`` sanitises each rendered fragment."""
    if isinstance(template, str) and escape:
        html = _fill(template, df.columns if columns is None else columns)
    else:
        template = template if isinstance(template, Column) else F.lit(template)
        html = interpolate(template, values_map(df, columns), escape)
    out = df.withColumn(name, html)
    return out if mode is None else sanitize_column(out, name, mode)


def sanitize_column(df: DataFrame, column: str, mode) -> DataFrame:
    """Sanitise a snippet column row by row: parse, filter, serialise as expressions, no shuffle; null stays null."""
    from .sanitize import sanitize_fragment
    from .serialize import fragment_html
    from .shred import fragment_nodes
    parsed = df.withColumn("_frag", fragment_nodes(F.col(column)))
    return sanitize_fragment(parsed, "_frag", mode).withColumn(
        column, F.when(F.col(column).isNotNull(), fragment_html("_frag"))).drop("_frag")


PART_ROWS = 10_000   # rows of one string where the caller names no page size


def render_groups(df: DataFrame, template: str | Column, group: list[str], order: list[str],
                  per_page: int | None = None, bucket: Column | None = None, header: str = "",
                  footer: str = "", columns: list[str] | None = None, escape: bool = True) -> DataFrame:
    """Rendered rows assembled per group in order: (group..., page_no, n_rows, html).

    ``per_page`` splits a group into pages of that many rows, each with header and footer.  Without it a group is one
    string, cut after every PART_ROWS rows: the header is on its first part, the footer on its last, and the parts in
    order of ``page_no`` are the whole.  Groups may have any size: see :func:`number_rows`.  ``bucket`` is no longer needed
    and not read."""
    rows = number_rows(render_rows(df, template, columns, escape, "_row").select(*group, *order, "_row"), group, order)
    size = PART_ROWS if per_page is None else per_page
    rows = rows.withColumn("page_no", F.expr(f"(_pos - 1) div {size}"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_row"))), lambda e: e["_row"]), "")
    pages = rows.groupBy(*group, "page_no").agg(F.count("*").alias("n_rows"), body.alias("html"), F.max("_total").alias("_total"))
    first = F.lit(True) if per_page else F.col("page_no") == 0
    last = F.lit(True) if per_page else F.col("page_no") == F.expr(f"(_total - 1) div {size}")
    whole = F.concat(F.when(first, header).otherwise(""), "html", F.when(last, footer).otherwise(""))
    return pages.select(*group, "page_no", "n_rows", whole.alias("html"))


def number_rows(rows: DataFrame, group: list[str], order: list[str], name: str = "_pos", total: str = "_total") -> DataFrame:
    """``rows`` with their exact 1-based position in the group and the group's size, whatever the size.

    Rows are laid out in ranges of (group, order), so a large group lies in many partitions; positions count within a
    partition and are shifted by the counts of the partitions before, one row per group and partition.  Equal keys are
    told apart by where they were read, so no key fills a partition.  Null groups are groups.

    Runs a job: the layout is written to the shared folder first, since positions and counts must see the same one."""
    from ..session import shared_table
    ranged = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*group, *order, "_at")
    laid = shared_table(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    by_group = Window.partitionBy(*group)
    counts = laid.groupBy(*group, "_part").agg(F.count("*").alias("_n")).withColumns({
        "_before": F.coalesce(F.sum("_n").over(by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        total: F.sum("_n").over(by_group)}).drop("_n")
    counts = counts.select(*[F.col(c).alias(f"_c_{c}") for c in (*group, "_part")], "_before", total)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in (*group, "_part")])
    numbered = laid.withColumn("_rn", F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order, "_at")))
    return numbered.join(counts, same).withColumn(name, F.col("_rn") + F.col("_before")).select(*rows.columns, name, total)
