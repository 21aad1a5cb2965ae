"""HTML strings to node rows: one distributed pass, everything after it is relational."""

from __future__ import annotations

import gc
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions.node import attr_sql, classes_sql
from ..schema import KERNEL_NODE, NODE_COLUMNS
from .tokens import token_array
from .treebuild import build_rows

_INT, _STR, _BOOL = pa.int32(), pa.string(), pa.bool_()
_ARROW = {T.IntegerType(): _INT, T.StringType(): _STR, T.BooleanType(): _BOOL}
_ATTR_AT = KERNEL_NODE.fieldNames().index("attrs")
FRAGMENT_CONTEXTS = frozenset(
    "fragment body div template table tbody tr select ul ol dl fieldset details optgroup map figure "
    "form video audio picture head custom".split())


def _error_row(message):
    row = {"tree_id": 0, "node_id": 0, "pre": 0, "last": 0, "depth": 0, "node_type": "error", "text": message}
    return tuple([] if n == "attrs" else row.get(n) for n in KERNEL_NODE.fieldNames())


def _attr_column(lists):
    offsets, n = [0], 0
    for attrs in lists:
        n += len(attrs)
        offsets.append(n)
    flat = list(chain.from_iterable(lists))
    pairs = pa.StructArray.from_arrays(
        [pa.array([a for a, _ in flat], _STR), pa.array([v for _, v in flat], _STR)], ["name", "value"])
    return pa.ListArray.from_arrays(pa.array(offsets, _INT), pairs)


def _kernel(tokens: pa.Array, fragment: bool) -> pa.Array:
    rows, offsets, memo = [], [0], {}
    gc.disable()   # nodes live exactly as long as the batch: scanning them meanwhile is wasted
    for page in tokens.to_pylist():
        if page is None:
            if not fragment:
                rows.append(_error_row("page is null"))
        else:
            try:
                rows.extend(build_rows(page, fragment, memo))
            except Exception as e:  # one bad page must not fail the job
                rows.append(_error_row(f"{type(e).__name__}: {e}"))
        offsets.append(len(rows))
    gc.enable()
    columns = list(zip(*rows)) or [[] for _ in KERNEL_NODE.fields]
    arrays = [
        _attr_column(c) if i == _ATTR_AT else pa.array(c, _ARROW[f.dataType])
        for i, (c, f) in enumerate(zip(columns, KERNEL_NODE.fields))
    ]
    structs = pa.StructArray.from_arrays(arrays, KERNEL_NODE.fieldNames())
    return pa.ListArray.from_arrays(pa.array(offsets, _INT), structs)


@arrow_udf(T.ArrayType(KERNEL_NODE))
def _page_tree(tokens: pa.Array) -> pa.Array:
    return _kernel(tokens, False)


@arrow_udf(T.ArrayType(KERNEL_NODE))
def _fragment_tree(tokens: pa.Array) -> pa.Array:
    return _kernel(tokens, True)


def with_derived(nodes: DataFrame) -> DataFrame:
    """Add the ``id`` and ``classes`` columns computed from ``attrs``."""
    return nodes.withColumns({"id": F.expr(attr_sql("id")), "classes": F.expr(classes_sql())})


def fragment_nodes(html: Column) -> Column:
    """Parse a snippet column as template content: array of node structs, no html/head/body;
    null snippets stay null."""
    return _fragment_tree(token_array(html))


NODE_BYTES = 500   # of markup, weigh as much as one more node row


def node_estimate(pages: DataFrame, html: str = "html") -> int:
    """About the number of node rows of the pages, by their ``<``; long texts and values count as more rows, by their bytes.
    Runs a job that reads the column."""
    text = F.col(html)
    tags = F.length(text) - F.length(F.replace(text, F.lit("<")))
    one = F.coalesce(tags + F.floor(F.octet_length(text) / NODE_BYTES), F.lit(0)) + F.lit(5).cast("long")
    return pages.agg(F.sum(one)).first()[0] or 0


def _explode_nodes(source: DataFrame, nodes, cluster: bool, sanitize, reindex, *extra, carry=(), partitions=None) -> DataFrame:
    out = source.select("page_id", *carry, F.inline(nodes))
    if cluster:
        out = out.repartition(partitions, "page_id") if partitions else out.repartition("page_id")
    out = with_derived(out).select("page_id", *NODE_COLUMNS, *carry, *extra)
    if sanitize is not None:
        from .sanitize import sanitize as run
        out = run(out, sanitize, reindex)
    return out


def shred(pages: DataFrame, html: str = "html", cluster: bool = True, sanitize=None,
          reindex: bool = True, carry: tuple | list = (), partitions: int | None = None) -> DataFrame:
    """Shred pages(page_id, html) into the ``nodes`` table.

    ``carry`` names columns of the page that come along on its node rows (``url`` for links), instead of a
    join back to the pages; row filters reach below the shuffle, so they travel on the rows that are needed.
    ``cluster`` distributes the node rows by page_id once, after the kernel, so that column pruning
    and row filters of the query reach below that shuffle; every page-keyed window, aggregate and
    join on top runs without another exchange.  Switch it off when only row-local operators follow.
    ``partitions`` is the number of parts it makes, which keeps what one task sorts within bounds on large inputs
    (``session.tasks_for(spark, node_estimate(pages))``); without it Spark chooses by the bytes shuffled.
    """
    taken = [c for c in carry if c in NODE_COLUMNS or c == "page_id"]
    if taken:
        raise ValueError(f"carried columns must not be named as node columns: {taken}")
    source = pages.select("page_id", *carry, F.col(html).alias("_html"))
    return _explode_nodes(source, _page_tree(token_array(F.col("_html"))), cluster, sanitize, reindex, carry=carry,
                          partitions=partitions)


def shred_fragments(df: DataFrame, html: str, context: str = "body", key: str = "page_id",
                    cluster: bool = True, sanitize=None, reindex: bool = True, partitions: int | None = None) -> DataFrame:
    """Shred a column of HTML snippets; every row of ``df`` becomes one tree keyed by ``key``.

    All contexts parse as template content; the name is validated and kept for provenance.
    """
    if context not in FRAGMENT_CONTEXTS:
        raise ValueError(f"unknown fragment context: {context}")
    source = df.select(F.col(key).alias("page_id"), F.col(html).alias("html"))
    return _explode_nodes(source, fragment_nodes(F.col("html")), cluster, sanitize, reindex, F.lit(context).alias("context"),
                          partitions=partitions)


def nodes_ok(nodes: DataFrame) -> DataFrame:
    return nodes.filter(F.col("node_type") != "error")


def shred_errors(nodes: DataFrame) -> DataFrame:
    return nodes.filter(F.col("node_type") == "error").select("page_id", F.col("text").alias("error"))


def document_root(nodes: DataFrame) -> DataFrame:
    return nodes.filter((F.col("tag") == "html") & (F.col("depth") == 0))


def body(nodes: DataFrame) -> DataFrame:
    return nodes.filter((F.col("tag") == "body") & (F.col("depth") == 1) & (F.col("tree_id") == 0))


def attributes(nodes: DataFrame) -> DataFrame:
    """One row per attribute with its ordinal; no cap on the number of attributes."""
    return (
        nodes.select("page_id", "tree_id", "node_id", "pre", "tag", "in_svg",
                     F.posexplode("attrs").alias("ordinal", "attr"))
        .select("page_id", "tree_id", "node_id", "pre", "tag", "in_svg", "ordinal",
                F.col("attr.name").alias("name"), F.col("attr.value").alias("value"))
    )


def templates(nodes: DataFrame) -> DataFrame:
    return nodes.filter((F.col("tag") == "template") & (F.col("ns") == "html"))


def template_content(nodes: DataFrame) -> DataFrame:
    """Rows inside template contents; ``owner_id`` names the template, top level has no parent."""
    return nodes.filter(F.col("tree_id") > 0)
