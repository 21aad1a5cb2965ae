"""Text content, comments, and the page-array helper text and markup extraction share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_pages_of(nodes: DataFrame, where, entry: Column, value, name: str) -> DataFrame:
    """Selected rows plus a value computed from the whole page, in one aggregation.

    ``entry`` is collected for every node of the page; ``value(hit, entries)`` turns one selected
    row and the page's entries into the new column.  Selected rows stay inside the page row until
    the value is built, so the page array is never copied per selection."""
    from .rewrite import mark
    marked = mark(nodes, where)
    carried = [c for c in marked.columns if c not in ("page_id", "_hit")]
    pages = marked.groupBy("page_id").agg(
        F.collect_list(entry).alias("_page"),
        F.collect_list(F.when(F.col("_hit"), F.struct(*carried))).alias("_hits"))
    return pages.filter(F.size("_hits") > 0).select("page_id", F.sort_array("_page").alias("_page"), "_hits").select(
        "page_id", F.inline(F.transform("_hits", lambda h: F.struct(
            *[h[c].alias(c) for c in carried], value(h, F.col("_page")).alias(name)))))


def text_content(nodes: DataFrame, where, dense: bool = True) -> DataFrame:
    """The rows ``where`` selects plus ``text_content``: descendant text in order, comments and nested template
    contents left out.  Text and comment nodes yield their own data.

    ``dense=False`` takes nodes whose numbers have gaps, as removals leave them with ``reindex=False``: a selected row then
    looks through its page's texts for those in its interval, where it otherwise takes a slice."""
    entry = F.struct("pre", "tree_id", F.when(F.col("node_type") == "text", F.col("text")).alias("s"))

    def text(h, page):
        inside = lambda x: (x["pre"] >= h["pre"]) & (x["pre"] <= h["last"])
        part = F.slice(page, h["pre"] + 1, h["last"] - h["pre"] + 1) if dense else F.filter(page, inside)
        mine = F.filter(part, lambda x: (x["tree_id"] == h["tree_id"]) & x["s"].isNotNull())
        return F.when(h["node_type"].isin("text", "comment"), h["text"]).otherwise(
            F.array_join(F.transform(mine, lambda x: x["s"]), ""))

    return read_pages_of(nodes, where, entry, text, "text_content")


def comment_content(nodes: DataFrame) -> DataFrame:
    return nodes.filter((F.col("node_type") == "comment") & (F.col("tree_id") == 0)).select(
        "page_id", "node_id", "pre", "text")
