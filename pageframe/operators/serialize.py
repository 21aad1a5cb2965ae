"""Nodes back to HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.node import VOID_TAGS
from ..functions.text import attr_value_sql, text_node_sql

# --- fixed values: elements written without an end tag -------------------------------------------
NO_END_TAG = VOID_TAGS + "basefont bgsound frame keygen param".split()
# -------------------------------------------------------------------------------------------------


def _open(at: str) -> str:
    attr = ("concat(' ', a.name, CASE WHEN a.value IS NULL THEN '' ELSE concat('=\"', " + attr_value_sql("a.value")
            + ", '\"') END)")
    return f"""CASE {at}node_type
        WHEN 'element' THEN concat('<', {at}tag, array_join(transform({at}attrs, a -> {attr}), ''), '>')
        WHEN 'text' THEN CASE WHEN {at}raw_text THEN {at}text ELSE {text_node_sql(at + "text")} END
        WHEN 'comment' THEN concat('<!--', {at}text, '-->')
        WHEN 'doctype' THEN concat('<!DOCTYPE ', {at}text, '>') ELSE '' END"""


def _close(at: str) -> str:
    bare = ", ".join(f"'{t}'" for t in NO_END_TAG)
    return (f"CASE WHEN {at}node_type = 'element' AND NOT ({at}ns = 'html' AND {at}tag IN ({bare})) "
            f"THEN concat('</', {at}tag, '>') ELSE '' END")


def _events(at: str = "") -> str:
    """Open and close markup of one node; event order is 2*pre-depth and 2*last-depth+1."""
    return (f"array(named_struct('k', 2 * {at}pre - {at}depth, 'piece', {_open(at)}), "
            f"named_struct('k', 2 * {at}last - {at}depth + 1, 'piece', {_close(at)}))")


def fragment_html(fragment: str) -> Column:
    """HTML of a fragment column (array of node structs)."""
    return F.expr(f"array_join(transform(array_sort(flatten(transform({fragment}, f -> {_events('f.')}))), e -> e.piece), '')")


def _pieces(events: Column) -> Column:
    return F.transform(F.array_sort(F.flatten(events)), lambda e: e["piece"])


def to_html(nodes: DataFrame, pages: DataFrame | None = None, html: str = "html", key: str = "page_id",
            errors: bool = False) -> DataFrame:
    """Whole pages: (page_id, html), doctype and document-level comments included.

    A page that failed to shred has null html, and its reason in ``error`` when ``errors`` asks for that
    column.  ``nodes`` alone know only pages with nodes left; given the ``pages`` (or snippets) they come
    from, the result has one row for each: '' where all nodes are gone, null where ``html`` was null.

    Works on any order-consistent numbering, so deletions need no renumbering first."""
    failed = F.max(F.when(F.col("node_type") == "error", F.col("text")))
    built = nodes.groupBy("page_id").agg(
        F.array_join(_pieces(F.collect_list(F.expr(_events()))), "").alias("html"), failed.alias("error"))
    built = built.withColumn("html", F.when(F.col("error").isNull(), F.col("html")))
    if pages is not None:
        source = pages.select(F.col(key).alias("page_id"), F.col(html).isNotNull().alias("_given"))
        whole = F.when(F.col("_given") & F.col("error").isNull(), F.coalesce("html", F.lit("")))
        built = source.join(built, "page_id", "left").withColumn("html", whole)
    return built.select("page_id", "html", *(["error"] if errors else []))


def _part(nodes: DataFrame, where, name: str, inner: bool) -> DataFrame:
    from .rewrite import mark
    marked = mark(nodes, where)
    carried = [c for c in marked.columns if c not in ("page_id", "_hit")]
    pages = marked.groupBy("page_id").agg(
        F.collect_list(F.expr(_events())).alias("_e"),
        F.collect_list(F.when(F.col("_hit"), F.struct(*carried))).alias("_hits"))
    pages = pages.filter(F.size("_hits") > 0).select("page_id", _pieces(F.col("_e")).alias("_p"), "_hits")

    def cut(h):
        lo = 2 * h["pre"] - h["depth"] + (2 if inner else 1)
        return F.array_join(F.slice("_p", lo, 2 * (h["last"] - h["pre"]) + (0 if inner else 2)), "")

    return pages.select("page_id", F.inline(F.transform("_hits", lambda h: F.struct(
        *[h[c].alias(c) for c in carried], cut(h).alias(name)))))


def outer_html(nodes: DataFrame, where) -> DataFrame:
    """Selected rows plus ``outer_html``."""
    return _part(nodes, where, "outer_html", inner=False)


def inner_html(nodes: DataFrame, where) -> DataFrame:
    """Selected rows plus ``inner_html``: text when there are no child elements, '' when empty."""
    return _part(nodes, where, "inner_html", inner=True)


def inner_template_html(nodes: DataFrame, where=None, first_only: bool = False) -> DataFrame:
    """HTML of template contents; ``first_only`` keeps only the first content node."""
    is_template = (F.col("tag") == "template") & (F.col("ns") == "html")
    if not first_only:
        found = inner_html(nodes, is_template if where is None else where)
        return found.filter(is_template).withColumnRenamed("inner_html", "template_html")
    first = (F.col("tree_id") > 0) & F.col("parent_id").isNull() & (F.col("sib_idx") == 1)
    return outer_html(nodes, first).select("page_id", F.col("owner_id").alias("node_id"),
                                           F.col("outer_html").alias("template_html"))


def outline(nodes: DataFrame) -> DataFrame:
    """Document structure as rows (sort by page_id, pre when printing)."""
    return nodes.filter(F.col("tree_id") == 0).select(
        "page_id", "pre", "depth", F.coalesce("tag", F.concat(F.lit("#"), "node_type")).alias("name"))
