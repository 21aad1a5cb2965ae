"""Corpus queries: links, style text, main text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.node import attr_value
from .select import _flag, in_scope
from .text import text_content
from .tokens import token_array, token_attrs


def remove_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments: an ordered fold over the segments, ``..`` taking the last one away.

    ``..`` at the root stays there; a last segment of dots leaves the folder with its closing slash."""
    steps = F.filter(F.split(path, "/"), lambda s, i: (i > 0) | (s != ""))
    rooted = path.startswith("/")

    def fold(done, s):
        return (F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
                .when(s == ".", done).otherwise(F.array_append(done, s)))

    kept = F.aggregate(steps, F.array().cast("array<string>"), fold)
    ends = F.get(steps, F.size(steps) - 1).isin(".", "..")
    joined = F.concat(F.when(rooted, "/").otherwise(""), F.array_join(kept, "/"))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(joined, F.when(ends & (F.size(kept) > 0), "/").otherwise(""))).otherwise(path)


def resolve(href: Column, base: Column) -> Column:
    """Absolute form of a link on a page with this address, as RFC 3986 resolves references.

    A link with a scheme stays as it is; ``//`` takes the scheme, ``/`` the host, other paths the folder of the base;
    dot segments are removed; a query or fragment alone keeps the base's path (and query); an empty link is the base
    without its fragment."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^([^?#]*)", 1)
    own = F.regexp_extract(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(.*)$", 1)
    folder = F.when(own == "", "/").otherwise(F.regexp_replace(own, r"[^/]*$", ""))
    given, rest = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"(?s)^[^?#]*(.*)$", 1)
    host, below = F.regexp_extract(given, r"^(//[^/]*)", 1), F.regexp_extract(given, r"^//[^/]*(.*)$", 1)
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), host, remove_dots(below), rest))
        .when(href.startswith("/"), F.concat(origin, remove_dots(given), rest))
        .when(href.startswith("#") | (href == ""), F.concat(F.regexp_replace(base, r"(?s)#.*$", ""), href))
        .when(href.startswith("?"), F.concat(path, href))
        .otherwise(F.concat(origin, remove_dots(F.concat(folder, given)), rest))
    )


def host_of(url: Column) -> Column:
    """Host of an absolute URL, null when there is none; tolerates characters strict parsers reject."""
    host = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.when(host != "", F.lower(host))


BASE = "tag = 'base' AND tree_id = 0 AND exists(attrs, a -> a.name = 'href')"


def links(nodes: DataFrame, pages: DataFrame | None = None, text: bool = True,
          selector: str = "a[href]", scope: str = "body") -> DataFrame:
    """page_id, node_id, pre, href (link text); resolved target and host where the page's address is known.

    The address comes on the node rows (``shred(pages, carry=["url"])``): one pass.  ``pages`` joins it instead, for
    stored nodes without it.  The first ``<base href>`` of a page, itself resolved against the address, is what its
    links are resolved against."""
    known = "url" in nodes.columns or pages is not None
    if "url" not in nodes.columns and pages is not None:
        nodes = nodes.join(pages.select("page_id", "url"), "page_id")
    carried = ["url", "_base"] if known else []
    base = F.expr(BASE)
    hits = _flag(nodes, selector, "_link", prune=not text, also=base if known else None)
    if known:
        first = F.min_by(F.when(base, attr_value("href")), F.when(base, F.col("pre")))
        hits = hits.withColumn("_base", first.over(Window.partitionBy("page_id")))
    hits = hits.withColumn("_link", F.col("_link") & in_scope(scope))
    if text:
        sel = text_content(hits, F.col("_link")).withColumnRenamed("text_content", "link_text")
    else:
        sel = hits.filter("_link")
    out = sel.select("page_id", "node_id", "pre", attr_value("href").alias("href"), *(["link_text"] if text else []), *carried)
    if not known:
        return out
    against = F.when(F.col("_base").isNull(), F.col("url")).otherwise(resolve(F.col("_base"), F.col("url")))
    out = out.withColumn("target", resolve(F.col("href"), against))
    return out.withColumn("host", host_of(F.col("target"))).drop(*carried)


def token_links(pages: DataFrame) -> DataFrame:
    """(page_id, url, pos, href) of every ``<a href>`` start tag, straight from tokens: no tree, no
    Python, no shuffle."""
    raw = F.posexplode(F.filter(token_array(F.col("html")), lambda t: t.rlike(r"(?i)^<a(?=[\s/>])")))
    return (pages.select("page_id", "url", "html").select("page_id", "url", raw.alias("pos", "raw"))
            .select("page_id", "url", "pos", attr_value("href", token_attrs(F.col("raw"))).alias("href"))
            .filter("href is not null"))


def link_graph(pages: DataFrame) -> DataFrame:
    """Host-to-host edges with link counts, pre-aggregated before the shuffle."""
    edges = token_links(pages).select(
        host_of(F.col("url")).alias("from_host"), host_of(resolve(F.col("href"), F.col("url"))).alias("to_host"))
    return edges.groupBy("from_host", "to_host").agg(F.count("*").alias("n_links"))


def style_text(nodes: DataFrame, tag: str = "style", scope: str = "document") -> DataFrame:
    """Text of STYLE or SCRIPT elements."""
    found = (F.col("tag") == tag.lower()) & (F.col("node_type") == "element") & in_scope(scope)
    return text_content(nodes, found).select("page_id", "node_id", "pre", "tag", F.col("text_content").alias("text"))


def main_text(nodes: DataFrame) -> DataFrame:
    """One row per page: title, first heading and article text."""
    texts = text_content(nodes, "title, h1, article")
    first = lambda tag: F.min_by(F.when(F.col("tag") == tag, F.col("text_content")),
                                 F.when(F.col("tag") == tag, F.col("pre")))
    return texts.groupBy("page_id").agg(
        first("title").alias("title"), first("h1").alias("heading"), first("article").alias("article"))
