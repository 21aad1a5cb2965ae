"""Queries whose markup varies from row to row, and runs of real streams and stores over the corpus."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import node as N
from ..operators import audit, links, rewrite, sanitize, select, serialize, shred, template
from ..sources import pages as P
from ..streaming import chunks as stream
from .oracles import ORACLES as KNOWN


def _part_size(spark: SparkSession, sf: str) -> int:
    """About the node rows of the parts' markup: at most a dozen each, head and body included."""
    return 12 * session.tune(spark).read.parquet(f"{sf}/part.parquet").count()


def _part_tasks(spark: SparkSession, sf: str) -> int | None: return session.tasks_for(spark, _part_size(spark, sf))


def _parts(spark: SparkSession, sf: str, *cases: str) -> DataFrame:
    """page_id, html: one of the markups (SQL expressions) by the part's size."""
    choice = " ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(cases))
    part = session.spread(session.tune(spark).read.parquet(f"{sf}/part.parquet"), _part_size(spark, sf), "p_partkey", "p_name")
    return part.selectExpr("p_partkey AS page_id", f"CASE p_size % {len(cases)} {choice} END AS html")


def _cases(*results: str) -> str:
    choice = " ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(results))
    return f"CASE p_size % {len(results)} {choice} END"


def _clean(source: DataFrame, tasks: int | None, mode="strict") -> DataFrame:
    return serialize.to_html(shred.shred_fragments(source, "html", sanitize=mode, reindex=False, partitions=tasks), source)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{session.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _drained(rows: DataFrame, name: str, state: bool = False) -> DataFrame:
    """Run a stream to the end of its input and read what it wrote."""
    spark = rows.sparkSession
    root = _folder(spark, name)
    query = (rows.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


def _page_stream(spark: SparkSession, sf: str) -> DataFrame:
    return P.stream_table(session.tune(spark), f"{sf}/pages.parquet")


def sanitize_emptied(spark, sf):
    """Snippets that are emptied, empty, null or kept: one row each, in the tree form and in the column form."""
    source = _parts(spark, sf, "'<script>x</script>'", "''", "NULL", "concat('<p>', p_name)")
    local = template.sanitize_column(source, "html", "strict").select("page_id", F.col("html").alias("by_column"))
    return _clean(source, _part_tasks(spark, sf)).join(local, "page_id").select("page_id", F.col("html").alias("by_tree"), "by_column")


def sanitize_iframes(spark, sf):
    return _clean(_parts(
        spark, sf, "concat('<iframe sandbox src=\"https://example.com/', p_partkey, '\">', p_name, '</iframe>')",
        "concat('<iframe src=\"https://example.com/\">', p_name, '</iframe>')",
        "concat('<p>', p_name, '</p><iframe sandbox src=\" Java\tScript:1\"></iframe>')",
        "concat('<iframe sandbox>', p_name, '</iframe>')"), _part_tasks(spark, sf))


def sanitize_unlisted(spark, sf):
    return _clean(_parts(spark, sf, "concat('<blink>', p_name, '</blink><p>', p_type, '</p>')", "concat('<object>', p_name, '</object>')",
                         "concat('<embed src=x><b>', p_name, '</b>')", "concat('<p>', p_name, '<g>', p_type, '</g></p>')"), _part_tasks(spark, sf))


def sanitize_templates(spark, sf):
    return _clean(_parts(spark, sf, "concat('<template><p onclick=\"x\">', p_name, '</p><script>s</script></template>')",
                         "concat('<template><li><a href=\"javascript:1\">', p_type, '</a></li></template>')",
                         "concat('<template><!-- ', p_name, ' --></template><p>', p_type, '</p>')"), _part_tasks(spark, sf))


def element_flags(spark, sf):
    n = shred.shred_fragments(_parts(
        spark, sf, "concat('<pre>', p_name, '</pre>')", "concat('<script>', p_name, '</script>')",
        "concat('<textarea id=\"t\" rows=\"2\">', p_name, '</textarea>')", "concat('<p lang=\"en\">', p_name, '</p>')",
        "concat('<style>', p_name, '</style>')"), "html", cluster=False).where("node_type = 'element'")
    return n.select("page_id", "tag", N.preserves_whitespace().alias("preserves"), N.is_raw_text().alias("raw"),
                    N.has_attributes().alias("any_attribute"), N.has_attribute("lang").alias("has_lang"))


def name_tests(spark, sf):
    n = shred.shred_fragments(_parts(spark, sf, "concat('<p id=\"', p_brand, '\">x</p>')", "concat('<X-Card id=\"', p_type, '\">x</X-Card>')",
                                     "'<blink>x</blink>'"), "html", cluster=False).where("node_type = 'element'")
    return n.select("page_id", N.known_tag().alias("known"), N.is_custom_element().alias("custom"), N.matches_tag("P").alias("is_p"),
                    N.element_id().alias("element_id"), N.has_element_id("Brand#2").alias("has_brand_2"),
                    N.string_equals(N.element_id(), F.lit("SMALL")).alias("is_small"))


def audit_verdicts(spark, sf):
    n = shred.shred_fragments(_parts(spark, sf, "concat('<a title=\"', p_name, '\">x</a>')", "concat('<a target=\"', p_name, '\">x</a>')",
                                     "concat('<a zzz', p_size, '=\"1\">x</a>')", "concat('<a onclick=\"', p_name, '\">x</a>')"), "html", cluster=False)
    return audit.audit_attributes(n).select("page_id", "attr", "verdict")


def append_parsed(spark, sf):
    source = _parts(spark, sf, "concat('<ul><li>', p_name, '</ul>')", "'<ul></ul>'", "concat('<ol></ol><ul><!--', p_type, '--></ul>')")
    items = shred.fragment_nodes(F.concat(F.lit("<li>"), F.col("page_id").cast("string"), F.lit("<li>last")))
    tasks = _part_tasks(spark, sf)
    n = rewrite.append_fragment(shred.shred(source, partitions=tasks), "ul", items, tasks)
    return serialize.outer_html(n, "ul").select("page_id", "outer_html")


_LINKS = ["'<a href=\"../up\">x</a>'", "'<a href=\"./here/./x\">x</a>'", "'<a href=\"//cdn.example/a/../b?q=./\">x</a>'", "'<a href=\"?page=2\">x</a>'",
          "concat('<a href=\"#', p_size, '\">x</a>')", "'<base href=\"/root/sub/\"><a href=\"../../../far?x=../y\">x</a>'", "'<a href=\"\">x</a>'",
          "'<base href=\"https://other.example/k/l\"><base href=\"/no\"><a href=\"m/..\">x</a>'", "'<a href=\"/x/../../y/./\">x</a>'",
          "'<a href=\"mailto:a@b/../c\">x</a><a href=\"plain\">y</a>'"]


def resolved_links(spark, sf):
    """Links of every form against addresses that vary, on pages with and without a base."""
    url = "concat('http://part', p_partkey, '.example/a/b/c', p_size, '.html?x=1#top')"
    part = session.spread(session.tune(spark).read.parquet(f"{sf}/part.parquet"), _part_size(spark, sf), "p_partkey", "p_name")
    choice = " ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(_LINKS))
    source = part.selectExpr("p_partkey AS page_id", f"{url} AS url", f"CASE p_size % {len(_LINKS)} {choice} END AS html")
    return links.links(shred.shred(source, carry=["url"], partitions=_part_tasks(spark, sf))).select("page_id", "href", "link_text", "target", "host")


def stored_pages(spark, sf):
    """Pages read by the source, shredded, written back and read again."""
    source = P.read_pages(session.tune(spark), f"{sf}/pages.parquet")
    path = _folder(spark, "pages")
    P.write_pages(shred.shred(source), path, "json", pages=source)
    again = spark.read.schema("page_id long, html string, error string").json(path)
    items = F.size(F.split("html", "<li>")) - 1
    return again.select("page_id", items.cast("long").alias("n_items"), F.col("html").startswith("<!DOCTYPE html><html").alias("whole"), "error")


def stored_nodes(spark, sf):
    """The node table written in buckets and read again: items of every page."""
    name = f"nodes_{uuid.uuid4().hex}"
    P.write_nodes(shred.shred(P.read_pages(session.tune(spark), f"{sf}/pages.parquet")), name, 8, path=_folder(spark, "nodes"))
    return P.read_nodes(spark, name).groupBy("page_id").agg(F.count_if(F.col("tag") == "li").alias("n_items"))


def stream_normalized(spark, sf):
    rows = stream.stream_normalize(_page_stream(spark, sf), remove_comments=True)
    return _drained(rows, "normalized").select("page_id", "html")


def stream_tokens(spark, sf):
    rows = stream.stream_tokenize(_page_stream(spark, sf)).select("page_id", "kind", "raw")
    return _drained(rows, "tokens").groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("raw")).cast("long").alias("n_chars"))


def stream_sanitized(spark, sf):
    snippets = _page_stream(spark, sf).select("page_id", F.concat(F.lit("<p onclick=x>"), "url", F.lit("<script>1</script>")).alias("html"))
    return _drained(stream.stream_sanitize(snippets), "sanitized")


def reassemble_sessions(spark, sf):
    """Sessions of a real stream: whole pages, pages that lack a chunk, and pages that pause for two hours."""
    def minutes(n: Column) -> Column:
        return F.timestamp_seconds(F.lit(1_700_000_000) + 60 * n)
    rows = stream.split_pages(_page_stream(spark, sf), 300, F.timestamp_seconds(F.lit(1_700_000_000)))
    late = F.when((F.col("page_id") % 10 == 7) & (F.col("seq") > 1), 120).otherwise(0)
    rows = rows.where("NOT (page_id % 10 = 3 AND seq = 1)").withColumn("ts", minutes(late))
    # A row far ahead of all others moves the watermark past every session; its own stays open.
    rows = rows.select(F.explode(F.array(F.struct(*rows.columns), F.struct(
        F.lit(-1).cast("long").alias("page_id"), "seq", "kind", "chunk", minutes(F.lit(100_000)).alias("ts")))).alias("r"))
    rows = rows.select("r.*").where("page_id >= 0 OR kind = 'begin'")
    return _drained(stream.reassemble(rows), "sessions").select("page_id", "html", "n_chunks", "error")


def late_chunks(spark, sf):
    """Chunks that repeat and chunks that come too late, on a stream that is run as they arrive: what was kept, and the
    query's own counts of the rest.

    First even pages, every fourth one twice; then, two hours on, odd ones; then those divisible by three, at the old
    time, with a second copy of what came last."""
    source = session.tune(spark).read.parquet(f"{sf}/pages.parquet")
    root, chunk = _folder(spark, "late"), ["page_id", "seq", "kind", "chunk", "ts"]

    def at(hours: int, where: str) -> DataFrame:
        return stream.split_pages(source.where(where), 300, F.timestamp_seconds(F.lit(1_700_000_000 + 3600 * hours))).select(*chunk)
    arrivals = [at(0, "page_id % 2 = 0").unionByName(at(0, "page_id % 4 = 0")), at(2, "page_id % 2 = 1 AND page_id % 3 <> 0"),
                at(0, "page_id % 6 = 3").unionByName(at(2, "page_id % 6 = 1"))]
    for rows in arrivals:
        rows.write.mode("append").parquet(f"{root}/in")
        kept = stream.drain(stream.deduplicate(spark.readStream.schema(rows.schema).parquet(f"{root}/in")), root)
    counts = stream.drain_counts(spark, root)
    whole = stream.reassemble_batch(kept).join(source.select("page_id", F.col("html").alias("given")), "page_id")
    one = lambda kind, n: (F.lit(kind).alias("kind"), n.cast("long").alias("n"))
    out = kept.agg(F.count("*").alias("n")).select(*one("kept", F.col("n")))
    for kind in ("late", "repeated"):
        out = out.unionByName(counts.agg(F.sum(f"n_{kind}").alias("n")).select(*one(kind, F.col("n"))))
    return out.unionByName(whole.agg(F.count_if(F.col("html") == F.col("given")).alias("n")).select(*one("whole pages", F.col("n"))))


def sink_replayed(spark, sf):
    """Pages through the batch sink, and all batches again from a lost checkpoint: every page once."""
    out = _folder(spark, "sink")
    for attempt in ("first", "again"):
        run = stream.page_sink(_page_stream(spark, sf), serialize.to_html, f"{out}/rows")
        run.option("checkpointLocation", f"{out}/{attempt}").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    items = F.size(F.split("html", "<li>")) - 1
    return rows.groupBy("page_id").agg(F.count("*").alias("n"), F.max(items).cast("long").alias("n_items"))


def stream_nodes(spark, sf):
    rows = stream.stream_shred(_page_stream(spark, sf)).select("page_id", "tag", "node_type")
    return _drained(rows, "nodes").groupBy("page_id").agg(F.count_if(F.col("tag") == "li").alias("n_items"), F.count_if(F.col("node_type") == "comment").alias("n_comments"))


def stream_interpolated(spark, sf):
    rows = _page_stream(spark, sf).select("page_id", F.create_map(F.lit("url"), F.col("url"), F.lit("id"), F.col("page_id").cast("string")).alias("v"))
    filled = stream.stream_interpolate(rows, "<a href='{url}'>{id} {none}</a>", F.col("v"))
    return _drained(filled.select("page_id", "html"), "interpolated")


def stored_csv(spark, sf):
    """Pages with line breaks, quotes, backslashes and nulls through one-line csv records; pages given twice are reported."""
    part, c = session.tune(spark).read.parquet(f"{sf}/part.parquet"), F.col
    text = (F.when(c("p_size") % 5 == 0, F.concat(F.lit("<p>"), "p_name", F.lit('\n\r\\n "q", ,'), "p_type")).when(c("p_size") % 5 == 1, "")
            .when(c("p_size") % 5 == 2, None).when(c("p_size") % 5 == 3, "\\N").otherwise(F.concat(F.lit("\\"), "p_brand", F.lit("\\\\r"))))
    source = part.select(F.expr("p_partkey - CASE WHEN p_partkey % 7 = 6 THEN 1 ELSE 0 END").alias("page_id"), c("p_name").alias("url"), text.alias("html"))
    path = _folder(spark, "csv")
    source.select("page_id", "url", P.escaped("html").alias("html")).write.options(**P.CSV).csv(path)
    return P.read_pages(spark, path, "csv_lines", check=True)


def stored_text(spark, sf):
    """One page a file, read as whole texts under keys made of their paths, checked."""
    path = _folder(spark, "text")
    source = session.tune(spark).read.parquet(f"{sf}/pages.parquet").select("html")
    source.write.option("maxRecordsPerFile", 1).text(path)
    rows = P.read_pages(spark, path, "text", check=True)
    return rows.groupBy(F.md5(F.regexp_replace("html", r"\n\z", "")).alias("digest"), "error").agg(F.count("*").alias("n"))


def positional_counts(spark, sf):
    n = shred.shred(session.tune(spark).read.parquet(f"{sf}/pages.parquet"))
    return select.match_counts(n, {
        "second": "article > p:nth-of-type(2)", "last": "article > p:last-of-type", "odd_from_end": "li:nth-last-of-type(odd)",
        "only_link": "li > a:only-child", "only_item": "li:only-child", "roots": ":root", "not_only": "li:not(:only-of-type)"}, "document")


def kind_tests(spark, sf):
    n = shred.shred_fragments(_parts(spark, sf, "concat('<p>', p_name, '</p><!--', p_type, '-->')", "p_name", "'<br><hr>'"), "html", cluster=False)
    one = lambda test: F.count_if(test()).alias(test.__name__)
    return n.groupBy("page_id").agg(*map(one, (N.is_element, N.is_text, N.is_comment, N.is_document, N.is_fragment)),
                                    F.array_join(F.array_sort(F.collect_set(N.node_type_name())), ",").alias("names"))


QUERIES = [positional_counts, kind_tests, late_chunks, sink_replayed, stream_nodes, stream_interpolated, stored_csv, stored_text, resolved_links, sanitize_emptied, sanitize_iframes, sanitize_unlisted, sanitize_templates, element_flags, name_tests, audit_verdicts,
           append_parsed, stored_pages, stored_nodes, stream_normalized, stream_tokens, stream_sanitized, reassemble_sessions]
REGISTRY = {q.__name__: q for q in QUERIES}

_ITEMS = "(length(html) - length(replace(html, '<li>', ''))) // 4"
_WHOLE = "ceil(length(html) / 300)::BIGINT"
_PART_URL = "'http://part' || p_partkey || '.example"
ORACLES = {
    "resolved_links": """WITH r AS (SELECT p_partkey, """ + _cases(
        "'../up'", "'./here/./x'", "'//cdn.example/a/../b?q=./'", "'?page=2'", "'#' || p_size", "'../../../far?x=../y'", "''", "'m/..'", "'/x/../../y/./'", "'plain'")
        + " AS href, " + _cases(
        f"{_PART_URL}/a/up'", f"{_PART_URL}/a/b/here/x'", "'http://cdn.example/b?q=./'", f"{_PART_URL}/a/b/c' || p_size || '.html?page=2'",
        f"{_PART_URL}/a/b/c' || p_size || '.html?x=1#' || p_size", f"{_PART_URL}/far?x=../y'", f"{_PART_URL}/a/b/c' || p_size || '.html?x=1'",
        "'https://other.example/k/'", f"{_PART_URL}/y/'", f"{_PART_URL}/a/b/plain'")
        + """ AS target, p_size % 10 = 9 AS mail FROM part)
        SELECT p_partkey AS page_id, href, CASE WHEN mail THEN 'y' ELSE 'x' END AS link_text, target, regexp_extract(target, '//([^/]*)', 1) AS host FROM r
        UNION ALL SELECT p_partkey, 'mailto:a@b/../c', 'x', 'mailto:a@b/../c', NULL FROM r WHERE mail""",
    "sanitize_emptied": f"SELECT p_partkey AS page_id, h AS by_tree, h AS by_column FROM (SELECT p_partkey, {_cases(chr(39) * 2, chr(39) * 2, 'NULL', '''('<p>' || p_name || '</p>')''')} AS h FROM part)",
    "sanitize_iframes": "SELECT p_partkey AS page_id, " + _cases(
        "'<iframe sandbox src=\"https://example.com/' || p_partkey || '\">' || p_name || '</iframe>'", "''",
        "'<p>' || p_name || '</p>'", "'<iframe sandbox>' || p_name || '</iframe>'") + " AS html FROM part",
    "sanitize_unlisted": "SELECT p_partkey AS page_id, " + _cases(
        "'<p>' || p_type || '</p>'", "''", "'<b>' || p_name || '</b>'", "'<p>' || p_name || '</p>'") + " AS html FROM part",
    "sanitize_templates": "SELECT p_partkey AS page_id, " + _cases(
        "'<template><p>' || p_name || '</p></template>'", "'<template><li><a>' || p_type || '</a></li></template>'",
        "'<template></template><p>' || p_type || '</p>'") + " AS html FROM part",
    "element_flags": "SELECT p_partkey AS page_id, t AS tag, t <> 'p' AS preserves, t IN ('script', 'style') AS raw, t IN ('p', 'textarea') AS any_attribute, "
        "t = 'p' AS has_lang FROM (SELECT p_partkey, " + _cases("'pre'", "'script'", "'textarea'", "'p'", "'style'") + " AS t FROM part)",
    "name_tests": "SELECT p_partkey AS page_id, " + _cases("'p'", "'custom'", "'custom'") + " AS known, p_size % 3 = 1 AS custom, p_size % 3 = 0 AS is_p, "
        + _cases("p_brand", "p_type", "''") + " AS element_id, p_size % 3 = 0 AND p_brand = 'Brand#2' AS has_brand_2, "
        "p_size % 3 = 1 AND p_type = 'SMALL' AS is_small FROM part",
    "audit_verdicts": "SELECT p_partkey AS page_id, " + _cases("'title'", "'target'", "'zzz' || p_size", "'onclick'") + " AS attr, "
        + _cases("'ok'", "'invalid'", "'unknown'", "'dangerous'") + " AS verdict FROM part",
    "append_parsed": "SELECT p_partkey AS page_id, '<ul>' || " + _cases("'<li>' || p_name || '</li>'", "''", "'<!--' || p_type || '-->'")
        + " || '<li>' || p_partkey || '</li><li>last</li></ul>' AS outer_html FROM part",
    "stored_pages": f"SELECT page_id, {_ITEMS} AS n_items, true AS whole, NULL::VARCHAR AS error FROM pages",
    "stored_nodes": f"SELECT page_id, {_ITEMS} AS n_items FROM pages",
    "stream_normalized": KNOWN["strip_comments"],
    "stream_tokens": KNOWN["tokens_by_kind"],
    "stream_sanitized": "SELECT page_id, '<p>' || replace(url, '&', '&amp;') || '</p>' AS html FROM pages",
    "positional_counts": f"""SELECT page_id, (p >= 2)::BIGINT AS second, (p >= 1)::BIGINT AS last, ceil(li / 2)::BIGINT AS odd_from_end, li AS only_link,
        (li = 1)::BIGINT AS only_item, 1::BIGINT AS roots, CASE WHEN li > 1 THEN li ELSE 0 END AS not_only
        FROM (SELECT page_id, {_ITEMS} AS li, (length(html) - length(replace(html, '<p>', ''))) // 3 AS p FROM pages)""",
    "kind_tests": "SELECT p_partkey AS page_id, " + _cases("1", "0", "2") + "::BIGINT AS is_element, " + _cases("1", "1", "0") + "::BIGINT AS is_text, "
        + _cases("1", "0", "0") + "::BIGINT AS is_comment, 0::BIGINT AS is_document, 0::BIGINT AS is_fragment, "
        + _cases("'#comment,#element,#text'", "'#text'", "'#element'") + " AS names FROM part",
    "late_chunks": f"""WITH c AS (SELECT page_id, {_WHOLE} + 2 AS n FROM pages), s AS (SELECT
            coalesce(sum(n) FILTER (page_id % 2 = 0 OR page_id % 3 <> 0), 0) AS kept, coalesce(sum(n) FILTER (page_id % 6 = 3), 0) AS late,
            coalesce(sum(n) FILTER (page_id % 4 = 0 OR page_id % 6 = 1), 0) AS repeated, count(*) FILTER (page_id % 2 = 0 OR page_id % 3 <> 0) AS whole FROM c)
        SELECT unnest(['kept', 'late', 'repeated', 'whole pages']) AS kind, unnest([kept, late, repeated, whole])::BIGINT AS n FROM s""",
    "sink_replayed": f"SELECT page_id, 1::BIGINT AS n, {_ITEMS} AS n_items FROM pages",
    "stream_nodes": f"SELECT page_id, {_ITEMS} AS n_items, (length(html) - length(replace(html, '<!--', ''))) // 4 AS n_comments FROM pages",
    "stream_interpolated": "SELECT page_id, '<a href=' || chr(39) || replace(url, '&', '&amp;') || chr(39) || '>' || page_id || ' {none}</a>' AS html FROM pages",
    "stored_csv": "WITH s AS (SELECT p_partkey - CASE WHEN p_partkey % 7 = 6 THEN 1 ELSE 0 END AS page_id, p_name AS url, " + _cases(
        "'<p>' || p_name || chr(10) || chr(13) || chr(92) || 'n \"q\", ,' || p_type", "''", "NULL", "chr(92) || 'N'", "chr(92) || p_brand || chr(92) || chr(92) || 'r'")
        + """ AS html FROM part), n AS (SELECT *, count(*) OVER (PARTITION BY page_id) AS k FROM s)
        SELECT page_id, url, CASE WHEN k = 1 THEN html END AS html, CASE WHEN k > 1 THEN 'page_id repeats' END AS error FROM n""",
    "stored_text": "SELECT md5(html) AS digest, NULL::VARCHAR AS error, count(*) AS n FROM pages GROUP BY 1",
    "reassemble_sessions": f"""SELECT page_id, CASE WHEN page_id % 10 NOT IN (3, 7) THEN html END AS html,
        {_WHOLE} - CASE page_id % 10 WHEN 3 THEN 1 WHEN 7 THEN {_WHOLE} - 1 ELSE 0 END AS n_chunks,
        CASE page_id % 10 WHEN 3 THEN 'missing seq' WHEN 7 THEN 'no end' END AS error FROM pages
        UNION ALL SELECT page_id, NULL, {_WHOLE} - 1, 'no begin' FROM pages WHERE page_id % 10 = 7""",
}
