"""Registered corpus queries.  Every query reads whole tables of the given directory."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import node as N
from ..functions import spec as S
from ..functions import text as T
from ..operators import audit, axes, links, rewrite, sanitize, search, select, serialize, shred, template, text, tokens
from ..operators import normalize as norm
from ..sources import pages as P
from ..streaming import chunks as stream

PART_HTML = (
    '<div onclick="x()" class="c{p_size}" data-k="{p_partkey}"><script>s</script><!-- {p_brand} -->'
    '<a href="javascript:1" title="{p_name}">{p_name}</a><a href="/p/{p_partkey}" target="_top" style="x">go</a>'
    '<x-card size="1" onload="y">{p_type}</x-card>'
    '<svg viewBox="0 0 1 1" onload="q"><circle r="1"/><animate/></svg></div>')
FORM_HTML = (
    '<form><fieldset><legend>{p_brand}</legend><input type="checkbox" name="a" checked><input name="b" disabled>'
    '<select required><option selected>{p_type}<option>x</select><textarea placeholder="{p_name}"></textarea>'
    '</fieldset><p></p><p> </p><p><!-- {p_size} --></p><p class="Big n{p_size}">{p_name}</p></form>')
LIST_HTML = '<ul id="u" class="list"><li>{p_name}<li>{p_type}</ul><template><li>{p_brand}</li></template>'


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return session.tune(spark).read.parquet(f"{sf}/{name}.parquet")


def pages(spark, sf) -> DataFrame: return _read(spark, sf, "pages")
def nodes(spark, sf) -> DataFrame: return _shredded(pages(spark, sf))
def _page_tasks(source: DataFrame) -> int | None: return session.tasks_for(source.sparkSession, shred.node_estimate(source))


def _dealt(source: DataFrame) -> tuple[DataFrame, int | None]:
    """Pages, and the parts that their node rows need; pages that need many are dealt out before they are parsed."""
    size = shred.node_estimate(source)
    tasks = session.tasks_for(source.sparkSession, size)
    return session.spread(source, size, "page_id", "html") if tasks else source, tasks


def _shredded(source: DataFrame, **options) -> DataFrame:
    """Pages as given, shredded into as many parts as their node rows need."""
    source, tasks = _dealt(source)
    return shred.shred(source, partitions=tasks, **options)


def _part_size(part: DataFrame, markup: str) -> int: return part.count() * (markup.count("<") + 5)


def _part_tasks(spark, sf, markup: str) -> int | None:
    return session.tasks_for(spark, _part_size(_read(spark, sf, "part"), markup))


def _part_html(spark, sf, markup: str, name: str = "html") -> DataFrame:
    part = _read(spark, sf, "part")
    part = session.spread(part, _part_size(part, markup), "p_partkey", "p_name")
    return part.select(F.col("p_partkey").alias("page_id"), "p_name", "p_brand", "p_type", "p_size", "p_partkey",
                       T.interpolate(F.lit(markup), template.values_map(part)).alias(name))


def part_nodes(spark, sf, markup: str) -> DataFrame:
    return shred.shred(_part_html(spark, sf, markup), partitions=_part_tasks(spark, sf, markup))


def _long(name: str) -> Column: return F.col(name).cast("long").alias(name)


# -- tokens ---------------------------------------------------------------------------------------------

def tokens_by_kind(spark, sf):
    tok = tokens.tokenize(pages(spark, sf))
    return tok.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("raw")).cast("long").alias("n_chars"))


def start_tag_counts(spark, sf):
    tok = tokens.tokenize(pages(spark, sf)).filter("tag is not null and not closing")
    return tok.groupBy("tag").agg(F.count("*").alias("n"))


def token_attributes(spark, sf):
    tok = tokens.tokenize(pages(spark, sf)).select(F.explode("attrs").alias("a"))
    return tok.groupBy(F.col("a.name").alias("name"), F.col("a.value").alias("value")).agg(F.count("*").alias("n"))


def link_graph(spark, sf): return links.link_graph(pages(spark, sf))


def normalize_string(spark, sf):
    return pages(spark, sf).select("page_id", T.normalize_html_string(F.col("html")).alias("html"))


def normalize_spaced(spark, sf):
    spaced = F.replace(F.col("html"), F.lit("><"), F.lit("> \n\t<"))
    return pages(spark, sf).select("page_id", T.normalize_html_string(spaced).alias("html"))


def strip_comments(spark, sf):
    return pages(spark, sf).select("page_id", T.normalize_html_string(F.col("html"), remove_comments=True).alias("html"))


def escape_text(spark, sf):
    return _read(spark, sf, "documents").select("doc_id", T.escape_html(F.col("text")).alias("escaped"))


def normalize_text(spark, sf):
    return _read(spark, sf, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("text"))


def whitespace_tests(spark, sf):
    lines = _read(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("s"))
    return lines.agg(
        F.count_if(N.is_whitespace_only("s")).alias("whitespace_only"),
        F.count_if(N.is_text_empty("s")).alias("text_empty"),
        F.count_if(N.is_collapsible_ws("s")).alias("collapsible"),
        F.count_if(N.string_contains(F.col("s"), F.lit("the"))).alias("contains_the"))


# -- nodes, search, selectors ----------------------------------------------------------------------------

def tag_histogram(spark, sf):
    found = shred.shred(pages(spark, sf), cluster=False).filter(N.is_element())
    return found.groupBy(N.node_name().alias("node_name")).agg(
        F.count("*").alias("n"), F.count_if(N.is_void()).alias("n_void"), F.count_if(N.is_known_tag()).alias("n_known"))


def attr_histogram(spark, sf):
    at = shred.attributes(shred.shred(pages(spark, sf), cluster=False))
    return at.groupBy("tag", "name").agg(F.count("*").alias("n"), F.countDistinct("value").alias("n_values"))


def node_kinds(spark, sf):
    n = shred.shred(pages(spark, sf), cluster=False).filter("node_type in ('comment', 'doctype')")
    return n.groupBy("node_type").agg(F.count("*").alias("n"))


def page_roots(spark, sf):
    is_body = (F.col("tag") == "body") & (F.col("depth") == 1) & (F.col("tree_id") == 0)
    roots = shred.document_root(axes.parent_element(nodes(spark, sf), is_body))
    return roots.groupBy(N.get_attribute("lang").alias("lang")).agg(F.count("*").alias("n"))


def bold_elements(spark, sf):
    n = nodes(spark, sf)
    return n.filter("tag = 'b'").groupBy("page_id").agg(F.count("*").alias("n"))


def comments(spark, sf):
    return text.comment_content(shred.shred(pages(spark, sf), cluster=False)).select("page_id", "text")


def elements_by_class(spark, sf):
    found = search.elements_by_class(shred.shred(pages(spark, sf), cluster=False), "ad")
    return found.select("page_id", "tag", N.class_string().alias("class_string"), N.class_count().cast("long").alias("n_classes"))


def elements_by_attribute(spark, sf):
    return search.elements_by_attribute(nodes(spark, sf), "href", "/THE", True).groupBy("page_id").agg(F.count("*").alias("n"))


def elements_with_attribute(spark, sf):
    return search.elements_with_attribute(nodes(spark, sf), "href").groupBy("page_id").agg(F.count("*").alias("n"))


def elements_by_id_name(spark, sf):
    n = part_nodes(spark, sf, LIST_HTML + FORM_HTML)
    found = search.find_elements(n, search.id_is("u") | search.name_is("b"))
    return found.select("page_id", "tag", N.element_id().alias("element_id"))


def first_link(spark, sf):
    return search.first_by_tag(nodes(spark, sf), "a").select("page_id", N.get_attribute("href").alias("href"))


def first_with_class(spark, sf):
    return search.first_by_class(nodes(spark, sf), "ad").select("page_id", "tag")


def first_by_attribute(spark, sf):
    n = nodes(spark, sf)
    return search.first_by_attribute(n, "href", scope="document").select("page_id", N.get_attribute("href").alias("href"))


def first_by_id(spark, sf):
    return search.first_by_id(part_nodes(spark, sf, LIST_HTML), "u").select("page_id", "tag", N.class_string().alias("cls"))


def first_by_data_attribute(spark, sf):
    n = part_nodes(spark, sf, PART_HTML)
    return search.first_by_data_attribute(n, "data", "k").select("page_id", N.get_attribute("data-k").alias("k"))


def find_elements(spark, sf):
    n = nodes(spark, sf)
    long_links = F.length(N.get_attribute("href")) > 6
    return search.find_elements(n, (F.col("tag") == "a") & long_links).groupBy("page_id").agg(F.count("*").alias("n"))


def find_first(spark, sf):
    long_links = (F.col("tag") == "a") & (F.length(N.get_attribute("href")) > 6)
    return search.find_first(nodes(spark, sf), long_links).select("page_id", N.get_attribute("href").alias("href"))


def map_elements(spark, sf):
    n = shred.shred(pages(spark, sf), cluster=False)
    mapped = search.map_elements(n, label=F.concat("tag", F.lit("."), F.coalesce(N.get_attribute("class"), F.lit(""))))
    return mapped.filter("label is not null").groupBy("label").agg(F.count("*").alias("n"))


def nav_links(spark, sf):
    found = select.select_all(nodes(spark, sf), "nav > ul > li > a[href]")
    return found.select("page_id", "pre", N.get_attribute("href").alias("href"))


def link_hosts(spark, sf):
    n = _shredded(pages(spark, sf), carry=["url"])
    found = links.links(n, text=False, selector="nav > ul > li > a[href]")
    return found.groupBy("host").agg(F.count("*").alias("n_links"), F.countDistinct("page_id").alias("n_pages"))


def page_links(spark, sf):
    n = _shredded(pages(spark, sf), carry=["url"])
    return links.links(n).select("page_id", "href", "link_text", "target")


def _positions(spark, sf, selector):
    return select.select_all(nodes(spark, sf), selector).select("page_id", _long("elem_idx"))


def li_first(spark, sf): return _positions(spark, sf, "ul > li:first-child")
def li_last(spark, sf): return _positions(spark, sf, "nav li:last-child")
def li_nth_2n1(spark, sf): return _positions(spark, sf, "li:nth-child(2n+1)")
def li_nth_last(spark, sf): return _positions(spark, sf, "li:nth-last-child(-n+2)")
def li_after_second(spark, sf): return _positions(spark, sf, "li:nth-child(2) ~ li")
def li_nth_of(spark, sf): return _positions(spark, sf, "li:nth-child(even of :has(> a[href^='/t']))")


def adjacent_div_article(spark, sf):
    return select.select_all(nodes(spark, sf), "div.AD + article").select("page_id", "tag")


def p_has_br(spark, sf):
    found = select.select_all(nodes(spark, sf), "article p:has(br)")
    return found.groupBy("page_id").agg(F.count("*").alias("n"))


def not_has(spark, sf):
    found = select.select_all(nodes(spark, sf), "article > p:not(:has(br))")
    return found.groupBy("page_id").agg(F.count("*").alias("n"))


def selector_list(spark, sf):
    found = select.select_all(nodes(spark, sf), "title, article > h1, nav :is(li, a):first-child, footer", "document")
    return found.groupBy("tag").agg(F.count("*").alias("n"))


def attr_operators(spark, sf):
    return select.match_counts(nodes(spark, sf), {
        "prefix": "a[href^='/t']", "suffix": 'a[href$="e"]', "part": "a[href*=an]", "exact_ci": "a[href='/THE' i]",
        "token": "[class~=ad]", "dash": "html[lang|=en]", "empty_operand": "a[href^='']"}, "document")


def match_counts(spark, sf):
    return select.match_counts(nodes(spark, sf), {
        "n_items": "nav li", "n_paragraphs": "article > p", "n_breaks": "p br", "n_never": "a:visited",
        "n_first": "p:first-of-type", "n_only": "h1:only-of-type"})


def contains_text(spark, sf):
    return select.select_all(nodes(spark, sf), "a:contains('the')").groupBy("page_id").agg(F.count("*").alias("n"))


def page_matches(spark, sf):
    # Every page has a node row, one of kind error where it could not be shredded, so no join with the pages.
    return select.page_matches(nodes(spark, sf), "a[href='/The']")


def select_first(spark, sf):
    return select.select_first(nodes(spark, sf), "nav a[href^='/t']").select("page_id", N.get_attribute("href").alias("href"))


def form_states(spark, sf):
    return select.match_counts(part_nodes(spark, sf, FORM_HTML), {
        "n_checked": ":checked", "n_disabled": ":disabled", "n_required": ":required", "n_optional": ":optional",
        "n_shown": ":placeholder-shown", "n_write": ":read-write", "n_empty": "p:empty", "n_blank": "p:blank",
        "n_class": "p.big", "n_enabled": "select:enabled"})


def select_within(spark, sf):
    roots = F.col("tag").isin("nav", "ul", "article")
    found = select.select_within(nodes(spark, sf), roots, "li, h1", root_tag=F.col("tag"))
    return found.groupBy("root_tag", "tag").agg(F.count("*").alias("n"))


def filter_nodes(spark, sf):
    first = (F.col("elem_idx") == 1) & (F.col("tree_id") == 0)
    return select.filter_nodes(nodes(spark, sf), first, "li, h1").groupBy("tag").agg(F.count("*").alias("n"))


def node_matches(spark, sf):
    flagged = select.node_matches(nodes(spark, sf), N.is_element(), "[class], li:first-child, a[href^='/t'], p:has(br)")
    return flagged.groupBy("page_id", "tag", "matches").agg(F.count("*").alias("n"))


# -- axes ---------------------------------------------------------------------------------------------------

def list_children(spark, sf):
    kids = axes.children_arrays(nodes(spark, sf), F.col("tag") == "ul")
    return kids.select("page_id", F.size("children").cast("long").alias("n_children"))


def edge_children(spark, sf):
    parent = F.col("tag").isin("body", "ul", "li")
    ends = axes.walk(nodes(spark, sf), first=("first_child", parent), last=("last_child", parent),
                     first_element=("first_element_child", parent), last_element=("last_element_child", parent))
    value = F.coalesce(N.get_attribute("href"), F.col("text"), F.lit(""))
    return ends.groupBy("page_id", "axis", N.node_name().alias("name")).agg(
        F.count("*").alias("n"), F.sum(F.length(value)).cast("long").alias("n_chars"))


def sibling_axis(spark, sf):
    div, li = F.col("tag") == "div", F.col("tag") == "li"
    found = axes.walk(nodes(spark, sf), next=("next_sibling", div), previous=("previous_sibling", div),
                      after_nav=("next_element_sibling", F.col("tag") == "nav"), next_item=("next_element_sibling", li),
                      previous_item=("previous_sibling", li & (F.col("elem_idx") % 2 == 0)))
    return found.groupBy("page_id", "axis", N.node_name().alias("name")).agg(F.count("*").alias("n"))


def parent_axis(spark, sf):
    return axes.parent_element(nodes(spark, sf), F.col("tag") == "li").groupBy("page_id", "tag").agg(F.count("*").alias("n"))


def ancestor_axis(spark, sf):
    return axes.ancestors(nodes(spark, sf), F.col("tag") == "a").groupBy("page_id", "tag").agg(F.count("*").alias("n"))


def descendant_axis(spark, sf):
    n = nodes(spark, sf)
    return axes.descendants(n, F.col("tag") == "nav").groupBy("page_id", N.node_name().alias("name")).agg(F.count("*").alias("n"))


def descendant_counts(spark, sf):
    return axes.descendant_counts(nodes(spark, sf).filter("tag = 'ul'")).select("page_id", _long("n_descendants"))


def empty_nodes(spark, sf):
    html = F.expr("""CASE p_size % 4 WHEN 0 THEN concat('<p>', p_name, '</p>') WHEN 1 THEN concat('<p> <!-- ', p_name, ' --> </p>')
                     WHEN 2 THEN '<div><p></p></div>' ELSE '<ul> \\n<li><br></li></ul>' END""")
    part = _read(spark, sf, "part")
    size = 10 * part.count()
    source = session.spread(part, size, "p_partkey", "p_name").select(F.col("p_partkey").alias("page_id"), html.alias("html"))
    n = axes.node_empty(shred.shred(source, partitions=session.tasks_for(spark, size)))
    return n.groupBy("page_id", N.node_name().alias("name"), "is_empty").agg(F.count("*").alias("n"))


# -- text and markup --------------------------------------------------------------------------------------------

def _text_of(spark, sf, tag):
    return text.text_content(nodes(spark, sf), F.col("tag") == tag).select("page_id", F.col("text_content").alias("text"))


def title_text(spark, sf): return _text_of(spark, sf, "title")
def h1_text(spark, sf): return _text_of(spark, sf, "h1")
def footer_text(spark, sf): return _text_of(spark, sf, "footer")
def main_text(spark, sf): return links.main_text(nodes(spark, sf))
def style_text(spark, sf): return links.style_text(nodes(spark, sf)).select("page_id", "text")
def script_text(spark, sf): return links.style_text(nodes(spark, sf), "script").select("page_id", "text")


def nav_html(spark, sf):
    return serialize.outer_html(nodes(spark, sf), "nav").select("page_id", "outer_html")


def nav_inner_html(spark, sf):
    return serialize.inner_html(nodes(spark, sf), "nav").select("page_id", "inner_html")


def head_html(spark, sf):
    head = F.col("tag") == "head"
    return serialize.outer_html(nodes(spark, sf), head).select("page_id", "outer_html")


def outline_nav(spark, sf):
    n = nodes(spark, sf)
    inside = axes.descendants(n, F.col("tag") == "nav")
    return serialize.outline(inside).groupBy("page_id", _long("depth"), "name").agg(F.count("*").alias("n"))


def roundtrip(spark, sf):
    n = nodes(spark, sf)
    again = shred.shred(serialize.to_html(n), partitions=_page_tasks(pages(spark, sf)))
    sig = lambda d: d.groupBy("page_id").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("pre", "last", "depth", "node_type", "tag", "text", "attrs").cast("decimal(38,0)")).alias("h"))
    a, b = sig(n), sig(again)
    return a.join(b, "page_id", "full").select(
        "page_id", a["n"].eqNullSafe(b["n"]).alias("same_size"), a["h"].eqNullSafe(b["h"]).alias("same_nodes"))


# -- normalisation -----------------------------------------------------------------------------------------------

def _spaced_pages(spark, sf):
    return pages(spark, sf).select("page_id", F.replace(F.col("html"), F.lit("><"), F.lit(">\n\t<")).alias("html"))


def normalize_dom(spark, sf):
    n = norm.normalize_dom(_shredded(_spaced_pages(spark, sf)), skip_comments=True)
    return serialize.outer_html(n, F.col("tag").isin("head", "nav", "div", "footer")).select("page_id", "tag", "outer_html")


def normalize_for_display(spark, sf):
    n = norm.normalize_for_display(_shredded(_spaced_pages(spark, sf)))
    return serialize.outer_html(n, F.col("tag").isin("head", "nav", "div", "footer")).select("page_id", "tag", "outer_html")


# -- specification, audit, sanitiser --------------------------------------------------------------------------------

def audit_parts(spark, sf):
    found = audit.audit_attributes(shred.shred(_part_html(spark, sf, PART_HTML), cluster=False))
    return found.groupBy("tag", "attr", "verdict").agg(F.count("*").alias("n"))


def audit_joined(spark, sf):
    at = audit.join_spec(shred.attributes(shred.shred(pages(spark, sf), cluster=False)))
    return at.groupBy("tag", "name", "listed").agg(F.count("*").alias("n"))


def attribute_rules(spark, sf):
    part = _read(spark, sf, "part").selectExpr(
        "p_partkey", "p_name", "CASE p_size % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'button' ELSE 'x-card' END AS tag",
        "CASE p_type WHEN 'ECONOMY' THEN 'href' WHEN 'SMALL' THEN 'disabled' WHEN 'LARGE' THEN 'hx-get' "
        "WHEN 'STANDARD' THEN 'onclick' ELSE 'lang' END AS attr")
    return part.select(
        "p_partkey", "tag", "attr", S.attribute_allowed("tag", "attr").alias("allowed"),
        S.attribute_value_valid("tag", "attr", "p_name").alias("valid"), S.is_known_attribute("attr").alias("known"),
        S.framework_of("attr").alias("framework"))


def allowed_attributes(spark, sf):
    tags = shred.shred(pages(spark, sf), cluster=False).groupBy("tag").agg(F.count("*").alias("n_nodes"))
    listed = S.spec_attrs(spark).groupBy("tag").agg(F.count("*").alias("n_attrs"))
    return tags.join(F.broadcast(listed), "tag").select("tag", "n_nodes", "n_attrs")


def dangerous_values(spark, sf):
    value = F.concat(F.when(F.col("page_id") % 2 == 0, F.lit("JavaScript:")).otherwise(F.lit("")),
                     F.replace(F.col("url"), F.lit("https:"), F.lit("")))
    return pages(spark, sf).select("page_id", value.alias("value")).withColumn("dangerous", S.is_dangerous_value("value"))


def safe_uri(spark, sf):
    rel = F.regexp_replace("url", r"^https?://[^/]*", "")
    tail = F.substring(rel, F.when(F.col("page_id") % 2 == 0, 1).otherwise(2), F.length(rel))
    return pages(spark, sf).select("page_id", "url", tail.alias("tail")).select(
        "page_id", S.is_safe_uri("url").alias("url_safe"), S.is_safe_uri("tail").alias("tail_safe"))


def scan_pages(spark, sf):
    report = audit.scan_pages(shred.shred(pages(spark, sf), cluster=False), "strict")
    return report.groupBy("kind", "reason").agg(F.sum("n").cast("long").alias("n"))


def _sanitized_parts(spark, sf, mode):
    source = _part_html(spark, sf, PART_HTML)
    n = shred.shred_fragments(source, "html", "body", sanitize=mode, reindex=False, partitions=_part_tasks(spark, sf, PART_HTML))
    return serialize.to_html(n, source)


def sanitize_strict_parts(spark, sf): return _sanitized_parts(spark, sf, "strict")
def sanitize_permissive_parts(spark, sf): return _sanitized_parts(spark, sf, "permissive")
def sanitize_minimum_parts(spark, sf): return _sanitized_parts(spark, sf, "minimum")
def sanitize_none_parts(spark, sf): return _sanitized_parts(spark, sf, "none")


def sanitize_custom_parts(spark, sf):
    return _sanitized_parts(spark, sf, sanitize.SanitizerOptions(
        skip_comments=False, remove_scripts=False, remove_styles=True, strict_uri_validation=False,
        allow_custom_elements=True, compat=True))


def sanitize_snippets(spark, sf):
    """Row-local form: one column in, one column out."""
    src = _part_html(spark, sf, PART_HTML).select("page_id", "html")
    return template.sanitize_column(src, "html", "strict")


def sanitized_text(spark, sf):
    clean = sanitize.sanitize(nodes(spark, sf), "strict", reindex=False)
    return text.text_content(clean, F.col("tag") == "html", dense=False).select("page_id", F.col("text_content").alias("text"))


def sanitized_counts(spark, sf):
    clean = _shredded(pages(spark, sf), sanitize="strict", reindex=False)
    return clean.groupBy("page_id").agg(
        F.count_if(F.col("tag").isin("script", "style")).alias("n_code"), F.count_if(F.col("node_type") == "comment").alias("n_comments"),
        F.count_if(F.col("tag") == "a").alias("n_links"), F.count_if(F.col("tag") == "p").alias("n_paragraphs"))


# -- rewriting ----------------------------------------------------------------------------------------------------------

def _nav_after(n): return serialize.outer_html(n, "nav").select("page_id", "outer_html")


def set_nofollow(spark, sf): return _nav_after(rewrite.set_attribute(nodes(spark, sf), "nav a", "rel", "nofollow"))
def remove_hrefs(spark, sf): return _nav_after(rewrite.remove_attribute(nodes(spark, sf), F.col("tag") == "a", "href"))


def set_from_table(spark, sf):
    """Values of the page's own row: every link of a page carries the page's url."""
    n = _shredded(pages(spark, sf), carry=["url"])
    return _nav_after(rewrite.set_attributes(n, "nav a", {"data-from": F.col("url")}))


def add_class_ads(spark, sf):
    n = rewrite.add_class(nodes(spark, sf), "div.ad", "seen")
    return serialize.outer_html(n, "div").select("page_id", "outer_html")


def class_edits(spark, sf):
    n = part_nodes(spark, sf, '<p class="a b">{p_name}</p><p class="a b">x</p><p class="a b">y</p><p class="a b">z</p>')
    at = lambda i: (F.col("tag") == "p") & (F.col("elem_idx") == i)
    n = rewrite.remove_class(n, at(1), "a")
    n = rewrite.toggle_class(n, at(2), "c")
    n = rewrite.replace_class(n, at(3), "a", "d")
    n = rewrite.clear_classes(n, at(4))
    return serialize.inner_html(n, F.col("tag") == "body").select("page_id", "inner_html")


def insert_banner(spark, sf):
    banner = rewrite.markup('<aside class="banner">{page}<br>!</aside>', page=F.col("page_id"))
    n = rewrite.insert_adjacent_element(nodes(spark, sf), "div.ad", "beforebegin", banner)
    return serialize.outer_html(n, "nav ~ aside").select("page_id", "outer_html", _long("elem_idx"))


def insert_items(spark, sf):
    return _nav_after(rewrite.edit(
        nodes(spark, sf), rewrite.insert("nav ul", "afterbegin", "<li>first</li>"),
        rewrite.insert("nav ul", "beforeend", [rewrite.new_element("li", {"class": "end"}), rewrite.new_comment(" c ")]),
        rewrite.insert("nav ul", "afterend", rewrite.new_text("t<"))))


def edit_log(spark, sf):
    """Insertions, replacements and removals of many selections, applied at once."""
    item = rewrite.markup("<li id='p{page}'>new {url}</li>", page=F.col("page_id"), url=F.length("url"))
    return _nav_after(rewrite.edit(
        _shredded(pages(spark, sf), carry=["url"]), rewrite.remove("nav li:nth-child(even)"), rewrite.insert("nav li:nth-child(odd)", "beforebegin", item),
        rewrite.insert("nav li:nth-child(odd)", "beforebegin", rewrite.new_comment("second")), rewrite.replace_content("nav li:first-child a", "<b>first</b>"),
        rewrite.insert("nav ul", "afterend", "<p onclick=x>end<script>s</script></p>", mode="strict"), rewrite.insert("nav ul", "afterend", rewrite.new_text("later"))))


def insert_nested_siblings(spark, sf):
    n = rewrite.insert_before(nodes(spark, sf), "nav li", rewrite.new_element("hr"))
    return _nav_after(n)


def remove_ads(spark, sf):
    n = rewrite.remove_nodes(nodes(spark, sf), ".ad, nav li:first-child")
    return n.groupBy("page_id").agg(F.count_if(F.col("tag") == "div").alias("n_div"), F.count_if(F.col("tag") == "li").alias("n_li"),
                                    (F.max("pre") + 1 == F.count("*")).alias("dense"))


def set_inner_html(spark, sf):
    source, tasks = _dealt(pages(spark, sf))
    n = shred.shred(source, partitions=tasks)
    n = rewrite.set_inner_html(n, "nav", F.concat(F.lit("<b>page "), F.col("page_id").cast("string"), F.lit("<i>x")), partitions=tasks)
    return _nav_after(n)


def set_inner_html_safe(spark, sf):
    content = rewrite.markup("<script>x</script><p onclick='y' id='p{page}'>ok {page}</p>", mode="strict", page=F.col("page_id"))
    return _nav_after(rewrite.edit(nodes(spark, sf), rewrite.replace_content("nav", content)))


def set_text(spark, sf): return _nav_after(rewrite.set_text(nodes(spark, sf), "nav li:first-child", "a < b"))


def replace_children(spark, sf):
    return _nav_after(rewrite.replace_children(nodes(spark, sf), "nav ul", rewrite.new_element("li", {"id": "0"})))


def replace_text(spark, sf):
    """The text below every title is replaced; the titles, selected too, are no text nodes and are reported."""
    title = F.col("tag") == "title"
    n = axes.flag_children(nodes(spark, sf), title, "_below")
    n = rewrite.replace_text(n, title | F.col("_below"), F.concat(F.lit("Page "), F.col("page_id").cast("string")), report="error")
    return text.text_content(n, title).select("page_id", "text_content", "error")


def copy_subtree(spark, sf):
    return _nav_after(rewrite.copy_subtree(nodes(spark, sf), "nav li:first-child", "nav ul"))


def import_subtree(spark, sf):
    """The first item of the page before (by number) is imported into every list."""
    p = pages(spark, sf)
    before = p.select("page_id", (F.col("page_id") - 1).alias("from_page_id"))
    return _nav_after(rewrite.copy_subtree(_shredded(p), "nav li:first-child", "nav ul", "afterbegin", pages=before))


def clear_document(spark, sf):
    n = rewrite.clear_document(nodes(spark, sf))
    return serialize.to_html(n)


def part_template_use(spark, sf):
    n = part_nodes(spark, sf, LIST_HTML)
    n = rewrite.instantiate_template(n, F.col("tag") == "template", "ul", times=2)
    return serialize.inner_html(n, F.col("tag") == "body").select("page_id", "inner_html")


def template_html(spark, sf):
    return serialize.inner_template_html(part_nodes(spark, sf, LIST_HTML)).select("page_id", "template_html")


def template_content(spark, sf):
    n = shred.shred(_part_html(spark, sf, LIST_HTML), cluster=False)
    return shred.template_content(n).groupBy("node_type").agg(F.count("*").alias("n"), F.count_if(F.col("parent_id").isNull()).alias("n_top"))


def parse_and_append(spark, sf):
    markup = "<template><li>T</li></template> <li>z</li>"
    return serialize.outer_html(rewrite.parse_and_append(part_nodes(spark, sf, LIST_HTML), "ul", markup), "ul").select("page_id", "outer_html")


def append_fragment(spark, sf):
    rows = F.concat(F.lit("<tr><td>"), F.col("page_id").cast("string"), F.lit("<tr><td>2"))
    markup = "<table><tbody></table>{p_name}"
    n = rewrite.append_fragment(part_nodes(spark, sf, markup), "tbody", shred.fragment_nodes(rows), _part_tasks(spark, sf, markup))
    return serialize.inner_html(n, F.col("tag") == "body").select("page_id", "inner_html")


def insert_parsed(spark, sf):
    """Markup that varies by row is parsed row by row."""
    rows = F.concat(F.lit("<b>"), F.col("page_id").cast("string"), F.lit("<script>x</script><i onclick=y>"))
    n = rewrite.insert_adjacent_html(part_nodes(spark, sf, "<p>{p_name}"), "p", "afterbegin", rows, mode="strict",
                                     partitions=_part_tasks(spark, sf, "<p>{p_name}"))
    return serialize.inner_html(n, F.col("tag") == "body").select("page_id", "inner_html")


# -- rendering ------------------------------------------------------------------------------------------------------------

ORDER_ROW = "<tr id=\"{o_orderkey}\"><td>{o_orderpriority}</td><td>{o_orderstatus}</td><td>{missing}</td></tr>"


def render_orders(spark, sf):
    out = template.render_rows(_read(spark, sf, "orders"), ORDER_ROW, ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    return out.select("o_orderkey", "html")


def render_documents(spark, sf):
    docs = _read(spark, sf, "documents").select("doc_id", "lang", "text")
    return template.render_rows(docs, "<article lang=\"{lang}\">{text}</article>").select("doc_id", "html")


def render_raw(spark, sf):
    docs = _read(spark, sf, "part").select("p_partkey", F.lit("{p_type}").alias("inner"), "p_type")
    return template.render_rows(docs, "<p>{inner}</p>", ["inner", "p_type"], escape=False).select("p_partkey", "html")


def render_nations(spark, sf):
    out = template.render_groups(_read(spark, sf, "nation"), "<li>{n_name}</li>", ["n_regionkey"], ["n_nationkey"],
                                 header="<ul>", footer="</ul>")
    return out.select("n_regionkey", "n_rows", "html")


def render_paged(spark, sf):
    orders = _read(spark, sf, "orders").select("o_orderstatus", "o_orderkey")
    out = template.render_groups(orders, "<li>{o_orderkey}</li>", ["o_orderstatus"], ["o_orderkey"], per_page=100)
    return out.select("o_orderstatus", "page_no", "n_rows", "html")


def render_parts(spark, sf):
    """Groups longer than one string: all line items of a flag, the group's parts in order."""
    items = _read(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    out = template.render_groups(items, "{l_orderkey}.{l_linenumber};", ["l_returnflag"], ["l_orderkey", "l_linenumber"],
                                 header="[", footer="]")
    return out.select("l_returnflag", "page_no", "n_rows", F.md5("html").alias("html_md5"))


# -- chunk streams ------------------------------------------------------------------------------------------------------------

def reassemble_batch(spark, sf):
    parts = stream.split_pages(pages(spark, sf), 300)
    copies = parts.unionByName(parts.filter("kind = 'chunk'"))
    return stream.reassemble_batch(stream.deduplicate(copies))


def protocol_errors(spark, sf):
    conv = _read(spark, sf, "conversations")
    kind = F.when((F.col("turn") == 0) | (F.col("turn") == 4), "begin").when(F.col("turn") == 3, "end").otherwise("chunk")
    shifted = conv.select(F.col("conv_id").alias("page_id"), kind.alias("kind"),
                          F.when(F.col("turn") >= 5, F.col("turn") + 1).otherwise(F.col("turn")).alias("seq"))
    return stream.chunk_protocol_errors(shifted)


def reassemble_stream(spark, sf):
    """The keyed-state reassembly run to completion over the chunked pages, read back as a table.

    One page in ten lacks its end row and is reported as abandoned, since a row far ahead moves the watermark.
    State, offsets and output live under the cluster's shared checkpoint folder."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source = P.stream_table(session.tune(spark), f"{sf}/pages.parquet")
    rows = stream.split_pages(source, 300).where("NOT (page_id % 10 = 3 AND kind = 'end')")
    ahead = F.struct(F.lit(-1).cast("long").alias("page_id"), "seq", "kind", "chunk", F.expr("ts + interval 1 day").alias("ts"))
    lead = (F.col("page_id") % 1000 == 0) & (F.col("kind") == "begin")
    rows = rows.select(F.explode(F.when(lead, F.array(F.struct(*rows.columns), ahead)).otherwise(F.array(F.struct(*rows.columns)))).alias("r"))
    done = stream.drain(stream.reassemble_eager(rows.select("r.*")), f"{session.shared_folder(spark)}/reassemble-{uuid.uuid4().hex}")
    return done.select("page_id", "html", _long("n_rows"), "error")


FLAGSHIP = link_hosts
QUERIES = [
    tokens_by_kind, start_tag_counts, token_attributes, link_graph, normalize_string, normalize_spaced, strip_comments,
    escape_text, normalize_text, whitespace_tests, tag_histogram, attr_histogram, node_kinds, page_roots, bold_elements,
    comments, elements_by_class, elements_by_attribute, elements_with_attribute, elements_by_id_name, first_link,
    first_with_class, first_by_attribute, first_by_id, first_by_data_attribute, find_elements, find_first, map_elements,
    nav_links, link_hosts, page_links, li_first, li_last, li_nth_2n1, li_nth_last, li_after_second, li_nth_of,
    adjacent_div_article, p_has_br, not_has, selector_list, attr_operators, match_counts, contains_text, page_matches,
    select_first, form_states, select_within, filter_nodes, node_matches, list_children, edge_children, sibling_axis,
    parent_axis, ancestor_axis, descendant_axis, descendant_counts, empty_nodes, title_text, h1_text, footer_text,
    main_text, style_text, script_text, nav_html, nav_inner_html, head_html, outline_nav, roundtrip, normalize_dom,
    normalize_for_display, audit_parts, audit_joined, attribute_rules, allowed_attributes, dangerous_values, safe_uri,
    scan_pages, sanitize_strict_parts, sanitize_permissive_parts, sanitize_minimum_parts, sanitize_none_parts,
    sanitize_custom_parts, sanitize_snippets, sanitized_text, sanitized_counts, set_nofollow, remove_hrefs,
    set_from_table, add_class_ads, class_edits, insert_banner, insert_items, edit_log, insert_nested_siblings, remove_ads,
    set_inner_html, set_inner_html_safe, set_text, replace_children, replace_text, copy_subtree, import_subtree, insert_parsed, clear_document,
    part_template_use, template_html, template_content, parse_and_append, append_fragment, render_orders,
    render_documents, render_raw, render_nations, render_paged, render_parts, reassemble_batch, protocol_errors,
    reassemble_stream,
]
REGISTRY = {q.__name__: q for q in QUERIES}
