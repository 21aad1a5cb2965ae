"""Tree construction: input markup against the serialised body."""

from __future__ import annotations

from pyspark.sql import functions as F

from helpers import body_inner, body_outer, nodes, table
from pageframe.operators import serialize, shred

CASES = [
    ("<p></p>", "<p></p>"),
    ("<div>Raw < and > characters</div><b></b>", "<div>Raw &lt; and &gt; characters</div><b></b>"),
    ("<p>x</p><script>if (x < 5) alert('test');</script>", "<p>x</p><script>if (x < 5) alert('test');</script>"),
    ("<p><b>x<br><p>y</article><footer>z</footer>",
     "<p><b>x<br></b></p><p><b>y</b></p><footer><b>z</b></footer>"),
    ("<b>1<p>2</b>3</p>", "<b>1</b><p><b>2</b>3</p>"),
    ("<i>1<b>2</i>3</b>", "<i>1<b>2</b></i><b>3</b>"),
    ("<a href=x>1<a>2</a>", '<a href="x">1</a><a>2</a>'),
    ("<b><b><b><b>x<p>y", "<b><b><b><b>x<p>y</p></b></b></b></b>"),
    ("<p><b><b><b><b>x<p>y", "<p><b><b><b><b>x</b></b></b></b></p><p><b><b><b>y</b></b></b></p>"),
    ("<table><tr><td>1<td>2<tr><td>x</table>y",
     "<table><tbody><tr><td>1</td><td>2</td></tr><tr><td>x</td></tr></tbody></table>y"),
    ("<table>foo<tr><td>1</table>", "foo<table><tbody><tr><td>1</td></tr></tbody></table>"),
    ("<table><caption>c<tr><td>1", "<table><caption>c</caption><tbody><tr><td>1</td></tr></tbody></table>"),
    ("<table><col><tr><th>1<table><td>2</table>3",
     "<table><colgroup><col></colgroup><tbody><tr><th>1<table><tbody><tr><td>2</td></tr></tbody></table>3</th></tr></tbody></table>"),
    ("<ul><li>1<li>2<ul><li>3</ul></ul>", "<ul><li>1</li><li>2<ul><li>3</li></ul></li></ul>"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>"),
    ("<h1>a<h2>b</h1>c", "<h1>a</h1><h2>b</h2>c"),
    ("<select><option>1<option>2<optgroup label=g><option>3</select>z",
     '<select><option>1</option><option>2</option><optgroup label="g"><option>3</option></optgroup></select>z'),
    ("<svg viewbox='0 0'><foreignobject><div>x</div></foreignobject><circle r=1 /><path/></svg><p>t",
     '<svg viewBox="0 0"><foreignObject><div>x</div></foreignObject><circle r="1"></circle><path></path></svg><p>t</p>'),
    ("<svg><g><p>out", "<svg><g></g></svg><p>out</p>"),
    ("<math><mi>x</mi></math>y", "<math><mi>x</mi></math>y"),
    ("x<template><tr><td>1</td></tr></template><div>q</div>",
     "x<template><tr><td>1</td></tr></template><div>q</div>"),
    ("<div hidden=\"\" id=a ID=b class='c d'>&amp;&lt;&copy;&nbsp;é</div>",
     '<div hidden="" id="a" class="c d">&amp;&lt;©&nbsp;é</div>'),
    ("<button disabled onclick=\"alert('x')\">z", "<button disabled onclick=\"alert('x')\">z</button>"),
    ("<a title=\"x>y\" data-a='q\"r'>t</a>", "<a title=\"x&gt;y\" data-a=\"q&quot;r\">t</a>"),
    ("<p>a<!-- c -- d --><!--><!bogus><?pi x?>b", "<p>a<!-- c -- d --><!----><!--bogus--><!--?pi x?-->b</p>"),
    ("<textarea>\n<b>x</b>&amp;</textarea>y", "<textarea>&lt;b&gt;x&lt;/b&gt;&amp;</textarea>y"),
    ("<p>x<script>a</p>", "<p>x<script>a</p></script></p>"),
    ("</p>x</p>a</br>b", "x<p></p>a<br>b"),
    ("<form>1<form>2</form>3", "<form>12</form>3"),
    ("<pre>\n\na</pre>", "<pre>\na</pre>"),
    ("<x-card><image src=a></x-card>", '<x-card><img src="a"></x-card>'),
    ("<ruby>a<rt>b<rp>c</ruby>", "<ruby>a<rt>b</rt><rp>c</rp></ruby>"),
    ("<a><table><tr><td><a>x</table>", "<a><table><tbody><tr><td><a>x</a></td></tr></tbody></table></a>"),
]


def test_body_markup(spark):
    got = body_inner(nodes(spark, *[c[0] for c in CASES]))
    assert got == [c[1] for c in CASES]


def test_document_shape(spark):
    n = nodes(spark, "<!-- c --><!doctype html><html lang=en><title>a&amp;b</title><body class=k>x</body></html> <!-- d -->", "", "<p></p>")
    html = {r.page_id: r.html for r in serialize.to_html(n).collect()}
    assert html[0] == ('<!-- c --><!DOCTYPE html><html lang="en"><head><title>a&amp;b</title></head>'
                       '<body class="k">x </body></html><!-- d -->')
    assert html[1] == "<html><head></head><body></body></html>"
    assert body_outer(n)[2] == "<body><p></p></body>"
    assert shred.document_root(n).count() == 3 and shred.body(n).count() == 3


def test_bad_pages_become_rows(spark):
    pages = spark.createDataFrame([(1, None), (2, "<p>x")], "page_id long, html string")
    n = shred.shred(pages)
    assert [(r.page_id, r.error) for r in shred.shred_errors(n).collect()] == [(1, "page is null")]
    assert {r.page_id for r in shred.nodes_ok(n).select("page_id").distinct().collect()} == {2}


def test_numbering_invariants(spark):
    n = nodes(spark, *[c[0] for c in CASES]).cache()
    per_page = n.groupBy("page_id").agg(F.count("*").alias("n"), F.max("pre").alias("m"), F.countDistinct("pre").alias("d"))
    assert per_page.filter("n <> m + 1 or n <> d").count() == 0
    kids = n.alias("k").join(n.alias("p"), (F.col("k.page_id") == F.col("p.page_id")) & (F.col("k.parent_id") == F.col("p.node_id")))
    assert kids.filter("k.pre <= p.pre or k.last > p.last or k.depth <> p.depth + 1").count() == 0
    below = n.alias("a").join(n.alias("b"), (F.col("a.page_id") == F.col("b.page_id")) & F.expr("b.pre > a.pre and b.pre <= a.last"))
    sizes = below.groupBy("a.page_id", "a.pre").agg(F.count("*").alias("c"), F.first("a.last").alias("l"))
    assert sizes.filter("c <> l - pre").count() == 0
    n.unpersist()


def test_many_attributes_kept(spark):
    many = "<p " + " ".join(f"a{i}=v{i}" for i in range(16)) + " onclick=x>t</p>"
    at = shred.attributes(nodes(spark, many)).orderBy("ordinal").collect()
    assert len(at) == 17 and at[16].name == "onclick" and at[16].ordinal == 16


def test_fragments(spark):
    df = table(spark, ["<tr><td>x</td></tr><li>a<li>b", "text only", "<option>1<option>2", "<td>c", ""])
    frag = shred.shred_fragments(df, "html", "table")
    got = {r.page_id: r.html for r in serialize.to_html(frag).collect()}
    assert got == {0: "<tr><td>x</td></tr><li>a</li><li>b</li>", 1: "text only", 2: "<option>1</option><option>2</option>",
                   3: "<td>c</td>"}
    assert frag.select("context").distinct().collect()[0].context == "table"
    try:
        shred.shred_fragments(df, "html", "nowhere")
        raise AssertionError
    except ValueError:
        pass


def test_templates_stay_outside(spark):
    n = nodes(spark, "<template id=t><p>in<template><i>deep</i></template></p></template><p>out</p>")
    assert shred.templates(n).count() == 2
    assert shred.template_content(n).filter("tag is not null").select("tag").orderBy("pre").collect() == [("p",), ("template",), ("i",)]
    tree = {r.tag: (r.tree_id, r.owner_id, r.parent_id) for r in n.filter("tag in ('i', 'template')").orderBy("pre").collect()}
    assert tree["i"][2] is None and tree["i"][0] == tree["i"][1] + 1
    got = {r.template_html for r in serialize.inner_template_html(n).collect()}
    assert got == {"<p>in<template><i>deep</i></template></p>", "<i>deep</i>"}


def test_deep_and_wide_pages(spark):
    deep = "<div>" * 3000 + "x"
    wide = "<ul>" + "".join(f"<li><t{i % 700}-x>{i}" for i in range(3000)) + "</ul>"
    broken = "".join(f"<table><tr><td><font size={i}>" for i in range(150))
    n = nodes(spark, deep, wide, broken)
    got = {r.page_id: (r.n, r.d) for r in n.groupBy("page_id").agg(F.count("*").alias("n"), F.max("depth").alias("d")).collect()}
    assert got[0] == (3004, 3002) and got[1][0] >= 9004
    assert shred.shred_errors(n).count() == 0
    html = {r.page_id: r.html for r in serialize.to_html(n).collect()}
    assert html[0].count("</div>") == 3000
