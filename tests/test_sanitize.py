"""Sanitiser modes, audit rules and specification."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import body_inner, nodes, table
from pageframe.functions import spec
from pageframe.operators import audit, sanitize, serialize, shred, template

# One document per rule: markup, and the modes in which a trace of it may stay.
RULES = {
    "event handler": ('<p onfocus="go1()" lang="en">one</p>', "onfocus", ()),
    "script": ("<p>two</p><script>go2()</script>", "go2", ("minimum", "custom")),
    "style element": ("<p>three</p><style>p{color:red3}</style>", "red3", ("minimum", "custom")),
    "style attribute": ('<p style="color:red4">four</p>', "red4", ()),
    "comment": ("<p>five</p><!-- note5 -->", "note5", ("minimum", "custom")),
    "script address": ('<a href="javascript:go6()">six</a>', "go6", ()),
    "hidden script address": ('<a href=" jAvA&#x9;script:go7()">seven</a>', "go7", ()),
    "base64 address": ('<img alt="eight" src="data:image/svg+xml;base64,Z284">', "Z284", ()),
    "open iframe": ('<p>nine</p><iframe src="https://nine.test/"></iframe>', "nine.test", ()),
    "embedded object": ('<p>ten</p><object data="go10"></object>', "go10", ()),
    "svg script": ('<svg><rect width="1"></rect><script>go11()</script></svg>', "go11", ()),
    "svg foreign content": ("<svg><foreignObject>go12</foreignObject></svg>", "go12", ()),
    "svg handler": ('<svg onload="go13()"><rect></rect></svg>', "go13", ()),
    "custom element": ("<p>fourteen</p><own-box>go14</own-box>", "go14", ("minimum", "permissive", "custom")),
    "template content": ('<p>t</p><template><b onblur="go15()">fifteen</b></template>', "go15", ()),
}
KEPT = ["<p>sixteen</p>", '<a href="https://seventeen.test/">x</a>', "<pre> a\n b </pre>", "<svg><rect></rect></svg>",
        '<table><tbody><tr><td>y</td></tr></tbody></table>', "<p>u</p><template><i>z</i></template>"]
ALL = [html for html, _, _ in RULES.values()]


def _mode(name):
    return sanitize.SanitizerOptions(False, False, False, True, True) if name == "custom" else name


@pytest.mark.parametrize("mode", ["minimum", "strict", "permissive", "custom"])
def test_rules(spark, mode):
    n = sanitize.sanitize(nodes(spark, *ALL, *KEPT), _mode(mode))
    html = body_inner(n)
    for (name, (_, trace, allowed)), got in zip(RULES.items(), html):
        assert (trace in got) == (mode in allowed), (name, got)
    assert html[len(RULES):] == KEPT
    assert body_inner(sanitize.sanitize(n, _mode(mode))) == html
    assert n.join(n, ["page_id", "node_id"]).count() == n.count()


def test_compat_removes_code(spark):
    opts = sanitize.SanitizerOptions(False, False, False, False, True, compat=True)
    n = sanitize.sanitize(nodes(spark, "<p>x</p><script>s</script><style>t</style>"), opts)
    assert body_inner(n) == ["<p>x</p>"]


def test_iframes(spark):
    kept = ['<iframe sandbox src="https://one.test/a">one</iframe>', "<iframe sandbox>two</iframe>"]
    gone = ['<iframe src="https://one.test/a">three</iframe>', '<iframe sandbox src=" vbscript:1 javascript:1">four</iframe>'.replace("vbscript:1 ", ""),
            '<iframe sandbox src="data:text/html,five"></iframe>', "<iframe></iframe>"]
    got = body_inner(sanitize.sanitize_strict(nodes(spark, *kept, *gone)))
    assert got == kept + [""] * len(gone)


def test_fixed_limits_and_context(spark):
    many = "".join(f"<script>{i}</script>" for i in range(40)) + "<p>end</p>"
    attrs = "<p " + " ".join(f"data-{i}=v" for i in range(16)) + " onclick=x>t</p>"
    leak = '<div><svg></svg></div><p onerror="x">a</p><x-y>b</x-y>'
    scheme = '<a href="/a" title=" java\tscript:x">c</a><a href="JAVASCRIPT:1">d</a>'
    got = body_inner(sanitize.sanitize_permissive(nodes(spark, many, attrs, leak, scheme)))
    assert got[0] == "<p>end</p>" and "onclick" not in got[1] and got[1].count("data-") == 16
    assert got[2] == "<div><svg></svg></div><p>a</p><x-y>b</x-y>" and got[3] == '<a href="/a">c</a><a>d</a>'


def test_unlisted_elements(spark):
    got = body_inner(sanitize.sanitize_strict(nodes(spark, "<label>x</label><small>y</small><p>z<object>o</object></p><g>q</g>")))
    assert got == ["<p>z</p>"]


def test_fragment_form_agrees(spark):
    df = table(spark, [*ALL, "<p onclick=x>a</p>", "plain & simple", "", None, "<script>gone</script>"])
    for mode in ("none", "minimum", "strict", "permissive"):
        whole = serialize.to_html(shred.shred_fragments(df, "html", sanitize=mode), df)
        local = template.sanitize_column(df, "html", mode)
        a = {r.page_id: r.html for r in whole.collect()}
        assert a == {r.page_id: r.html for r in local.collect()} and len(a) == df.count(), mode


def test_dangerous_findings_gone(spark):
    page = "".join(ALL)
    clean = sanitize.sanitize_strict(nodes(spark, page))
    assert audit.audit_attributes(clean).filter("verdict = 'dangerous'").count() == 0
    report = {(r.kind, r.reason): r.n for r in audit.scan_pages(nodes(spark, page)).collect()}
    assert report[("node", "custom element")] == 1 and report[("node", "comment")] == 1
    assert report[("attribute", "event handler")] >= 3


def test_attribute_rules(spark):
    rows = [
        ("p", "id", "x", True, True), ("p", "hx-get", "/", True, True), ("p", "onclick", "x", False, False),
        ("p", "href", "x", False, False), ("a", "target", "_blank", True, True), ("a", "target", "other", True, False),
        ("th", "scope", "col", True, True), ("th", "scope", "invalid", True, False), ("div", "aria-label", "x", True, True),
        ("button", "disabled", "", True, True), ("button", "disabled", "x", True, False), ("label", "for", "x", False, False),
        ("div", "dir", "up", True, False), ("input", "type", "email", True, True), ("img", "loading", "unknown", True, False),
        ("circle", "r", "1", True, True), ("blink", "id", "x", False, False), ("span", "x-on:click", "a", True, True),
    ]
    df = spark.createDataFrame(rows, "tag string, name string, value string, allowed boolean, valid boolean")
    got = df.select("*", spec.attribute_allowed("tag", "name").alias("a"), spec.attribute_value_valid("tag", "name", "value").alias("v"))
    assert got.filter("a <> allowed or v <> valid").collect() == []
    values = [("javascript:x", True), ("\"JAVASCRIPT:x\"", True), ("x <SCRIPT", True), ("data:image/png;base64,x", True),
              ("data:text/plain,x", False), ("file:///x", True), ("//host", True), ("https://x", False), ("y" * 2000 + "vbscript:", True)]
    df = spark.createDataFrame(values, "v string, want boolean").withColumn("got", spec.is_dangerous_value("v"))
    assert df.filter("got <> want").collect() == []
    known = spark.createDataFrame([("class", True), ("onclick", False), ("aria-x", True), ("data-", False), ("hx-a", True), ("zzz", False)],
                                  "n string, want boolean").withColumn("got", spec.is_known_attribute("n"))
    assert known.filter("got <> want").collect() == []
    assert spec.allowed_attributes(spark, "button").count() == 18 and spec.spec_elements(spark).count() == len(spec.ELEMENTS)
    with pytest.raises(ValueError):
        sanitize.options("loose")


def test_text_of_pages_with_gaps_in_their_numbers(spark):
    from pageframe.operators import text
    n = nodes(spark, "<p>a<script>s</script>b<i>c</i></p><!--x--><div><style>t</style>d</div>", "<script>1</script>", "e")
    for where in (F.col("tag") == "body", F.col("tag").isin("p", "i", "div"), F.col("node_type") == "text"):
        gaps = text.text_content(sanitize.sanitize(n, "strict", reindex=False), where, dense=False)
        whole = text.text_content(sanitize.sanitize(n, "strict"), where)
        assert sorted((r.page_id, r.text_content) for r in gaps.collect()) == sorted((r.page_id, r.text_content) for r in whole.collect())
