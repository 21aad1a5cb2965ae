"""Bulk edits, templates and rendering."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import body_inner, body_outer, nodes
from pageframe.operators import rewrite as R, select, serialize, shred, template, text

LIST = '<ul><li id="1">First</li></ul>'


def _dense(n):
    bad = n.groupBy("page_id").agg(F.count("*").alias("n"), F.max("pre").alias("m"), F.countDistinct("node_id").alias("d"))
    return bad.filter("n <> m + 1 or n <> d").count() == 0


def test_numbering_after_edits_equals_fresh_shred(spark):
    n = nodes(spark, '<div id="t">a<b>c</b></div><p>z</p>', "<ul><li>1<li>2<li>3</ul>")
    n = R.insert_adjacent_html(n, "div, li:nth-child(2)", "beforebegin", "<i>x<u>y</u></i>w")
    n = R.remove_nodes(n, "b, li:first-of-type")
    n = R.append_child(n, "p, ul", R.new_element("img"))
    fresh = shred.shred(serialize.to_html(n))
    cols = ["page_id", "pre", "last", "depth", "sib_idx", "elem_idx", "elem_cnt", "type_idx", "type_cnt", "tag", "text", "in_body"]
    assert _dense(n)
    assert n.select(cols).exceptAll(fresh.select(cols)).count() == 0 and n.count() == fresh.count()


def test_insertions(spark):
    n = nodes(spark, LIST)
    both = R.insert_after(R.insert_before(n, F.col("id") == "1", R.new_element("li", {"id": "0"})), "#1", R.new_element("li", {"id": "2"}))
    assert body_outer(both) == ['<body><ul><li id="0"></li><li id="1">First</li><li id="2"></li></ul></body>']
    t = nodes(spark, '<div id="target">Target Content</div>')
    for pos, h in (("beforebegin", "<p>1</p><p>2</p>"), ("afterbegin", "<span>3</span>"), ("beforeend", "<span>4</span>"), ("afterend", "<p>5</p>")):
        t = R.insert_adjacent_html(t, "#target", pos, h)
    assert body_inner(t) == ['<p>1</p><p>2</p><div id="target"><span>3</span>Target Content<span>4</span></div><p>5</p>']
    with pytest.raises(ValueError):
        R.insert_adjacent_html(n, "ul", "middle", "x")
    el = R.new_element("DIV", [("id", "a"), ("hidden", ""), ("disabled", None)])
    assert body_inner(R.append_children(n, "ul", [el, R.new_text("a<b"), R.new_comment("c")])) == [
        '<ul><li id="1">First</li><div id="a" hidden="" disabled></div>a&lt;b<!--c--></ul>']


def test_many_inserts_at_one_point(spark):
    n = nodes(spark, LIST)
    n = R.append_children(n, "ul", [R.new_element("li", {"id": f"x{i}"}) for i in range(30)])
    ids = [r.id for r in select.select_all(n, "li").orderBy("pre").collect()]
    assert ids == ["1"] + [f"x{i}" for i in range(30)] and _dense(n)


def test_content_replacement(spark):
    n = nodes(spark, "<div>a<p>b</p></div><script>x</script>")
    assert body_inner(R.set_inner_html(n, "div", "<li>1<li>2")) == ["<div><li>1</li><li>2</li></div><script>x</script>"]
    assert body_inner(R.set_inner_html(n, "div", "")) == ["<div></div><script>x</script>"]
    assert body_inner(R.set_text(n, "div, script", "1 < 2")) == ["<div>1 &lt; 2</div><script>1 < 2</script>"]
    assert body_inner(R.replace_children(n, "div", R.new_element("hr"))) == ["<div><hr></div><script>x</script>"]
    safe = R.set_inner_html_safe(n, "div", "<script>1</script><p onclick=a>k</p><!-- c -->", "strict")
    assert body_inner(safe) == ["<div><p>k</p></div><script>x</script>"]
    assert body_inner(R.replace_text(n, F.col("text") == "b", "new")) == ["<div>a<p>new</p></div><script>x</script>"]
    assert R.replace_text_errors(n, "p").count() == 1
    assert serialize.to_html(R.clear_document(n)).first().html == "<html><head></head><body></body></html>"


def test_attributes_and_classes(spark):
    n = nodes(spark, '<p id=a class="x y" data-k>t</p>')
    html = lambda m: body_inner(m)[0]
    assert html(R.set_attributes(n, "p", {"id": "b", "lang": "en"})) == '<p id="b" class="x y" data-k lang="en">t</p>'
    assert html(R.remove_attribute(n, "p", "ID")) == '<p class="x y" data-k>t</p>'
    assert html(R.remove_attribute(n, "p", "none")) == html(n)
    assert 'class="x y z"' in html(R.add_class(n, "p", "z")) and 'class="x y"' in html(R.add_class(n, "p", "x"))
    assert html(R.add_class(n, "p", "a b")) == html(n) and html(R.add_class(n, "p", "")) == html(n)
    assert 'class="y"' in html(R.remove_class(n, "p", "x")) and 'class="y"' in html(R.toggle_class(n, "p", "x"))
    assert 'class="x y q"' in html(R.toggle_class(n, "p", "q")) and 'class="q y"' in html(R.replace_class(n, "p", "x", "q"))
    assert html(R.replace_class(n, "p", "none", "q")) == html(n) and 'class=""' in html(R.clear_classes(n, "p"))
    assert R.add_class(n, "p", "z").filter("tag = 'p'").first().classes == ["x", "y", "z"]


def test_values_from_a_table(spark):
    n = nodes(spark, "<p>a</p>", "<p>b</p>")
    names = spark.createDataFrame([(0, "zero"), (1, "one")], "page_id long, name string")
    sel = select.select_all(n, "p").select("page_id", "tree_id", "node_id").join(names, "page_id")
    assert body_inner(R.set_attribute(n, sel, "title", F.col("name"))) == ['<p title="zero">a</p>', '<p title="one">b</p>']


def test_copies(spark):
    n = nodes(spark, '<ul><li>a<b>c</b></li></ul><ol></ol>', "<ol></ol>")
    same = R.copy_subtree(n, select.select_all(n, "li"), "ol")
    assert body_inner(same) == ['<ul><li>a<b>c</b></li></ul><ol><li>a<b>c</b></li></ol>', "<ol></ol>"] and _dense(same)
    pages = spark.createDataFrame([(1, 0)], "page_id long, from_page_id long")
    other = R.copy_subtree(n, select.select_all(n, "li"), "ol", pages=pages)
    assert body_inner(other)[1] == "<ol><li>a<b>c</b></li></ol>"


def test_templates(spark):
    n = nodes(spark, '<dl class="g"><dt>Zinc</dt></dl><template class="entry"><dd>30 <i>Zn</i></dd></template>')
    used = R.instantiate_template(n, shred.templates(n), "dl", times=2)
    entry = "<dd>30 <i>Zn</i></dd>"
    assert body_inner(used) == [f'<dl class="g"><dt>Zinc</dt>{entry}{entry}</dl><template class="entry">{entry}</template>']
    assert _dense(used) and select.select_all(used, "dd").count() == 2
    bad = nodes(spark, "<template><li onclick=x>a<script>s</script></li><template><b>q</b></template></template><ul></ul>")
    safe = R.instantiate_template(bad, bad.filter("tag = 'template' and tree_id = 0"), "ul", mode="strict")
    assert body_inner(safe) == ["<ul><li>a</li><template><b>q</b></template></ul>"] or \
        body_inner(safe)[0].endswith("<ul><li>a</li><template><b>q</b></template></ul>")
    mixed = R.parse_and_append(nodes(spark, LIST), "ul", "<template><li>T</li></template> <li>z</li>", mode="permissive")
    assert body_inner(mixed) == ['<ul><li id="1">First</li><li>T</li> <li>z</li></ul>']
    only = R.use_template_string(nodes(spark, LIST), "ul", "<template><li>T</li><li>U</li></template><p>no</p>")
    assert body_inner(only) == ['<ul><li id="1">First</li><li>T</li><li>U</li></ul>']


def test_rendering(spark):
    df = spark.createDataFrame([(1, "a", "<x>"), (1, "b", None), (2, "c", "{k}")], "g int, k string, v string")
    rows = {r.k: r.html for r in template.render_rows(df, "<p id={k}>{v}{w}</p>").collect()}
    assert rows == {"a": "<p id=a>&lt;x&gt;{w}</p>", "b": "<p id=b>{v}{w}</p>", "c": "<p id=c>{k}{w}</p>"}
    col = {r.k: r.html for r in template.render_rows(df, F.lit("<p id={k}>{v}{w}</p>")).collect()}
    assert col == rows
    pages = template.render_groups(df, "<li>{k}</li>", ["g"], ["k"], header="<ul>", footer="</ul>")
    assert {(r.g, r.html) for r in pages.collect()} == {(1, "<ul><li>a</li><li>b</li></ul>"), (2, "<ul><li>c</li></ul>")}
    many = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    paged = template.render_groups(many, "{id},", ["g"], ["id"], per_page=70, bucket=F.floor(F.col("id") / 64))
    got = sorted((r.g, r.page_no, r.n_rows) for r in paged.collect())
    assert got == sorted((g, p, 70 if p < 7 else 10) for g in (0, 1) for p in range(8))
    text0 = "".join(r.html for r in paged.filter("g = 0").orderBy("page_no").collect())
    assert text0 == "".join(f"{i}," for i in range(0, 1000, 2))
    safe = template.render_rows(df.filter("g = 2"), "<p onclick=x>{k}</p>", mode="strict")
    assert safe.first().html == "<p>c</p>"


def _rows(n):
    cols = ["page_id", "pre", "last", "depth", "sib_idx", "elem_idx", "elem_cnt", "type_idx", "type_cnt", "tag", "text", "in_body", "in_svg", "raw_text", "preserve_ws"]
    return sorted(map(str, n.select(*cols, F.col("tree_id") > 0).collect()))


def test_an_edit_log_equals_one_edit_after_the_other(spark):
    n = nodes(spark, "<ul id=u><li>1<li class=x>2<li>3</ul><p>a<b>c</b></p><pre>k</pre>", "<p><i>q</i></p><ul></ul>").cache()
    log = [("ul", "afterbegin", R.new_element("hr")), ("ul", "afterbegin", "<li>new<b>n</b></li>"), ("li", "beforebegin", R.new_comment("c")),
           ("li", "afterend", R.new_text("t")), ("li", "afterend", "<s>s</s>w"), ("ul", "beforeend", R.new_element("img")), ("ul", "beforeend", "z"),
           ("p", "afterend", "<template><li>in</li></template>"), ("pre", "beforeend", R.new_text(" kept "))]
    given = {w: select.select_all(n, w).select("page_id", "tree_id", "node_id").cache() for w in {w for w, _, _ in log}}
    one = n
    for where, position, value in log:
        one = (R.insert_adjacent_html if isinstance(value, str) else R.insert_adjacent_element)(one, given[where], position, value)
    whole = R.edit(n, *[R.insert(*step) for step in log])
    assert _rows(whole) == _rows(one)
    assert _dense(whole)


def test_removals_and_replacements_in_a_log(spark):
    n = nodes(spark, "<div id=a>x<p>1</p><p id=b>2<i>3</i></p></div><p id=c>4</p>")
    done = R.edit(n, R.remove("#b"), R.insert("#b, i", "beforebegin", "<q>gone</q>"), R.replace_content("#c", ["<u>5", R.new_text("6")]),
                  R.insert("#a", "beforeend", R.markup("<a href='/{n}'>{n} &amp; {t}</a><!--{t}-->", n=F.col("page_id") + 7, t=F.col("id"))),
                  R.insert("#c", "afterend", R.markup("<b onclick=x>{n}</b>", mode="strict", n=F.lit(None).cast("string"))))
    assert body_inner(done) == ['<div id="a">x<p>1</p><a href="/7">7 &amp; a</a><!--a--></div><p id="c"><u>5</u>6</p><b></b>']
    assert body_inner(R.edit(n, R.remove("#a, i"))) == ['<p id="c">4</p>'] and _dense(R.edit(n, R.remove("#a, i")))
    data = R.markup("<p title='{v}'>{v}</p>", v=F.lit("<b>\"&'</b>"))
    again = shred.shred(serialize.to_html(R.edit(nodes(spark, "<ul></ul>"), R.insert("ul", "afterbegin", data))))
    assert [(r.attrs[0].value, r.last - r.pre) for r in again.filter("tag = 'p'").collect()] == [("<b>\"&'</b>", 1)]
    with pytest.raises(ValueError):
        R.insert("p", "somewhere", "x")


def test_copies_nest_and_carry_templates(spark):
    """Selected subtrees within selected subtrees, several targets, every position, content of templates: as from fragments."""
    html = "<ul><li>a<b>c</b><template><i>t<template>u</template></i></template></li><li>d<ul><li>e</li></ul></li></ul><ol><ol></ol></ol><svg><g></g></svg>"
    n = nodes(spark, html, "<ol></ol>", "<li>x</li><ol></ol><pre></pre>").cache()
    for where, target, position in [*(("li, b", "ol, pre", p) for p in R.POSITIONS), ("li li", "b", "beforeend"), ("g", "ol", "afterbegin")]:
        want = R._insert(R._attach(n, target, R.subtrees(n, where)), "_hit", F.col("frags"), position)
        got = R.copy_subtree(n, where, target, position)
        assert _rows(got) == _rows(want), (where, target, position)
    assert _dense(got)
    for times in (2,):
        frags = R.subtrees(n, F.col("tag") == "template", contents=True)
        many = frags.select("page_id", F.flatten(F.array_repeat(F.col("frags"), times)).alias("frags"))
        want = R._insert(R._attach(n, "ol, li", many), "_hit", F.col("frags"), "beforeend")
        got = R.instantiate_template(n, F.col("tag").isNotNull(), "ol, li", times)
        assert _rows(got) == _rows(want) and _dense(got)
    assert _rows(R.instantiate_template(n, "template", "ol", 0)) == _rows(n)


def test_plans_of_edits(spark):
    """One shuffle, one renumbering; copies need no second tree."""
    import re

    from pageframe.plans import queries
    for name in ("insert_items", "insert_banner", "set_inner_html_safe", "copy_subtree", "part_template_use", "set_from_table"):
        plan = queries.REGISTRY[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1 and "Join" not in plan, name
        assert len(re.findall(r"\bWindow \[", plan)) <= 11, name


def test_rows_are_numbered_in_groups_of_any_size(spark):
    """A group over many partitions, equal keys, null groups: positions are 1 to n without gaps and follow the order."""
    rows = spark.range(5000).selectExpr("CASE WHEN id % 10 < 7 THEN 'big' WHEN id % 10 = 8 THEN NULL ELSE concat('g', id % 97) END AS g", "id % 50 AS k", "id").repartition(6)
    got = template.number_rows(rows, ["g"], ["k"]).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append(r)
    assert len(got) == 5000
    for some in groups.values():
        some.sort(key=lambda r: r._pos)
        assert [r._pos for r in some] == list(range(1, len(some) + 1)) and {r._total for r in some} == {len(some)}
        assert [r.k for r in some] == sorted(r.k for r in some)
    parts = template.render_groups(rows, "{id};", ["g"], ["k", "id"], header="<", footer=">")
    assert parts.where("g = 'big'").count() == 1
    whole = parts.where("g = 'big'").first().html
    paged = sorted(template.render_groups(rows, "{id};", ["g"], ["k", "id"], per_page=33).where("g = 'big'").collect(), key=lambda r: r.page_no)
    assert "<" + "".join(r.html for r in paged) + ">" == whole and [r.n_rows for r in paged] == [33] * 106 + [2]
    empty = template.render_groups(rows.limit(0), "{id}", ["g"], ["k"])
    assert empty.count() == 0


def test_parts_of_a_long_group(spark, monkeypatch):
    monkeypatch.setattr(template, "PART_ROWS", 4)
    rows = spark.range(10).selectExpr("'a' AS g", "id")
    got = sorted(template.render_groups(rows, "{id}", ["g"], ["id"], header="[", footer="]").collect(), key=lambda r: r.page_no)
    assert [r.html for r in got] == ["[0123", "4567", "89]"]
