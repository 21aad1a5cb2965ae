"""Selectors, search and axes on small documents."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import nodes
from pageframe.operators import axes, search, select

DOC = ("<section id=S><p class='x z'> </p><p id='y'>abc</p><p></p><p><!-- c --></p></section>"
       "<ul><li>1</li><li>2<b>q</b></li><li>3</li><li>4</li></ul>"
       "<div lang=en-US title='a b'><a href='/p'>one</a><a href='http://h/x.pdf' target=_top>Two</a><span>s</span></div>"
       "<form><fieldset><input disabled><legend>l</legend><i disabled>i</i></fieldset>"
       "<fieldset><legend>m</legend><em disabled>e</em></fieldset></form>")

COUNTS = [
    ("*", 24), ("p", 4), ("P", 4), (".x", 1), (".X.z", 1), ("#Y", 1), ("section p", 4), ("section > p", 4), ("body p", 4),
    ("ul > li:nth-child(2)", 1), ("ul > li", 4), ("ul > li:first-child", 1), ("li:last-child", 1), ("li:nth-child(odd)", 2),
    ("li:nth-child(n+3)", 2), ("li:nth-last-child(1)", 1), ("li:nth-child(-n+1)", 1), ("li:nth-child(3n)", 1),
    ("a:nth-of-type(2)", 1), ("a:nth-last-of-type(2)", 1), ("span:only-of-type", 1), ("b:only-child", 1),
    ("li + li", 3), ("li ~ li", 3), ("p + ul", 0), ("section + ul", 1), ("section ~ form", 1), ("ul b", 1), ("ul > b", 0),
    (".x, section:has(p[id=Y i])", 2), ("p:blank", 3), ("p:empty", 2), (":root", 0), ("section:has(> p)", 1),
    ("ul:has(> b)", 0), ("ul:has(li > b)", 1), ("li:has(+ li)", 3), ("li:has(~ li > b)", 1), ("section:has(~ form)", 1),
    ("li:not(:has(b))", 3), ("li:not(:first-child):not(:last-child)", 2), (":is(ul, form) li", 4), (":where(a, span)", 3),
    ("[href]", 2), ("[href='/p']", 1), ("[href^='http']", 1), ("[href$='.PDF' i]", 1), ("[href$='.PDF']", 0),
    ("[href*=h]", 1), ("[title~=b]", 1), ("[title~='a b']", 0), ("[lang|=en]", 1), ("[lang|=e]", 0), ("[href^='']", 0),
    (":any-link", 2), (":disabled", 2), ("em:disabled", 0), ("i:disabled", 1), ("em:enabled", 1), ("a:visited, a:target", 0),
    (":contains('two' i)", 1), ("a:contains('two')", 0), ("p:vendor-contains(\"abc\")", 1), ("p:dir(ltr)", 0),
    ("li:nth-child(1 of :has(b))", 1), ("li:nth-last-child(2 of li)", 1), ("p::before", 0), ("section>p+p", 3),
]


def test_counts(spark):
    got = select.match_counts(nodes(spark, DOC), {f"q{i}": s for i, (s, _) in enumerate(COUNTS)}).first()
    assert {s: got[f"q{i}"] for i, (s, _) in enumerate(COUNTS)} == dict(COUNTS)


def test_pruned_and_flagged_forms_agree(spark):
    n = nodes(spark, DOC).cache()
    for s in ("ul > li:nth-child(2)", "li:has(~ li > b)", "p:blank", "section + ul", "li + li, b", ":disabled", "section>p+p"):
        picked = {r.node_id for r in select.select_all(n, s).collect()}
        flagged = {r.node_id for r in select.flag_nodes(n, s).filter("matches and in_body").collect()}
        assert picked == flagged == {r.node_id for r in select.select_all(n, s).collect()}, s
    assert n.count() == select.flag_nodes(n, "ul > li, p:empty").count()
    n.unpersist()


def test_scope_and_errors(spark):
    n = nodes(spark, "<title>t</title><template><p>x</p></template><p>y</p>")
    assert select.select_all(n, "title").count() == 0 and select.select_all(n, "title", "document").count() == 1
    assert select.select_all(n, "p").count() == 1
    assert [r.tag for r in select.select_all(n, ":root", "document").collect()] == ["html"]
    for bad in ("p >", "p,,a", "[x", ":nth-child(q)", ":unknown(1)", "a || b", ""):
        with pytest.raises(ValueError):
            select.select_all(n, bad)


def test_within_filter_matches(spark):
    n = nodes(spark, '<div class="container"><div class="box">B</div><p>1</p><p>2</p></div>')
    sel = n.filter("tag in ('div', 'p')")
    assert select.select_within(n, sel, ".box").count() == 2
    assert select.select_within(n, sel, "div").count() == 3
    assert select.filter_nodes(n, sel, ".box").count() == 1 and select.filter_nodes(n, sel, "div").count() == 2
    flags = {r.node_id: r.matches for r in select.node_matches(n, n, "p").collect()}
    assert sum(flags.values()) == 2 and len(flags) == n.count()
    assert [r.matches for r in select.page_matches(n, "p + p").collect()] == [True]


def test_search(spark):
    n = nodes(spark, '<h1 class="main">H</h1><p class="main-text MAIN" id="a" name="n">x</p><p id="a" DATA-Role="r" title=Main>y</p>'
                     '<footer class="main-footer" data-role="q">f</footer>')
    ids = lambda d: [r.tag for r in d.orderBy("pre").collect()]
    assert ids(search.elements_by_class(n, "main")) == ["h1"]
    assert ids(search.elements_by_tag(n, "P")) == ["p", "p"] and ids(search.elements_by_tag(n, "body")) == []
    assert ids(search.elements_by_id(n, "a")) == ["p", "p"] and ids(search.elements_by_name(n, "n")) == ["p"]
    assert ids(search.elements_by_attribute(n, "title", "main")) == []
    assert ids(search.elements_by_attribute(n, "title", "main", True)) == ["p"]
    assert ids(search.elements_with_attribute(n, "data-role")) == ["p", "footer"]
    assert search.first_by_id(n, "a").first().classes == ["main-text", "MAIN"]
    assert ids(search.first_by_data_attribute(n, "data", "role")) == ["p"]
    assert ids(search.first_by_data_attribute(n, "data", "role", "q")) == ["footer"]
    assert ids(search.first_by_attribute(n, "class", "main-footer")) == ["footer"]
    assert ids(search.first_by_class(n, "MAIN")) == ["p"] and ids(search.first_by_tag(n, "footer")) == ["footer"]
    up = search.map_elements(n, tag=F.upper("tag"))
    assert up.filter("tag = 'FOOTER'").count() == 1 and up.count() == n.count()


def test_axes(spark):
    n = nodes(spark, "<ul>a<li>1</li><!-- c --><li>2<b>x</b></li>z</ul>").cache()
    names = lambda d: [r.tag or r.node_type for r in d.orderBy("pre").collect()]
    ul = n.filter("tag = 'ul'")
    assert names(axes.child_nodes(n, ul)) == ["text", "li", "comment", "li", "text"]
    assert names(axes.children(n, ul)) == ["li", "li"]
    assert names(axes.first_child(n, ul)) == ["text"] and names(axes.last_child(n, ul)) == ["text"]
    assert axes.last_element_child(n, ul).first().elem_idx == 2
    assert names(axes.next_sibling(n, n.filter("tag = 'li' and elem_idx = 1"))) == ["comment"]
    assert names(axes.next_element_sibling(n, n.filter("tag = 'li' and elem_idx = 1"))) == ["li"]
    assert names(axes.parent(n, n.filter("tag = 'b'"))) == ["li"]
    assert names(axes.ancestors(n, n.filter("tag = 'b'"))) == ["html", "body", "ul", "li"]
    assert names(axes.descendants(n, n.filter("tag = 'li' and elem_idx = 2"))) == ["text", "b", "text"]
    links = {r.node_id: (r.prev_id, r.next_id) for r in axes.with_siblings(n).collect()}
    kids = [r.node_id for r in axes.child_nodes(n, ul).orderBy("pre").collect()]
    assert [links[k] for k in kids] == [(kids[i - 1] if i else None, kids[i + 1] if i < 4 else None) for i in range(5)]
    n.unpersist()


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


ONE_PASS = ["edge_children", "sibling_axis", "parent_axis", "list_children", "select_within", "filter_nodes", "node_matches", "ancestor_axis",
            "descendant_axis", "page_roots", "page_matches", "link_hosts", "page_links", "elements_by_id_name", "replace_text"]


@pytest.mark.parametrize("name", ONE_PASS)
def test_one_scan_and_one_kernel(spark, name):
    from pageframe.plans import queries
    plan = plan_of(queries.REGISTRY[name](spark, "/root/testdata/sf0.001"))
    assert plan.count("Relation [") == 1 and plan.count("_page_tree(") <= 2, plan   # the kernel, and once more where its column is named
    assert "Join" not in plan


def test_axes_of_selections_of_every_kind(spark):
    """A Column, a selector and a table of keys give the same rows; several steps give what each gives alone."""
    n = nodes(spark, "<ul id=u>a<li>1<li class=x>2 <b>3</b><!--c--><li>4</ul><p>q<p class=x>r<template><i>t<b>u</b></i></template>", "<p>z").cache()
    picks = [(F.col("tag") == "li", "li"), (F.array_contains("classes", "x") & (F.col("tree_id") == 0), ".x"), (F.col("tag") == "body", "body")]
    for i, axis in enumerate([*axes._UP, *axes._DOWN, *axes._ALONG]):
        column, selector = picks[i % 3]
        step = getattr(axes, axis)
        both = axes.walk(n, one=(axis, column), two=("children", F.lit(True)), three=("parent", F.col("tag") == "b"), four=("previous_sibling", F.col("tag") == "li"))
        want = sorted(map(str, both.filter("axis = 'one'").drop("axis").collect()))
        assert want == sorted(map(str, step(n, selector).collect())) == sorted(map(str, step(n, n.filter(column)).collect()))
    with pytest.raises(ValueError):
        axes.walk(n, step=("uncle", "li"))


def test_axes_equal_brute_force(spark):
    n = nodes(spark, "<div><p>1<b>2</b>3<!--4--></p><p><i>5</i><i>6</i></p></div><template><p>7<q>8</q></p>9</template>" * 3).cache()
    rows = n.collect()
    by = {(r.tree_id, r.node_id): r for r in rows}
    family = {}
    for r in sorted(rows, key=lambda r: r.pre):
        family.setdefault((r.tree_id, r.parent_id), []).append(r)

    def beside(r, by_, elements):
        line = [x for x in family[r.tree_id, r.parent_id] if not elements or x.node_type == "element"]
        at = next((i for i, x in enumerate(line) if x.node_id == r.node_id), None)
        return [] if at is None or not 0 <= at + by_ < len(line) else [line[at + by_]]

    def kids(r, elements):
        return [x for x in family.get((r.tree_id, r.node_id), []) if not elements or x.node_type == "element"]
    expected = {
        "parent": lambda r: [by[r.tree_id, r.parent_id]] if r.parent_id is not None else [],
        "child_nodes": lambda r: kids(r, False), "children": lambda r: kids(r, True), "first_child": lambda r: kids(r, False)[:1],
        "last_child": lambda r: kids(r, False)[-1:], "first_element_child": lambda r: kids(r, True)[:1], "last_element_child": lambda r: kids(r, True)[-1:],
        "next_sibling": lambda r: beside(r, 1, False), "previous_sibling": lambda r: beside(r, -1, False),
        "next_element_sibling": lambda r: beside(r, 1, True), "previous_element_sibling": lambda r: beside(r, -1, True)}
    for axis, of in expected.items():
        got = sorted((r.tree_id, r.of_node_id, r.node_id) for r in getattr(axes, axis)(n, F.lit(True)).collect())
        assert got == sorted((r.tree_id, r.node_id, x.node_id) for r in rows for x in of(r)), axis
    inside = lambda a, r: a.tree_id == r.tree_id and a.pre < r.pre <= a.last
    pairs = sorted((a.tree_id, a.node_id, r.node_id) for a in rows for r in rows if a.node_type == "element" and inside(a, r))
    assert sorted((r.tree_id, r.node_id, r.of_node_id) for r in axes.ancestors(n, F.lit(True)).collect()) == pairs
    assert sorted((r.tree_id, r.of_node_id, r.node_id) for r in axes.descendants(n, F.col("node_type") == "element").collect()) == pairs
    flagged = {(r.tree_id, r.node_id) for r in axes.flag_children(n, F.col("tag") == "p", "below").filter("below").collect()}
    assert flagged == {(r.tree_id, r.node_id) for r in rows if r.parent_id is not None and by[r.tree_id, r.parent_id].tag == "p"}


def test_node_sets_nest(spark):
    """Roots within roots, roots that match themselves, template roots: once per (root, match)."""
    n = nodes(spark, "<div id=a><div id=b><p>1<p id=c>2</div><p>3</div><p>4<template><div id=d><p>5</div></template>").cache()
    rows = n.collect()
    roots = [r for r in rows if r.tag in ("div", "p")]
    want = sorted((a.node_id, r.node_id) for a in roots for r in rows
                  if r.tag in ("p", "div") and r.tree_id == 0 == a.tree_id and a.pre <= r.pre <= a.last)
    for where in (F.col("tag").isin("div", "p"), n.filter("tag in ('div', 'p')")):
        got = select.select_within(n, where, "p, div", name=F.col("tag")).collect()
        assert sorted((r.root_node_id, r.node_id) for r in got) == want
        assert {r.name for r in got} == {"div", "p"}
    assert select.select_within(n, "div, p", "p, div").count() == len(want)
    assert {r.id for r in select.filter_nodes(n, "div, p", "div > p + p, #a").collect()} == {"a", "c"}
    assert select.node_matches(n, F.col("tag") == "p", "p:first-child").filter("matches").count() == 1
