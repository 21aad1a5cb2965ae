"""Tree axes: parents, children, siblings, descendants and ancestors of a selection."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ELEMENT = "node_type = 'element'"

# Axis: which way a row's fields travel, and the test on the row that is returned.
_UP = {"parent": "true", "parent_element": ELEMENT}
_DOWN = {
    "child_nodes": "true", "children": ELEMENT, "first_child": "sib_idx = 1", "last_child": "last = _end",
    "first_element_child": "elem_idx = 1", "last_element_child": f"elem_idx = elem_cnt AND {ELEMENT}"}
_ALONG = {
    "next_sibling": ("sib_idx", 1), "previous_sibling": ("sib_idx", -1),
    "next_element_sibling": ("elem_idx", 1), "previous_element_sibling": ("elem_idx", -1)}


def walk(nodes: DataFrame, **steps) -> DataFrame:
    """Several axis steps in one pass: the rows reached, plus ``axis`` (the step's name) and ``of_node_id``.

    Each step is ``name=(axis, selection)``; axes are parent, parent_element, child_nodes, children,
    first_child, last_child, first_element_child, last_element_child and next_, previous_sibling with their
    _element_ forms.  A selection is a Column, a selector or a DataFrame of node keys; the first two read the
    nodes once, however many steps there are.

    A parent meets its children in one window over the family: flags and positions pass down to the children,
    the parent's own row passes to the children that ask for it.  Siblings look one row aside in the same family."""
    from .rewrite import mark
    fields = [c for c in nodes.columns if c != "page_id"]
    hits, rows, of = {}, nodes, {}
    for i, (name, (axis, where)) in enumerate(steps.items()):
        if axis not in {**_UP, **_DOWN, **_ALONG}:
            raise ValueError(f"unknown axis: {axis}")
        hits[name] = f"_s{i}"
        rows = mark(rows, where, f"_s{i}").select(*nodes.columns, *hits.values())
    up = {n: _UP[a] for n, (a, _) in steps.items() if a in _UP}
    down = {n: _DOWN[a] for n, (a, _) in steps.items() if a in _DOWN}
    along = {n: _ALONG[a] for n, (a, _) in steps.items() if a in _ALONG}
    for name, (index, step) in along.items():
        family = Window.partitionBy("page_id", "tree_id", "parent_id", *(["node_type"] if index == "elem_idx" else []))
        source = F.when(F.col(hits[name]), F.col("node_id"))
        beside = (F.lag if step > 0 else F.lead)(source).over(family.orderBy("sib_idx"))
        rows = rows.withColumn(f"_a{len(of)}", F.when(F.lit(index == "sib_idx") | F.expr(ELEMENT), beside))
        of[name] = f"_a{len(of)}"
    if up or down:
        asks = reduce(or_, [F.col(hits[n]) for n in up], F.lit(False))
        gives = reduce(or_, [F.col(hits[n]) for n in down], F.expr(ELEMENT) if up else F.lit(False))
        takes = F.lit(True) if down or along else asks
        role = F.explode(F.concat(F.when(gives, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")),
                                  F.when(takes, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))))
        rows = rows.withColumn("_role", role).withColumn("_fam", F.when(F.col("_role") == 0, F.col("node_id")).otherwise(F.col("parent_id")))
        family, giver = Window.partitionBy("page_id", "tree_id", "_fam"), F.col("_role") == 0
        passed = {f"_d{i}": F.max(F.when(giver, F.col(hits[n]))).over(family) for i, n in enumerate(down)}
        if "last_child" in [a for a, _ in steps.values()]:
            passed["_end"] = F.max(F.when(giver, F.col("last"))).over(family)
        if up:
            passed["_up"] = F.first(F.when(giver, F.struct(*fields)), ignorenulls=True).over(family)
        rows = rows.withColumns(passed).filter("_role = 1 AND _fam IS NOT NULL" if not along else "_role = 1")
        of |= {n: f"_d{i}" for i, n in enumerate(down)}
    out, plain = [], F.struct(*fields)
    for name, (axis, _) in steps.items():
        if name in up:
            test, row, source = F.col(hits[name]) & F.expr("_up IS NOT NULL"), F.col("_up"), F.col("node_id")
            if axis == "parent_element":
                test = test & F.expr(ELEMENT)
        elif name in down:
            test, row, source = F.col(of[name]) & F.expr("_fam IS NOT NULL") & F.expr(down[name]), plain, F.col("parent_id")
        else:
            test, row, source = F.col(of[name]).isNotNull(), plain, F.col(of[name])
        out.append(F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(name).alias("axis"), source.alias("of_node_id"), row.alias("row"))))
    found = rows.select("page_id", F.explode(F.array_compact(F.array(*out))).alias("_x"))
    return found.select("page_id", "_x.row.*", "_x.axis", "_x.of_node_id")


def _step(axis: str):
    def run(nodes: DataFrame, sel) -> DataFrame:
        return walk(nodes, step=(axis, sel)).drop("axis")
    run.__name__, run.__doc__ = axis, f"Rows on the {axis} axis of the selection, with ``of_node_id`` naming the node they belong to."
    return run


parent, parent_element = _step("parent"), _step("parent_element")
child_nodes, children = _step("child_nodes"), _step("children")
first_child, last_child = _step("first_child"), _step("last_child")
first_element_child, last_element_child = _step("first_element_child"), _step("last_element_child")
next_sibling, previous_sibling = _step("next_sibling"), _step("previous_sibling")
next_element_sibling, previous_element_sibling = _step("next_element_sibling"), _step("previous_element_sibling")


def children_arrays(nodes: DataFrame, sel) -> DataFrame:
    """(page_id, tree_id, of_node_id, children): element children in order as an array."""
    rows = children(nodes, sel)
    entry = F.struct("elem_idx", "node_id", "tag")
    return rows.groupBy("page_id", "tree_id", "of_node_id").agg(F.sort_array(F.collect_list(entry)).alias("children"))


def flag_children(nodes: DataFrame, sel, name: str) -> DataFrame:
    """All rows plus ``name``: whether the row's parent is selected.  One window over the family, no join."""
    from .rewrite import mark
    hits = mark(nodes, sel, "_give")
    role = F.explode(F.when(F.col("_give"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))))
    rows = hits.withColumn("_role", role).withColumn("_fam", F.when(F.col("_role") == 0, F.col("node_id")).otherwise(F.col("parent_id")))
    family = Window.partitionBy("page_id", "tree_id", "_fam")
    rows = rows.withColumn(name, F.col("_fam").isNotNull() & (F.min("_role").over(family) == 0))
    return rows.filter("_role = 1").select(*nodes.columns, name)


def with_siblings(nodes: DataFrame) -> DataFrame:
    """All rows plus previous/next sibling ids in one window pass (no join)."""
    w = Window.partitionBy("page_id", "tree_id", "parent_id").orderBy("sib_idx")
    return nodes.withColumns({"prev_id": F.lag("node_id").over(w), "next_id": F.lead("node_id").over(w)})


def descendants(nodes: DataFrame, sel) -> DataFrame:
    """Rows strictly below each selected node, root excluded, with ``of_node_id`` naming the root.

    ``sel`` is a Column or selector over ``nodes`` (one pass over them) or a DataFrame of nodes."""
    from .rewrite import mark
    from .select import enclosing
    out = enclosing(mark(nodes, sel), F.col("_hit"), F.lit(True), F.struct("node_id"), inside=True)
    return out.select(*nodes.columns, F.col("_g.node_id").alias("of_node_id"))


def descendant_counts(sel: DataFrame) -> DataFrame:
    """Number of nodes below each selected node, template contents included: ``last - pre``."""
    return sel.withColumn("n_descendants", F.col("last") - F.col("pre"))


def ancestors(nodes: DataFrame, sel) -> DataFrame:
    """Ancestor rows of each selected node within its tree, one row per (node, ancestor); one pass for a Column or selector."""
    from .rewrite import mark
    from .select import enclosing
    fields = [c for c in nodes.columns if c != "page_id"]
    out = enclosing(mark(nodes, sel), F.expr(ELEMENT), F.col("_hit"), F.struct(*fields), inside=True)
    return out.select("page_id", "_g.*", F.col("node_id").alias("of_node_id")).select(*nodes.columns, "of_node_id")


def node_empty(nodes: DataFrame) -> DataFrame:
    """All rows plus ``is_empty``: no element and only blank text or comments below; text, comment
    and void nodes are empty."""
    w = Window.partitionBy("page_id", "tree_id").orderBy(F.col("pre").desc()).rowsBetween(Window.unboundedPreceding, -1)
    solid = (F.col("node_type") == "element") | (
        (F.col("node_type") == "text") & ~F.col("text").rlike(r"^[ \t\n\r\f]*\z"))
    nearest = F.min(F.when(solid, F.col("pre"))).over(w)
    return nodes.withColumn("is_empty", F.coalesce(nearest > F.col("last"), F.lit(True)))
