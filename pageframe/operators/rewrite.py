"""Bulk edits: a selection in, a new ``nodes`` table out.

A selection is a boolean Column over node rows, a CSS selector string, or a DataFrame holding node
keys (its other columns become available to value expressions).  Columns and selectors are applied
in a single pass; only DataFrame selections cost a join.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.node import PRESERVE_TAGS, class_list
from ..schema import KERNEL_NODE, NODE_COLUMNS, NODE_KEY
from .shred import fragment_nodes, with_derived

POSITIONS = ("beforebegin", "afterbegin", "beforeend", "afterend")
NOT_TEXT = "not a text node"
RAW_TEXT = "style script xmp iframe noembed noframes plaintext".split()
_FIELDS = [f.name for f in KERNEL_NODE.fields]
_TYPES = {f.name: f.dataType for f in KERNEL_NODE.fields}


# -- selections ---------------------------------------------------------------------------------------

def mark(nodes: DataFrame, where, name: str = "_hit") -> DataFrame:
    """``nodes`` with a boolean column telling which rows the selection holds."""
    if isinstance(where, Column):
        return nodes.withColumn(name, F.coalesce(where, F.lit(False)))
    if isinstance(where, str):
        from .select import flag_nodes
        return flag_nodes(nodes, where, name)
    extra = [c for c in where.columns if c not in nodes.columns]
    keys = where.select(*NODE_KEY, *extra, F.lit(True).alias(name)).dropDuplicates(NODE_KEY)
    return nodes.join(keys, NODE_KEY, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def _plain(nodes: DataFrame) -> DataFrame:
    return nodes.select("page_id", *NODE_COLUMNS)


# -- numbering ------------------------------------------------------------------------------------------

OPEN_AT, CLOSE_AT = "2 * pre - depth", "2 * last - depth + 1"


def _renumber(nodes: DataFrame, open_key: str, close_key: str) -> DataFrame:
    """Recompute pre/last/depth and sibling positions from orderable open and close keys.

    Every node contributes an open and a close event; running counts over the page's events give the
    interval numbering.  All windows share the page_id distribution, so nothing is shuffled again."""
    events = nodes.selectExpr(
        "page_id", "node_id AS nid", f"struct({', '.join(_FIELDS)}) AS n",
        f"explode(array(named_struct('k', {open_key}, 'e', 0), named_struct('k', {close_key}, 'e', 1))) AS v",
    ).selectExpr("page_id", "nid", "v.k AS k", "v.e AS e", "CASE WHEN v.e = 0 THEN n END AS n")
    run = "OVER (PARTITION BY page_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    counted = events.selectExpr("page_id", "nid", "e", "n", f"int(sum(1 - e) {run} - 1) AS _pre",
                                f"int(sum(1 - 2 * e) {run} - 1) AS _depth")
    opened = counted.selectExpr("page_id", "e", "n", "_pre", "_depth",
                                "lead(_pre) OVER (PARTITION BY page_id, nid ORDER BY e) AS _last").filter("e = 0")
    fresh = {"pre": "_pre", "last": "_last", "depth": "_depth"}
    rows = opened.selectExpr("page_id", *[f"{fresh.get(c, 'n.' + c)} AS {c}" for c in _FIELDS])
    family, elem = "PARTITION BY page_id, tree_id, parent_id", "node_type = 'element'"
    index = {
        "sib_idx": f"row_number() OVER ({family} ORDER BY pre)",
        "elem_idx": f"CASE WHEN {elem} THEN int(sum(int({elem})) OVER ({family} ORDER BY pre ROWS UNBOUNDED PRECEDING)) END",
        "elem_cnt": f"int(sum(int({elem})) OVER ({family}))",
        "type_idx": f"CASE WHEN {elem} THEN row_number() OVER ({family}, tag ORDER BY pre) END",
        "type_cnt": f"CASE WHEN {elem} THEN int(count(*) OVER ({family}, tag)) END",
    }
    rows = rows.selectExpr("page_id", *[f"{index.get(c, c)} AS {c}" for c in _FIELDS])
    return _plain(with_derived(rows))


def renumber_kept(nodes: DataFrame) -> DataFrame:
    """Close the numbering gaps left by removed rows."""
    return _renumber(nodes, OPEN_AT, CLOSE_AT)


def drop_subtrees(nodes: DataFrame, hit: str, keep_root: bool = False) -> DataFrame:
    """Rows outside the flagged subtrees (template contents belong to the subtree).

    Intervals nest, so a row lies in a flagged subtree exactly when the largest ``last`` flagged so
    far in document order reaches it: one running maximum, no ancestor lists."""
    w = Window.partitionBy("page_id").orderBy("pre").rowsBetween(
        Window.unboundedPreceding, -1 if keep_root else 0)
    reach = F.max(F.when(F.col(hit), F.col("last"))).over(w)
    return nodes.withColumn("_reach", reach).filter(
        F.col("_reach").isNull() | (F.col("_reach") < F.col("pre"))).drop("_reach")


# -- node literals ----------------------------------------------------------------------------------------

def _literal(kind: str, tag=None, text=None, attrs=None) -> Column:
    value = {
        "tree_id": 0, "node_id": 0, "pre": 0, "last": 0, "depth": 0, "node_type": kind,
        "ns": "html" if kind == "element" else None, "tag": tag, "text": text, "in_svg": False,
        "preserve_ws": tag in PRESERVE_TAGS, "in_body": True, "raw_text": False,
    }
    if attrs is None:
        attrs = F.array()
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.array(F.struct(*[
        (attrs if n == "attrs" else as_col(value.get(n))).cast(t).alias(n) for n, t in _TYPES.items()]))


def attr_array(attrs: dict | list) -> Column:
    """Attribute literal; values may be Columns, None means no value."""
    items = attrs.items() if isinstance(attrs, dict) else attrs
    pairs = [F.struct(F.lit(n).alias("name"),
                      (v if isinstance(v, Column) else F.lit(v)).cast("string").alias("value")) for n, v in items]
    return F.array(*pairs).cast(_TYPES["attrs"])


def new_element(tag: str, attrs: dict | list = ()) -> Column:
    return _literal("element", tag=tag.lower(), attrs=attr_array(attrs) if attrs else None)


def new_text(value) -> Column: return _literal("text", text=value)
def new_comment(value) -> Column: return _literal("comment", text=value)


# -- insertion ----------------------------------------------------------------------------------------------

def _fresh(j: int, hit: str, position: str) -> str:
    """The nodes that edit ``j`` puts at a flagged row, as SQL text: fragments ``_frags{j}`` with keys in the gap they go to.

    Of edits at one gap the later ones come nearer to the node they were named by, as if applied one after the other."""
    inside = position in ("afterbegin", "beforeend")
    anchor, side = {
        "beforebegin": (f"{OPEN_AT} - 1", 1), "afterbegin": (OPEN_AT, 0),
        "beforeend": (f"{CLOSE_AT} - 1", 1), "afterend": (CLOSE_AT, 0)}[position]
    target = hit if inside else f"{hit} AND parent_id IS NOT NULL"
    raw = f"tag IN ({', '.join(repr(t) for t in RAW_TEXT)})"
    keep = f"tag IN ({', '.join(repr(t) for t in PRESERVE_TAGS)})"
    around = lambda name, own: f"coalesce(f.{name} OR {name if inside else f'({name} AND NOT coalesce({own}, false))'}, false)"
    value = {
        "in_svg": around("in_svg", "tag = 'svg'"), "preserve_ws": around("preserve_ws", keep),
        "in_body": around("in_body", "tag = 'body'"),
        "raw_text": "f.raw_text OR coalesce(f.parent_id IS NULL AND f.node_type = 'text' AND " + (raw if inside else "false") + ", false)",
        "tree_id": "CASE WHEN f.tree_id = 0 THEN tree_id ELSE f.tree_id END",
        "owner_id": "CASE WHEN f.tree_id = 0 THEN owner_id ELSE f.owner_id END",
        "parent_id": "CASE WHEN f.parent_id IS NULL AND f.tree_id = 0 THEN "
                     + ("node_id" if inside else "parent_id") + " ELSE f.parent_id END",
    }
    key = lambda at: f"array({anchor}, {side}, {j if side else -j}, seq, {at})"
    added = ", ".join([
        *[f"{value.get(c, 'f.' + c)} AS {c}" for c in _FIELDS],
        f"{key('2 * f.pre - f.depth')} AS _k", f"{key('2 * f.last - f.depth + 1')} AS _c", "true AS _new",
        "f.parent_id IS NOT NULL OR f.tree_id <> 0 AS _rel", "f.tree_id <> 0 AS _own",
        "CASE WHEN i = 0 THEN array_max(transform(frag, x -> x.node_id)) + 1 END AS _block"])
    return (f"CASE WHEN {target} THEN flatten(transform(_frags{j}, (frag, seq) -> "
            f"transform(frag, (f, i) -> struct({added})))) END")


def _dealt(rows: DataFrame, partitions: int | None) -> DataFrame:
    """Rows with fragments parsed row by row, which have lost the page_id distribution, in so many parts by page."""
    return rows.repartition(partitions, "page_id") if partitions else rows


def _insert_all(nodes: DataFrame, edits: list, partitions: int | None = None) -> DataFrame:
    """Place fragments (arrays of node arrays) at positions of flagged rows: (flag, fragments, position) each, in order.

    All edits share one renumbering: their nodes get keys inside the gaps of the table as given."""
    for _, _, position in edits:
        if position not in POSITIONS:
            raise ValueError(f"unknown insert position: {position}")
    fresh = [_fresh(j, hit, position) for j, (hit, _, position) in enumerate(edits)]
    whole = fresh[0] if len(fresh) == 1 else "concat({})".format(", ".join(f"coalesce({x}, array())" for x in fresh))
    slots = nodes.withColumns({f"_frags{j}": frags for j, (_, frags, _) in enumerate(edits)}).selectExpr(
        "page_id", *_FIELDS, f"{whole} AS _fresh").selectExpr(
        "page_id", *_FIELDS, "explode(CASE WHEN size(_fresh) > 0 THEN concat(slice(array(NULL, _fresh[0]), 1, 1), _fresh) "
        "ELSE slice(array(NULL, try_element_at(_fresh, 1)), 1, 1) END) AS _x")
    slots = _dealt(slots, partitions)
    own = {"_k": f"array({OPEN_AT})", "_c": f"array({CLOSE_AT})", "_new": "false", "_rel": "false", "_own": "false", "_block": "NULL"}
    rows = slots.selectExpr("page_id", *[
        f"CASE WHEN _x IS NULL THEN {own.get(c, c)} ELSE _x.{c} END AS {c}" for c in [*_FIELDS, *own]])
    upto = "OVER (PARTITION BY page_id ORDER BY _k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    based = rows.withColumn("_base", F.expr(
        f"int(max(CASE WHEN NOT _new THEN node_id END) OVER (PARTITION BY page_id) + 1 "
        f"+ sum(coalesce(_block, 0)) {upto} - last(_block, true) {upto})"))
    when = {"node_id": "_new", "parent_id": "_rel", "tree_id": "_own", "owner_id": "_own"}
    rows = based.selectExpr("page_id", "_k", "_c", *[
        f"CASE WHEN {when[c]} THEN {c} + _base ELSE {c} END AS {c}" if c in when else c for c in _FIELDS])
    return _renumber(rows, "_k", "_c")


def _insert(nodes: DataFrame, hit: str, frags: Column, position: str) -> DataFrame:
    return _insert_all(nodes, [(hit, frags, position)])


# -- several edits at once ------------------------------------------------------------------------------------

class Edit(NamedTuple):
    """One step of :func:`edit`; ``position`` is one of POSITIONS, ``inside`` (replace the content) or ``remove``."""
    where: object
    position: str
    value: object = None
    mode: str | None = None


def insert(where, position: str, value, mode=None) -> Edit:
    """Put markup (a string), a literal, a fragment column or a list of those next to or inside the selected nodes."""
    if position not in POSITIONS:
        raise ValueError(f"unknown insert position: {position}")
    return Edit(where, position, value, mode)


def replace_content(where, value, mode=None) -> Edit: return Edit(where, "inside", value, mode)
def remove(where) -> Edit: return Edit(where, "remove")


def _flag_all(nodes: DataFrame, wheres: list) -> tuple[DataFrame, list]:
    """Mark several selections in one pass; equal selectors are evaluated once."""
    names, seen = [], {}
    for i, where in enumerate(wheres):
        key = where if isinstance(where, str) else i
        if key not in seen:
            seen[key] = f"_e{i}"
            nodes = mark(nodes, where, seen[key])
        names.append(seen[key])
    return nodes, names


def edit(nodes: DataFrame, *steps: Edit, partitions: int | None = None) -> DataFrame:
    """Several edits with one renumbering and no further shuffle.

    Every selection refers to ``nodes`` as given: no step sees what another inserted, and what is put at a node that
    another step removes goes with it.  Otherwise the result is that of the steps one after the other.

    ``partitions`` counts the parts of the second shuffle that fragments parsed row by row need, as in ``shred``."""
    rows, flags = _flag_all(nodes, [s.where for s in steps])
    upto = Window.partitionBy("page_id").orderBy("pre").rowsBetween(Window.unboundedPreceding, 0)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    for name, kind, window in (("_gone", "remove", upto), ("_emptied", "inside", before)):
        hit = [F.col(f) for s, f in zip(steps, flags) if s.position == kind]
        if hit:
            rows = rows.withColumn(name, F.max(F.when(reduce(or_, hit), F.col("last"))).over(window))
            rows = rows.filter(F.col(name).isNull() | (F.col(name) < F.col("pre")))
    placed = []
    for step, flag in zip(steps, flags):
        if step.position != "remove":
            rows, frags = _frags_of(rows, step.value, step.mode)
            placed.append((flag, frags, "afterbegin" if step.position == "inside" else step.position))
    return _insert_all(rows, placed, partitions) if placed else renumber_kept(_plain(rows))


def insert_adjacent_element(nodes: DataFrame, where, position: str, element) -> DataFrame:
    """Insert a node literal, fragment column or :func:`markup` (or a list of them) next to or inside every selected node."""
    return edit(nodes, insert(where, position, element))


def insert_before(nodes, where, element): return insert_adjacent_element(nodes, where, "beforebegin", element)
def insert_after(nodes, where, element): return insert_adjacent_element(nodes, where, "afterend", element)
def append_child(nodes, where, element): return insert_adjacent_element(nodes, where, "beforeend", element)
def append_children(nodes: DataFrame, where, elements: list) -> DataFrame: return append_child(nodes, where, elements)


def append_fragment(nodes: DataFrame, where, fragment: Column, partitions: int | None = None) -> DataFrame:
    """Move the children of a fragment (``fragment_nodes`` column) under the selected nodes."""
    return edit(nodes, insert(where, "beforeend", fragment), partitions=partitions)


def fragment_literal(spark, html: str, mode=None) -> Column:
    """Markup as a constant fragment: parsed (and sanitised by ``mode``) once, by a subquery of the query that uses it."""
    one = spark.range(0, 1, 1, 1).select(fragment_nodes(F.lit(html)).alias("f"))
    if mode is not None:
        from .sanitize import sanitize_fragment
        one = sanitize_fragment(one, "f", mode)
    return one.select("f").scalar()


class Markup(NamedTuple):
    """Markup with places; see :func:`markup`."""
    html: str
    mode: str | None
    values: dict


def markup(html: str, mode=None, **values: Column) -> Markup:
    """A fragment whose ``{name}`` places are filled row by row: parsed (and sanitised) once, the values are data and add
    no markup.  Places may stand in text, comments and attribute values; a null value leaves nothing there."""
    return Markup(html, mode, values)


def _frags_of(rows: DataFrame, value, mode=None) -> tuple[DataFrame, Column]:
    """Fragments of one edit's value (a string, :class:`Markup`, literal, fragment column or a list of those), and the
    rows with the constant fragments they need."""
    out = []
    for v in value if isinstance(value, list) else [value]:
        if isinstance(v, str):
            v = Markup(v, mode, {})
        if not isinstance(v, Markup):
            out.append(v if isinstance(v, Column) else F.lit(v))
            continue
        name = f"_constant{sum(c.startswith('_constant') for c in rows.columns)}"
        html, marks = v.html, {n: f"\ue000{i}\ue001" for i, n in enumerate(v.values)}
        for n, mark_ in marks.items():
            html = html.replace("{" + n + "}", mark_)
        rows = rows.withColumn(name, fragment_literal(rows.sparkSession, html, v.mode))

        def fill(text: Column) -> Column:
            return reduce(lambda t, n: F.replace(t, F.lit(marks[n]), F.coalesce(v.values[n].cast("string"), F.lit(""))), v.values, text)

        def one(f):
            attrs = F.transform(f["attrs"], lambda a: F.struct(a["name"].alias("name"), fill(a["value"]).alias("value")))
            return F.struct(*[{"text": fill(f["text"]), "attrs": attrs}.get(n, f[n]).alias(n) for n in _FIELDS])
        out.append(F.transform(name, one) if v.values else F.col(name))
    return rows, F.array(*out)


def _insert_html(nodes, where, html, mode, partitions=None):
    marked, given = mark(nodes, where), isinstance(html, str)
    frag = fragment_literal(nodes.sparkSession, html, mode) if given else fragment_nodes(F.when(F.col("_hit"), html))
    marked = marked.withColumn("_frag", F.when(F.col("_hit"), frag))
    if mode is not None and not given:
        from .sanitize import sanitize_fragment
        marked = sanitize_fragment(marked, "_frag", mode)
    return marked if given else _dealt(marked, partitions)


def insert_adjacent_html(nodes: DataFrame, where, position: str, html, mode=None, partitions: int | None = None) -> DataFrame:
    """Parse ``html`` (literal or Column) as a fragment, sanitise it by ``mode``, insert it; ``partitions`` as in :func:`edit`."""
    if position not in POSITIONS:
        raise ValueError(f"unknown insert position: {position}")
    return _insert(_insert_html(nodes, where, html, mode, partitions), "_hit", F.array("_frag"), position)


def set_inner_html(nodes: DataFrame, where, html, mode=None, partitions: int | None = None) -> DataFrame:
    """Replace the children of every selected element by parsed markup."""
    marked = drop_subtrees(_insert_html(nodes, where, html, mode, partitions), "_hit", keep_root=True)
    return _insert(marked, "_hit", F.array("_frag"), "afterbegin")


def set_inner_html_safe(nodes: DataFrame, where, html, mode="strict") -> DataFrame:
    return set_inner_html(nodes, where, html, mode)


def replace_children(nodes: DataFrame, where, element) -> DataFrame:
    return edit(nodes, replace_content(where, element))


def set_text(nodes: DataFrame, where, value) -> DataFrame:
    """Replace all content of the selected nodes by one text node."""
    return replace_children(nodes, where, new_text(value))


def replace_text(nodes: DataFrame, where, value, report: str | None = None) -> DataFrame:
    """Replace the data of selected text nodes; other selected nodes are left unchanged and reported, on their rows in
    a column named ``report`` or as rows by :func:`replace_text_errors`."""
    value = value if isinstance(value, Column) else F.lit(value)
    marked, text = mark(nodes, where), F.col("node_type") == "text"
    done = marked.withColumn("text", F.when(F.col("_hit") & text, value).otherwise(F.col("text")))
    return done.select("page_id", *NODE_COLUMNS, *([F.when(F.col("_hit") & ~text, NOT_TEXT).alias(report)] if report else []))


def replace_text_errors(nodes: DataFrame, where) -> DataFrame:
    return mark(nodes, where).filter(F.col("_hit") & (F.col("node_type") != "text")).select(
        *NODE_KEY, F.lit(NOT_TEXT).alias("error"))


def remove_nodes(nodes: DataFrame, where, reindex: bool = True) -> DataFrame:
    """Delete the selected nodes with their subtrees."""
    kept = _plain(drop_subtrees(mark(nodes, where), "_hit"))
    return renumber_kept(kept) if reindex else kept


def clear_document(nodes: DataFrame) -> DataFrame:
    """Keep each page's html, head and body elements only."""
    skeleton = ((F.col("tag") == "html") & (F.col("depth") == 0)) | (
        F.col("tag").isin("head", "body") & (F.col("depth") == 1))
    return renumber_kept(nodes.filter((F.col("tree_id") == 0) & skeleton))


# -- subtrees as values -----------------------------------------------------------------------------------------

def _lift(root: Column, part: Column) -> Column:
    """A subtree slice as a stand-alone fragment: positions relative to its root."""
    def one(f):
        value = {n: f[n] for n in _FIELDS}
        for n, by in (("pre", "pre"), ("last", "pre"), ("depth", "depth")):
            value[n] = f[n] - root[by]
        same = f["tree_id"] == root["tree_id"]
        value["tree_id"] = F.when(same, 0).otherwise(f["tree_id"])
        value["owner_id"] = F.when(~same, f["owner_id"])
        value["parent_id"] = F.when(f["node_id"] != root["node_id"], f["parent_id"])
        return F.struct(*[value[n].cast(_TYPES[n]).alias(n) for n in _FIELDS])
    return F.transform(part, one)


def _split(arr: Column, roots: Column) -> Column:
    return F.transform(roots, lambda r: _lift(r, F.slice(arr, r["pre"] + 1, r["last"] - r["pre"] + 1)))


def subtrees(nodes: DataFrame, where, contents: bool = False) -> DataFrame:
    """Per page, the selected subtrees (or their template contents) in order: page_id, frags."""
    pages = mark(nodes, where).groupBy("page_id").agg(
        F.sort_array(F.collect_list(F.struct("pre", *[c for c in _FIELDS if c != "pre"]))).alias("_arr"),
        F.sort_array(F.collect_list(F.when(F.col("_hit"), F.struct("pre", "last")))).alias("_roots"),
    ).filter(F.size("_roots") > 0)
    if contents:
        pages = pages.withColumn("_roots", F.flatten(F.transform("_roots", lambda r: F.filter(
            F.slice(F.col("_arr"), r["pre"] + 2, r["last"] - r["pre"]),
            lambda x: x["parent_id"].isNull()
            & (x["depth"] == F.get(F.col("_arr"), r["pre"])["depth"] + 1)))))
    else:
        pages = pages.withColumn("_roots", F.transform("_roots", lambda r: F.get(F.col("_arr"), r["pre"])))
    return pages.select("page_id", _split(F.col("_arr"), F.col("_roots")).alias("frags"))


def _attach(nodes: DataFrame, where, frags: DataFrame) -> DataFrame:
    return mark(nodes, where).join(frags, "page_id", "left")


def _graft(nodes: DataFrame, source, target, position: str, times: int = 1, contents: bool = False) -> DataFrame:
    """Copies of the ``source`` subtrees (or the contents of the selected templates) at every target of their page.

    One pass and one tree: a row stays, and comes again for each selected subtree that holds it (a stack of open
    subtrees along document order tells which) and each target, under keys in the gap it goes to.  Rows of the
    page's targets are short lists; no page is gathered."""
    if position not in POSITIONS:
        raise ValueError(f"unknown insert position: {position}")
    inside = position in ("afterbegin", "beforeend")
    anchor, side = {"beforebegin": (f"{OPEN_AT} - 1", 1), "afterbegin": (OPEN_AT, 0),
                    "beforeend": (f"{CLOSE_AT} - 1", 1), "afterend": (CLOSE_AT, 0)}[position]
    rows, (src, dst) = _flag_all(nodes, [source, target])
    rows = rows.select("page_id", *_FIELDS, F.col(src).alias("_src"), F.col(dst).alias("_dst"))
    if contents:
        # The owner of a content tree meets its top rows in one window over (page, owner).
        give = F.col("_src") & (F.col("tag") == "template") & (F.col("ns") == "html")
        role = F.explode(F.when(give, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))))
        rows = rows.withColumn("_role", role).withColumn("_fam", F.when(F.col("_role") == 0, F.col("node_id")).when(
            F.col("parent_id").isNull() & (F.col("tree_id") > 0), F.col("owner_id")))
        met = F.col("_fam").isNotNull() & (F.min("_role").over(Window.partitionBy("page_id", "_fam")) == 0)
        rows = rows.withColumn("_src", met).filter("_role = 1").drop("_role", "_fam")
    # Per page: its targets in order, the selected subtrees' levels, and room for new node numbers.
    raw = f"coalesce(tag IN ({', '.join(repr(t) for t in RAW_TEXT)}), false)"
    keep = f"coalesce(tag IN ({', '.join(repr(t) for t in PRESERVE_TAGS)}), false)"
    own = (lambda name, test: name) if inside else (lambda name, test: f"{name} AND NOT coalesce({test}, false)")
    spot = F.expr(f"""named_struct('at', {anchor}, 'up', {'node_id' if inside else 'parent_id'}, 'tree', tree_id, 'owner', owner_id,
        'svg', {own('in_svg', "tag = 'svg'")}, 'ws', {own('preserve_ws', keep)}, 'body', {own('in_body', "tag = 'body'")},
        'raw', {raw if inside else 'false'})""")
    hit = F.col("_dst") if inside else F.col("_dst") & F.col("parent_id").isNotNull()
    page, order = Window.partitionBy("page_id"), Window.partitionBy("page_id").orderBy("pre").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({
        "_spots": F.array_sort(F.collect_list(F.when(hit, spot)).over(page)),
        "_levels": F.collect_set(F.when(F.col("_src"), F.col("depth"))).over(page),
        "_n": F.count_if("_src").over(page), "_stride": F.max(F.greatest("node_id", "tree_id")).over(page) + 1})
    rows = rows.withColumn("_i", F.count_if("_src").over(order))
    # Roles: 0 opens a subtree at its depth, 1 reads the stack at a depth, 2 is the row itself.
    entry = lambda role, level: F.struct(F.lit(role).alias("role"), level.cast("int").alias("level"))
    none = F.array().cast("array<struct<role:int,level:int>>")
    reads = F.transform(F.filter("_levels", lambda level: level <= F.col("depth")), lambda level: entry(1, level))
    spread = F.concat(F.array(entry(2, F.lit(None))), F.when(F.col("_src"), F.array(entry(0, F.col("depth")))).otherwise(none), reads)
    rows = rows.withColumn("_e", F.explode(spread)).drop("_levels").withColumns({"_role": F.col("_e.role"), "_level": F.col("_e.level")}).drop("_e")
    opened = F.last(F.when(F.col("_role") == 0, F.struct("pre", "last", "depth", "tree_id", "node_id", "_i")), ignorenulls=True).over(
        Window.partitionBy("page_id", "_level").orderBy("pre", "_role").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_g", F.when(F.col("_role") == 1, opened)).filter("_role = 2 OR (_role = 1 AND _g.last >= pre)")
    # Copies: number (target, repeat, subtree), keys in the target's gap.
    copy = "((t * {times} + r) * _n + _g._i - 1)".format(times=int(times))
    key = lambda at: f"array(s.at, {side}, r, int(_g._i), {at})"
    top, same = "node_id = _g.node_id", "tree_id = _g.tree_id"
    value = {
        "node_id": f"int(({copy} + 1) * _stride + node_id)",
        "parent_id": f"CASE WHEN {top} THEN s.up ELSE int(({copy} + 1) * _stride + parent_id) END",
        "tree_id": f"CASE WHEN {same} THEN s.tree ELSE int(({copy} + 1) * _stride + tree_id) END",
        "owner_id": f"CASE WHEN {same} THEN s.owner ELSE int(({copy} + 1) * _stride + owner_id) END",
        "in_svg": "in_svg OR s.svg", "preserve_ws": "preserve_ws OR s.ws", "in_body": "in_body OR s.body",
        "raw_text": f"raw_text OR ({top} AND node_type = 'text' AND s.raw)"}
    fields = lambda given, k, c: "named_struct({}, '_k', {}, '_c', {})".format(", ".join(f"'{n}', {given.get(n, n)}" for n in _FIELDS), k, c)
    relative = [f"2 * (pre - _g.pre) - (depth - _g.depth)", "2 * (last - _g.pre) - (depth - _g.depth) + 1"]
    made = f"""CASE WHEN _role = 2 THEN array({fields({}, f"array({OPEN_AT})", f"array({CLOSE_AT})")})
        ELSE flatten(transform(_spots, (s, t) -> transform(sequence(0, {int(times)} - 1), r -> {fields(value, key(relative[0]), key(relative[1]))}))) END"""
    rows = rows.selectExpr("page_id", f"inline({made})")
    return _renumber(rows, "_k", "_c")


def copy_subtree(nodes: DataFrame, source, target, position: str = "beforeend",
                 pages: DataFrame | None = None) -> DataFrame:
    """Deep-copy the ``source`` selection to every target of the same page.

    ``pages(page_id, from_page_id)`` imports from another page instead: the source subtrees travel to the pages that
    ask for them, which costs a join and a second reading of unstored nodes."""
    if pages is None:
        return _graft(nodes, source, target, position)
    frags = subtrees(nodes, source)
    frags = pages.join(frags.withColumnRenamed("page_id", "from_page_id"), "from_page_id").select("page_id", "frags")
    return _insert(_attach(nodes, target, frags), "_hit", F.col("frags"), position)


def instantiate_template(nodes: DataFrame, templates, target, times: int = 1, mode=None) -> DataFrame:
    """Clone the contents of the selected template elements under every target, ``times`` times each.

    Selected nodes that are not templates contribute nothing."""
    if times < 1:
        return _plain(nodes)
    if mode is None:
        return _graft(nodes, templates, target, "beforeend", times, contents=True)
    from .sanitize import sanitize
    is_template = (F.col("tag") == "template") & (F.col("ns") == "html")
    if isinstance(templates, Column):
        templates = templates & is_template
    elif isinstance(templates, DataFrame):
        templates = templates.filter(is_template) if "tag" in templates.columns else templates
    frags = subtrees(sanitize(nodes, mode), templates, contents=True)
    repeated = F.flatten(F.array_repeat(F.col("frags"), times))
    return _insert(_attach(nodes, target, frags.select("page_id", repeated.alias("frags"))), "_hit",
                   F.col("frags"), "beforeend")


def use_template_string(nodes: DataFrame, where, template_html, mode=None) -> DataFrame:
    """Instantiate the templates of a markup string under the selected nodes, other markup ignored."""
    return parse_and_append(nodes, where, template_html, mode=mode, templates_only=True)


def parse_and_append(nodes: DataFrame, where, html, context: str = "body", mode=None,
                     templates_only: bool = False) -> DataFrame:
    """Append parsed markup: contents of its templates first, then the remaining nodes."""
    from .shred import FRAGMENT_CONTEXTS
    if context not in FRAGMENT_CONTEXTS:
        raise ValueError(f"unknown fragment context: {context}")
    marked = _insert_html(nodes, where, html, mode)
    arr = F.col("_frag")
    is_template = lambda r: (r["tag"] == "template") & (r["ns"] == "html")
    roots = F.filter(arr, lambda r: r["depth"] == 0)
    templates = F.filter(roots, lambda r: F.coalesce(is_template(r), F.lit(False)))
    inner = F.flatten(F.transform(templates, lambda t: F.filter(
        F.slice(arr, t["pre"] + 2, t["last"] - t["pre"]), lambda x: x["depth"] == 1)))
    rest = F.filter(roots, lambda r: ~F.coalesce(is_template(r), F.lit(False)))
    blank = F.forall(rest, lambda r: (r["node_type"] == "text") & r["text"].rlike(r"^[ \t\n\r]*\z"))
    rest = F.when(F.lit(templates_only) | (blank & (F.size(templates) > 0)), F.slice(rest, 1, 0)).otherwise(rest)
    return _insert(marked, "_hit", F.concat(_split(arr, inner), _split(arr, rest)), "beforeend")


# -- attributes and classes ---------------------------------------------------------------------------------------

def _update_attrs(nodes: DataFrame, where, change) -> DataFrame:
    marked = mark(nodes, where)
    hit = F.col("_hit") & (F.col("node_type") == "element")
    return _plain(with_derived(marked.withColumn("attrs", F.when(hit, change(F.col("attrs"))).otherwise(F.col("attrs")))))


def _put(attrs: Column, name: str, value) -> Column:
    value = (value if isinstance(value, Column) else F.lit(value)).cast("string")
    pair = F.struct(F.lit(name).alias("name"), value.alias("value"))
    return F.when(
        F.exists(attrs, lambda a: a["name"] == name),
        F.transform(attrs, lambda a: F.when(a["name"] == name, pair).otherwise(a)),
    ).otherwise(F.concat(attrs, F.array(pair)))


def set_attribute(nodes: DataFrame, where, name: str, value) -> DataFrame:
    """Add or overwrite an attribute, keeping attribute order."""
    return _update_attrs(nodes, where, lambda a: _put(a, name.lower(), value))


def set_attributes(nodes: DataFrame, where, attrs: dict) -> DataFrame:
    return _update_attrs(nodes, where, lambda a: reduce(lambda c, kv: _put(c, kv[0].lower(), kv[1]), attrs.items(), a))


def remove_attribute(nodes: DataFrame, where, name: str) -> DataFrame:
    return _update_attrs(nodes, where, lambda a: F.filter(a, lambda x: x["name"] != name.lower()))


def _update_classes(nodes: DataFrame, where, change) -> DataFrame:
    def new_attrs(attrs):
        old = class_list(attrs)
        new = change(old)
        return F.when(new == old, attrs).otherwise(_put(attrs, "class", F.array_join(new, " ")))
    return _update_attrs(nodes, where, new_attrs)


def _is_token(name: str) -> bool:
    return bool(name) and not any(ch.isspace() for ch in name)


def add_class(nodes: DataFrame, where, name: str) -> DataFrame:
    return _update_classes(nodes, where, lambda c: F.array_union(c, F.array(F.lit(name))) if _is_token(name) else c)


def remove_class(nodes: DataFrame, where, name: str) -> DataFrame:
    return _update_classes(nodes, where, lambda c: F.array_remove(c, name))


def toggle_class(nodes: DataFrame, where, name: str) -> DataFrame:
    return _update_classes(nodes, where, lambda c: F.when(
        F.array_contains(c, name), F.array_remove(c, name)).otherwise(
        F.concat(c, F.array(F.lit(name)))) if _is_token(name) else c)


def replace_class(nodes: DataFrame, where, old: str, new: str) -> DataFrame:
    """Rename a class token in place; no change when the old token is absent."""
    return _update_classes(nodes, where, lambda c: F.array_distinct(F.transform(
        c, lambda t: F.when(t == old, F.lit(new)).otherwise(t))) if _is_token(new) else c)


def clear_classes(nodes: DataFrame, where) -> DataFrame:
    return _update_classes(nodes, where, lambda c: F.slice(c, 1, 0))
