"""CSS selection compiled to window expressions over the ``nodes`` table.

Tests on one element are plain predicates.  Relations between elements are windows that all share
the page_id distribution of the table, so a selector of any length is one pass over the nodes with
no self-join and no (node, ancestor) pairs:

* descendant: intervals nest, so an element has a matching ancestor exactly when the largest
  ``last`` of the matches before it in document order reaches its ``pre``;
* child: parent and children meet in one family partition keyed by the parent's id;
* sibling: lag / running maximum within the family.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.node import class_tokens

# --- fixed values: pseudo-classes accepted but never matching -------------------------------------
NEVER = frozenset(
    "current default focus-visible focus-within fullscreen future in-range indeterminate invalid "
    "local-link out-of-range past scope target target-within user-invalid valid visited warning "
    "dir lang nth-col nth-last-col after backdrop before first-letter first-line grammar-error "
    "inactive-selection marker placeholder selection spelling-error target-text".split())
# ---------------------------------------------------------------------------------------------------

_IDENT = r"(?:\\.|[\w-]|[^\x00-\x7f])+"
_PART = re.compile(rf"""
    (?P<type>\*|{_IDENT}) | \#(?P<id>{_IDENT}) | \.(?P<cls>{_IDENT})
  | \[\s*(?P<attr>{_IDENT})\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<raw>[^\s\]]+))
      \s*(?P<mod>[iIsS])?)?\s*\]
  | ::?(?P<pseudo>[\w-]+)(?P<open>\()?
""", re.X)
_COMBINATOR = re.compile(r"\s*([>+~])\s*|(\s+)(?=[^\s,)])")


def _fail(text, at):
    raise ValueError(f"cannot read selector {text!r} at position {at}")


def _unescape(s): return re.sub(r"\\(.)", r"\1", s)


def _read_list(text, at=0, nested=False, relative=False):
    """Selector list as [[(combinator, compound), ...], ...] with compounds as lists of tests."""
    out = []
    while True:
        at = re.compile(r"\s*").match(text, at).end()
        chain, comb = [], None
        if relative and (m := re.compile(r"([>+~])\s*").match(text, at)):
            comb, at = m.group(1), m.end()
        while True:
            compound, at = _read_compound(text, at)
            chain.append((comb or (" " if chain or relative else None), compound))
            m = _COMBINATOR.match(text, at)
            if not m:
                break
            comb, at = m.group(1) or " ", m.end()
        out.append(chain)
        at = re.compile(r"\s*").match(text, at).end()
        if at < len(text) and text[at] == ",":
            at += 1
        elif nested and at < len(text) and text[at] == ")":
            return out, at + 1
        elif not nested and at == len(text):
            return out, at
        else:
            _fail(text, at)


def _read_compound(text, at):
    tests, begin = [], at
    while m := _PART.match(text, at):
        if m.group("type") and at != begin:
            break
        at = m.end()
        if m.group("pseudo"):
            name = m.group("pseudo").lower()
            arg = None
            if m.group("open"):
                if name in ("is", "where", "not", "has", "current"):
                    arg, at = _read_list(text, at, nested=True, relative=name == "has")
                else:
                    arg, at = _read_argument(text, at)
            tests.append(("pseudo", name, arg))
        elif m.group("attr"):
            value = next((m.group(g) for g in ("dq", "sq", "raw") if m.group(g) is not None), None)
            tests.append(("attr", _unescape(m.group("attr")).lower(), m.group("op"), value,
                          (m.group("mod") or "").lower() == "i"))
        else:
            kind = m.lastgroup
            tests.append((kind, _unescape(m.group(kind))))
    if not tests:
        _fail(text, at)
    return tests, at


def _read_argument(text, at):
    """Raw argument up to the closing parenthesis; ``an+b of S`` keeps S as a selector list."""
    m = re.compile(r"""\s*((?:"[^"]*"|'[^']*'|[^()"'])*?)\s*(?:(?<=\s)of\s+|\))""").match(text, at)
    if not m:
        _fail(text, at)
    if m.group().endswith(")"):
        return (m.group(1), None), m.end()
    inner, end = _read_list(text, m.end(), nested=True)
    return (m.group(1), inner), end


def _an_plus_b(text):
    s = re.sub(r"\s+", "", text.lower())
    s = {"odd": "2n+1", "even": "2n"}.get(s, s)
    m = re.fullmatch(r"(?:([+-]?\d*)n)?([+-]?\d+)?", s)
    if not m or not s:
        raise ValueError(f"cannot read position {text!r}")
    step = m.group(1)
    a = 0 if step is None else int(step + "1" if step in ("", "+", "-") else step)
    return a, int(m.group(2) or 0)


def _at_position(index: Column, a: int, b: int) -> Column:
    if a == 0:
        return index == b
    return ((index - b) % a == 0) & ((index - b) / a >= 0)


# -- element-local tests ---------------------------------------------------------------------------------

def has_attr(*names) -> Column:
    return F.exists("attrs", lambda a: a["name"].isin(*names))


def attr_test(name: str, op: str | None = None, value: str | None = None, insensitive: bool = False) -> Column:
    """Attribute selector; an empty operand never matches for ``^= $= *=``."""
    def test(a):
        hit = F.lower(a["name"]) == name
        if op is None:
            return hit
        have = F.coalesce(a["value"], F.lit(""))
        want = value
        if insensitive:
            have, want = F.lower(have), value.lower()
        ops = {
            "=": lambda: have == want,
            "~=": lambda: F.array_contains(F.split(have, r"[ \t\n\r\f]+"), want) if want and not re.search(r"\s", want) else F.lit(False),
            "|=": lambda: (have == want) | have.startswith(want + "-"),
            "^=": lambda: have.startswith(want) if want else F.lit(False),
            "$=": lambda: have.endswith(want) if want else F.lit(False),
            "*=": lambda: have.contains(want) if want else F.lit(False),
        }
        return hit & ops[op]()
    return F.exists("attrs", test)


def _tag_in(*tags): return F.col("tag").isin(*tags)
def _custom(): return F.contains("tag", F.lit("-"))


def _state(name: str):
    """Positional and attribute-based state tests on a single element."""
    elem, cnt, typ, tcnt = (F.col(c) for c in ("elem_idx", "elem_cnt", "type_idx", "type_cnt"))
    form = _tag_in("input", "select", "textarea")
    writable = _tag_in("input", "textarea") & ~has_attr("readonly", "disabled")
    check_type = attr_test("type", "=", "checkbox", True) | attr_test("type", "=", "radio", True)
    table = {
        "root": lambda: (F.col("depth") == 0) & (F.col("tag") == "html"),
        "first-child": lambda: elem == 1,
        "last-child": lambda: elem == cnt,
        "only-child": lambda: cnt == 1,
        "first-of-type": lambda: typ == 1,
        "last-of-type": lambda: typ == tcnt,
        "only-of-type": lambda: tcnt == 1,
        "any-link": lambda: _tag_in("a", "area", "map") & has_attr("href"),
        "link": lambda: _tag_in("a", "area", "link") & has_attr("href"),
        "checked": lambda: (F.col("tag") == "option") & has_attr("selected")
        | (((F.col("tag") == "input") & check_type) | _custom()) & has_attr("checked"),
        "required": lambda: form & has_attr("required"),
        "optional": lambda: form & ~has_attr("required"),
        "placeholder-shown": lambda: _tag_in("input", "textarea") & has_attr("placeholder"),
        "read-write": lambda: writable,
        "read-only": lambda: ~writable,
        "active": lambda: has_attr("active"),
        "focus": lambda: has_attr("focus"),
        "hover": lambda: has_attr("hover"),
    }
    return table[name]() if name in table else None


def _local(test) -> Column | None:
    """The test as a predicate on the element alone, None when it needs other nodes."""
    kind = test[0]
    if kind == "type":
        return F.lit(True) if test[1] == "*" else F.lower("tag") == test[1].lower()
    if kind == "id":
        return F.coalesce(F.lower("id") == test[1].lower(), F.lit(False))
    if kind == "cls":
        return F.exists("classes", lambda c: F.lower(c) == test[1].lower())
    if kind == "attr":
        return attr_test(*test[1:])
    _, name, arg = test
    if name in NEVER and not (name == "current" and isinstance(arg, list)):
        return F.lit(False)
    if name.startswith("nth-") and arg and arg[1] is None:
        a, b = _an_plus_b(arg[0])
        index = {
            "nth-child": F.col("elem_idx"), "nth-last-child": F.col("elem_cnt") - F.col("elem_idx") + 1,
            "nth-of-type": F.col("type_idx"), "nth-last-of-type": F.col("type_cnt") - F.col("type_idx") + 1}
        if name in index:
            return _at_position(index[name], a, b)
    return _state(name) if arg is None else None


def _walk(selectors):
    """All compounds of a selector list, nested ones included."""
    for chain in selectors:
        for _, compound in chain:
            yield compound
            for t in compound:
                if t[0] == "pseudo":
                    inner = t[2] if isinstance(t[2], list) else t[2][1] if isinstance(t[2], tuple) else None
                    yield from _walk(inner or [])


def _needs_all(selectors) -> bool:
    names = [t[1] for c in _walk(selectors) for t in c if t[0] == "pseudo"]
    return any(n in ("empty", "blank", "disabled", "enabled") or n.endswith("contains") for n in names)


def _candidate(selectors) -> Column:
    """Rows that can play any part in the selector: everything else is filtered before the shuffle."""
    parts = []
    for compound in _walk(selectors):
        local = [c for c in map(_local, compound) if c is not None]
        parts.append(reduce(and_, local, F.lit(True)))
    return reduce(or_, parts)


class _Pass:
    """Adds one match column per compound step to a node DataFrame."""

    def __init__(self, nodes: DataFrame):
        self.df, self.n, self.base = nodes, 0, nodes.columns
        tree = Window.partitionBy("page_id", "tree_id")
        self.before = tree.orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
        self.after = tree.orderBy(F.col("pre").desc()).rowsBetween(Window.unboundedPreceding, -1)
        family = Window.partitionBy("page_id", "tree_id", "parent_id")
        self.prev = family.orderBy("elem_idx")
        self.prevs = self.prev.rowsBetween(Window.unboundedPreceding, -1)
        self.next = family.orderBy(F.col("elem_idx").desc())
        self.nexts = self.next.rowsBetween(Window.unboundedPreceding, -1)

    def keep(self, value: Column) -> Column:
        self.n += 1
        name = f"_m{self.n}"
        self.df = self.df.withColumn(name, F.coalesce(value, F.lit(False)))
        return F.col(name)

    def meet(self, gives: Column, give_key: str, take_key: str) -> Column:
        """True on rows whose ``take_key`` equals the ``give_key`` of a giving row."""
        self.n += 1
        name = f"_m{self.n}"
        role = F.explode(F.when(gives, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))))
        df = self.df.withColumn("_role", role)
        df = df.withColumn("_fam", F.when(F.col("_role") == 0, F.col(give_key)).otherwise(F.col(take_key)))
        family = Window.partitionBy("page_id", "tree_id", "_fam")
        df = df.withColumn(name, F.col("_fam").isNotNull() & (F.min("_role").over(family) == 0))
        self.df = df.filter("_role = 1").drop("_role", "_fam")
        return F.col(name)

    def _sibling(self, window, frame, gives, gap):
        """Matching adjacent (``gap`` = +-1) or any earlier / later element sibling."""
        if gap:
            return F.lag(gives).over(window) & (F.col("elem_idx") - F.lag("elem_idx").over(window) == gap)
        return F.coalesce(F.max(gives).over(frame), F.lit(False))

    def related(self, comb: str, gives: Column) -> Column:
        """Rows standing in the combinator's relation to a match on the left side."""
        if comb == ">":
            return self.meet(gives, "node_id", "parent_id")
        if comb == "+":
            return self.keep(self._sibling(self.prev, None, gives, 1))
        if comb == "~":
            return self.keep(self._sibling(None, self.prevs, gives, 0))
        return self.keep(F.max(F.when(gives, F.col("last"))).over(self.before) >= F.col("pre"))

    def holding(self, comb: str, gives: Column) -> Column:
        """Rows for which a match on the right side stands in the relation (``:has``)."""
        if comb == ">":
            return self.meet(gives, "parent_id", "node_id")
        if comb == "+":
            return self.keep(self._sibling(self.next, None, gives, -1))
        if comb == "~":
            return self.keep(self._sibling(None, self.nexts, gives, 0))
        return self.keep(F.min(F.when(gives, F.col("pre"))).over(self.after) <= F.col("last"))

    def compound(self, tests) -> Column:
        hits = [F.col("node_type") == "element"]
        for t in tests:
            local = _local(t)
            hits.append(local if local is not None else self.nonlocal_test(*t[1:]))
        return self.keep(reduce(and_, hits))

    def nonlocal_test(self, name, arg) -> Column:
        text = F.col("node_type") == "text"
        if name in ("is", "where", "current"):
            return self.any_of(arg)
        if name == "not":
            return ~self.any_of(arg)
        if name == "has":
            return reduce(or_, [self.has_chain(chain) for chain in arg])
        if name in ("nth-child", "nth-last-child") and arg:
            hit = self.any_of(arg[1])
            frame = (self.prev if name == "nth-child" else self.next).rowsBetween(Window.unboundedPreceding, 0)
            index = F.sum(hit.cast("int")).over(frame)
            return self.keep(hit & _at_position(index, *_an_plus_b(arg[0])))
        if name == "empty":
            return ~self.holding(" ", text | (F.col("node_type") == "element"))
        if name == "blank":
            solid = (F.col("node_type") == "element") | (text & ~F.col("text").rlike(r"^[ \t\n\r\f]*\z"))
            return ~self.holding(" ", solid)
        if (name == "contains" or name.endswith("-contains")) and arg:   # plain or vendor-prefixed
            m = re.fullmatch(r"""("[^"]*"|'[^']*'|.*?)(?:\s+(i))?""", arg[0], re.S | re.I)
            want = m.group(1).strip("\"'")
            have = F.lower("text") if m.group(2) else F.col("text")
            return self.meet(text & have.contains(want.lower() if m.group(2) else want), "parent_id", "node_id")
        if name in ("disabled", "enabled"):
            first = self.meet((F.col("sib_idx") == 1) & (F.col("tag") == "legend"), "parent_id", "node_id")
            fieldset = self.related(" ", (F.col("tag") == "fieldset") & ~first)
            off = has_attr("disabled") & (_tag_in("button", "input", "select", "textarea") | _custom() | fieldset)
            return off if name == "disabled" else ~off
        raise ValueError(f"unknown pseudo-class :{name}")

    def has_chain(self, chain) -> Column:
        """``:has(A > B)`` is ``:has(A:has(> B))``: fold from the right."""
        comb, tests = chain[0]
        hit = self.compound(tests)
        if len(chain) > 1:
            hit = hit & self.has_chain(chain[1:])
        return self.holding(comb, hit)

    def any_of(self, selectors) -> Column:
        hits = []
        for chain in selectors:
            hit = self.compound(chain[0][1])
            for comb, tests in chain[1:]:
                left = self.related(comb, hit)
                hit = self.keep(left & self.compound(tests))
            hits.append(hit)
        return reduce(or_, hits)


def _flag(nodes: DataFrame, selector: str, name: str, prune: bool, also: Column | None = None) -> DataFrame:
    """``prune`` keeps only rows that can play a part in the selector, and those that ``also`` names."""
    selectors, _ = _read_list(selector.strip())
    columns = [c for c in nodes.columns if c != name]
    if prune:
        nodes = nodes.filter(_keep_rows(selectors) if also is None else _keep_rows(selectors) | also)
    run = _Pass(nodes)
    hit = run.any_of(selectors)
    return run.df.select(*columns, hit.alias(name))


def _keep_rows(selectors) -> Column:
    if _needs_all(selectors):
        return F.col("node_type").isin("element", "text")
    return (F.col("node_type") == "element") & _candidate(selectors)


def in_scope(scope: str) -> Column:
    if scope not in ("body", "document"):
        raise ValueError(f"unknown scope: {scope}")
    page = F.col("tree_id") == 0
    return page & F.col("in_body") if scope == "body" else page


# -- operators ------------------------------------------------------------------------------------------------

def flag_nodes(nodes: DataFrame, selector: str, name: str = "matches") -> DataFrame:
    """Every node row plus a flag; non-elements and template contents are never matched."""
    return _flag(nodes, selector, name, prune=False).withColumn(name, F.col(name) & (F.col("tree_id") == 0))


def select_all(nodes: DataFrame, selector: str, scope: str = "body") -> DataFrame:
    """All elements matching a selector list, each once."""
    hits = _flag(nodes.filter("tree_id = 0"), selector, "_match", prune=True)
    return hits.filter(F.col("_match") & in_scope(scope)).drop("_match")


def select_first(nodes: DataFrame, selector: str, scope: str = "body") -> DataFrame:
    return first_per_page(select_all(nodes, selector, scope))


def first_per_page(sel: DataFrame) -> DataFrame:
    """The first selected row of each page in document order."""
    best = sel.groupBy("page_id").agg(F.min_by(F.struct(*[c for c in sel.columns if c != "page_id"]), "pre").alias("_n"))
    return best.select("page_id", "_n.*").select(*sel.columns)


def page_matches(nodes: DataFrame, selector: str, pages: DataFrame | None = None, scope: str = "body") -> DataFrame:
    """(page_id, matches): does any element of the page match."""
    hits = _flag(nodes.filter("tree_id = 0"), selector, "_match", prune=False)
    flags = hits.groupBy("page_id").agg(F.coalesce(F.max(F.col("_match") & in_scope(scope)), F.lit(False)).alias("matches"))
    if pages is None:
        return flags
    return pages.select("page_id").join(flags, "page_id", "left").withColumn("matches", F.coalesce("matches", F.lit(False)))


def node_matches(nodes: DataFrame, sel, selector: str) -> DataFrame:
    """The selected rows plus ``matches``.

    A selection (here and below) is a Column, a selector or a DataFrame of node keys; the first two are marked in the
    same pass as the matches, a DataFrame costs a join."""
    from .rewrite import mark
    hits = _flag(mark(nodes, sel, "_chosen"), selector, "matches", prune=True, also=F.col("_chosen")).filter("_chosen")
    return hits.select(*nodes.columns, *[c for c in hits.columns if c not in (*nodes.columns, "_chosen", "matches")],
                       (F.col("matches") & (F.col("tree_id") == 0)).alias("matches"))


def filter_nodes(nodes: DataFrame, sel, selector: str) -> DataFrame:
    """The selected rows that match themselves."""
    return node_matches(nodes, sel, selector).filter("matches").drop("matches")


def enclosing(nodes: DataFrame, giver: Column, taker: Column, payload: Column, inside: bool) -> DataFrame:
    """Every taker once per giver whose subtree holds it, with the giver's payload in ``_g``; ``inside``: not itself.

    A stack of open givers carried along document order, one entry a depth: the giver opened last at a depth is
    the only one there whose interval can still hold the row, so takers read one entry for each depth at which the
    page has givers.  One window over (page, depth), no interval join; output and memory follow the pairs there are."""
    page = Window.partitionBy("page_id")
    rows = nodes.withColumns({"_give": F.coalesce(giver, F.lit(False)), "_take": F.coalesce(taker, F.lit(False))})
    rows = rows.filter("_give OR _take").withColumn("_levels", F.collect_set(F.when(F.col("_give"), F.col("depth"))).over(page))
    above = F.filter("_levels", lambda level: level < F.col("depth") if inside else level <= F.col("depth"))
    entry = lambda role, level: F.struct(F.lit(role).alias("role"), level.alias("level"))
    none = F.array().cast("array<struct<role:int,level:int>>")
    spread = F.concat(F.when(F.col("_give"), F.array(entry(0, F.col("depth")))).otherwise(none),
                      F.when(F.col("_take"), F.transform(above, lambda level: entry(1, level))).otherwise(none))
    carried = F.struct(F.col("last").alias("_last"), F.col("tree_id").alias("_tree"), payload.alias("_own"))
    rows = rows.withColumn("_e", F.explode(spread)).drop("_levels").withColumns({"_role": F.col("_e.role"), "_level": F.col("_e.level")})
    stack = Window.partitionBy("page_id", "_level").orderBy("pre", "_role").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_open", F.last(F.when(F.col("_role") == 0, carried), ignorenulls=True).over(stack))
    held = (F.col("_role") == 1) & (F.col("_open._last") >= F.col("pre")) & (F.col("_open._tree") == F.col("tree_id"))
    return rows.filter(held).withColumn("_g", F.col("_open._own")).drop("_give", "_take", "_e", "_role", "_level", "_open")


def select_within(nodes: DataFrame, sel, selector: str, **carry: Column) -> DataFrame:
    """Matches among each selected node and its descendants, once per (root_node_id, node).

    ``carry`` names expressions over the root's row that come along with its matches."""
    from .rewrite import mark
    flagged = _flag(mark(nodes, sel, "_root"), selector, "_match", prune=True, also=F.col("_root"))
    flagged = flagged.withColumn("_match", F.col("_match") & (F.col("tree_id") == 0))
    root = F.struct(F.col("node_id").alias("root_node_id"), *[c.alias(n) for n, c in carry.items()])
    out = enclosing(flagged, F.col("_root"), F.col("_match"), root, inside=False)
    return out.select(*nodes.columns, "_g.*")


def match_counts(nodes: DataFrame, selectors: dict[str, str], scope: str = "body") -> DataFrame:
    """Per-page match counts of several named selectors in one pass."""
    run = _Pass(nodes.filter("tree_id = 0"))
    flags = {name: run.keep(run.any_of(_read_list(s.strip())[0]) & in_scope(scope)) for name, s in selectors.items()}
    return run.df.groupBy("page_id").agg(*[F.count_if(c).alias(n) for n, c in flags.items()])
