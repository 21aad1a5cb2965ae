"""Whitelist sanitiser: node verdicts and attribute filters as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spec
from .rewrite import drop_subtrees, renumber_kept
from .shred import with_derived
from ..schema import KERNEL_NODE, NODE_COLUMNS


@dataclass(frozen=True)
class SanitizerOptions:
    skip_comments: bool = True
    remove_scripts: bool = True
    remove_styles: bool = True
    strict_uri_validation: bool = True
    allow_custom_elements: bool = False
    compat: bool = False     # unlisted script / style are removed even when their flag allows them


MODES = {
    "none": None,
    "minimum": SanitizerOptions(False, False, False, False, True),
    "strict": SanitizerOptions(),
    "permissive": SanitizerOptions(allow_custom_elements=True),
}

# --- fixed values ---------------------------------------------------------------------------------
BLOCKED_TAGS = ["object", "embed"]
SVG_BLOCKED = ["script", "foreignObject", "animate", "animateTransform", "set"]
# ---------------------------------------------------------------------------------------------------


def options(mode) -> SanitizerOptions | None:
    if isinstance(mode, SanitizerOptions):
        return mode
    if mode not in MODES:
        raise ValueError(f"unknown sanitizer mode: {mode}")
    return MODES[mode]


def _clean(value: str) -> str:
    """Value as a URL parser sees it: control characters and leading blanks ignored, lower case."""
    return f"lower(ltrim(regexp_replace({value}, '[\\\\x00-\\\\x1F\\\\x7F]', '')))"


def _dangerous_scheme(value: str) -> str:
    v = _clean(value)
    return (f"({spec.starts(v, ['javascript:', 'vbscript:', 'data:text/html', 'data:text/javascript'])} "
            f"OR (startswith({v}, 'data:') AND contains({v}, 'base64')))")


class Rules:
    """Sanitiser conditions over one node as SQL text; ``at`` prefixes its column names."""

    def __init__(self, opts: SanitizerOptions, at: str = ""):
        self.o, self.at = opts, at
        self.tag, self.kind, self.svg, self.attrs = (at + c for c in ("tag", "node_type", "in_svg", "attrs"))

    def reason(self) -> str:
        """Why the node is removed with its subtree, null to keep it."""
        o, tag, svg = self.o, self.tag, self.svg
        listed = spec.spec_element_sql(tag)
        kept = ["" if o.compat or gone else t for t, gone in (("script", o.remove_scripts), ("style", o.remove_styles))]
        src = f"try_element_at(filter({self.attrs}, a -> a.name = 'src'), 1).value"
        unsafe = (f"NOT exists({self.attrs}, a -> a.name = 'sandbox') "
                  f"OR coalesce({spec.starts(_clean(src), ['javascript:', 'data:'])}, false)")
        custom = "NULL" if o.allow_custom_elements else "'custom element'"
        return f"""CASE WHEN {self.kind} = 'comment' AND {o.skip_comments} THEN 'comment'
            WHEN {self.kind} <> 'element' OR ({tag} = 'template' AND NOT {svg}) THEN NULL
            WHEN {spec.in_list(tag, BLOCKED_TAGS)} THEN 'blocked element'
            WHEN {tag} = 'script' AND {o.remove_scripts} THEN 'script'
            WHEN {tag} = 'style' AND {o.remove_styles} THEN 'style'
            WHEN {svg} AND {spec.in_list(tag, SVG_BLOCKED)} THEN 'dangerous svg element'
            WHEN {svg} AND NOT {listed} THEN 'svg element not listed'
            WHEN {svg} THEN NULL
            WHEN {tag} = 'iframe' AND ({unsafe}) THEN 'unsafe iframe'
            WHEN contains({tag}, '-') THEN {custom}
            WHEN NOT {listed} AND NOT {spec.in_list(tag, kept)} THEN 'element not listed' END"""

    def kept_attrs(self) -> str:
        """Attributes left on the node; framework names pass, others by kind of element."""
        o, tag, name, value = self.o, self.tag, "a.name", "coalesce(a.value, '')"
        event = f"startswith({name}, 'on')"
        uri = f"({name} IN ('href', 'src') AND {o.strict_uri_validation} AND NOT {spec.safe_uri_sql(value)})"
        free = f"({spec.framework_sql(name)} OR startswith({name}, 'slot') OR {name} IN ('for', 'if', 'let'))"
        bad = f"({_dangerous_scheme(value)} OR {event} OR {uri})"
        standard = (f"{bad} OR NOT {spec.allowed_sql(tag, name)} OR {name} = 'style' "
                    f"OR ({name} = 'target' AND NOT {spec.target_sql(value)})")
        loose = f"{bad} OR ({name} = 'style' AND {o.remove_styles})"
        in_svg = f"{event} OR ({name} IN ('href', 'xlink:href') AND startswith({_clean(value)}, 'javascript:'))"
        drop = (f"CASE WHEN {self.svg} THEN {in_svg} WHEN {free} THEN false "
                f"WHEN {spec.spec_element_sql(tag)} THEN {standard} ELSE {loose} END")
        return (f"CASE WHEN size({self.attrs}) = 0 OR coalesce({tag} = 'template' AND NOT {self.svg}, false) THEN {self.attrs} "
                f"ELSE filter({self.attrs}, a -> NOT coalesce({drop}, false)) END")


def node_reason(opts: SanitizerOptions | None) -> Column:
    return F.lit(None).cast("string") if opts is None else F.expr(Rules(opts).reason())


def sanitize(nodes: DataFrame, mode="strict", reindex: bool = True) -> DataFrame:
    """Remove disallowed nodes with their subtrees and disallowed attributes, templates included.

    ``reindex=False`` skips closing the numbering gaps, enough when ``to_html`` follows."""
    opts = options(mode)
    if opts is None:
        return nodes
    rules = Rules(opts)
    gone = f"({rules.reason()}) IS NOT NULL AND NOT coalesce(tag IN ('html', 'head', 'body') AND depth <= 1, false)"
    marked = nodes.withColumn("_gone", F.expr(gone))
    kept = drop_subtrees(marked, "_gone").drop("_gone").withColumn("attrs", F.expr(rules.kept_attrs()))
    kept = with_derived(kept).select(*nodes.columns)
    return renumber_kept(kept) if reindex else kept


def sanitize_strict(nodes): return sanitize(nodes, "strict")
def sanitize_permissive(nodes): return sanitize(nodes, "permissive")


def sanitize_fragment(df: DataFrame, column: str, mode) -> DataFrame:
    """The same rules on a fragment column (array of node structs), row by row."""
    opts = options(mode)
    if opts is None:
        return df
    rules = Rules(opts, "f.")
    gone = f"transform(filter({column}, f -> ({rules.reason()}) IS NOT NULL), f -> struct(f.pre AS pre, f.last AS last))"
    fields = ", ".join(f"{rules.kept_attrs() if c == 'attrs' else 'f.' + c} AS {c}" for c in KERNEL_NODE.fieldNames())
    # Numbers run without gaps through a fresh fragment, so what stays is a difference of number lists.
    removed = "flatten(transform(_gone, g -> sequence(g.pre, g.last)))"
    kept = (f"transform(array_except(transform({column}, f -> f.pre), {removed}), "
            f"p -> element_at({column}, p - {column}[0].pre + 1))")
    return (df.withColumn("_gone", F.expr(gone)).withColumn(column, F.expr(kept)).drop("_gone")
            .withColumn(column, F.expr(f"transform({column}, f -> struct({fields}))")))
