"""The HTML element and attribute whitelist as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .node import VOID_TAGS

# --- fixed values: whitelisted attributes, with their allowed values where restricted ------------
BOOL = [""]
COMMON = {
    "id": None, "class": None, "style": None, "title": None, "lang": None, "width": None, "height": None,
    "dir": ["ltr", "rtl", "auto"], "aria": None, "data": None, "hidden": BOOL, "role": None,
    "tabindex": None, "contenteditable": ["true", "false", ""], "draggable": ["true", "false", "auto"],
    "spellcheck": ["true", "false"],
}
TABLE = {"scope": ["col", "row", "colgroup", "rowgroup"], "colspan": None, "rowspan": None}
FORM = {"action": None, "method": ["get", "post"], "enctype": None, "target": None}
INPUT = {
    "type": ["text", "email", "password", "number", "tel", "url", "search", "submit", "reset", "button", "hidden"],
    "name": None, "value": None, "placeholder": None, "required": BOOL, "minlength": None,
    "maxlength": None, "readonly": BOOL,
}
SVG = dict.fromkeys("viewBox width height x y cx cy r rx ry d fill stroke stroke-width".split())
IMG = {
    "src": None, "alt": None, "width": None, "height": None, "loading": ["lazy", "eager", "auto"],
    "decoding": ["sync", "async", "auto"], "srcset": None, "sizes": None,
    "crossorigin": ["anonymous", "use-credentials"], "referrerpolicy": None, "usemap": None, "ismap": BOOL,
}
TARGETS = ["_blank", "_self", "_parent", "_top"]
ANCHOR = {"href": None, "target": TARGETS, "rel": None, "type": None, "download": None,
          "hreflang": None, "ping": None, "referrerpolicy": None}
FRAMEWORK_ATTRS = dict.fromkeys(
    "x-data x-show x-model x-on x-bind x-if x-for x-text x-html x-ref x-cloak x-ignore x-init x-transition "
    "phx-click phx-submit phx-change phx-focus phx-blur phx-window-focus phx-window-blur phx-window-keydown "
    "phx-window-keyup phx-key phx-value phx-disable-with phx-loading phx-update phx-hook phx-debounce "
    "phx-throttle phx-target v-model v-if v-for v-show v-on v-bind v-slot ng-model ng-if ng-for ng-click "
    "ng-submit ng-change".split())
PRELOAD = ["none", "metadata", "auto"]
MEDIA = {"src": None, "controls": BOOL, "autoplay": BOOL, "loop": BOOL, "muted": BOOL, "preload": PRELOAD}
OWN = {
    "body": {}, **dict.fromkeys("p span div".split(), FRAMEWORK_ATTRS),
    **dict.fromkeys("h1 h2 h3 h4 h5 h6 strong em i b code pre blockquote".split(), {}),
    "a": ANCHOR, "img": IMG, "iframe": dict.fromkeys("src sandbox srcdoc name loading".split()),
    **dict.fromkeys("table thead tbody tfoot tr th td caption".split(), TABLE),
    "form": FORM, "input": INPUT,
    "button": {"type": ["button", "submit", "reset"], "disabled": BOOL},
    "textarea": {"name": None, "rows": None, "cols": None, "placeholder": None, "disabled": BOOL, "required": BOOL},
    "select": {"name": None, "multiple": BOOL, "size": None, "disabled": BOOL, "required": BOOL},
    "option": {"value": None, "selected": BOOL, "disabled": BOOL},
    "optgroup": {"label": None, "disabled": BOOL},
    "fieldset": {"disabled": BOOL, "form": None, "name": None},
    **dict.fromkeys("legend ul ol li dl dt dd".split(), {}),
    "video": {**MEDIA, "poster": None, "width": None, "height": None}, "audio": MEDIA,
    "source": dict.fromkeys("src type media sizes srcset".split()),
    "track": {"src": None, "kind": ["subtitles", "captions", "descriptions", "chapters", "metadata"],
              "srclang": None, "label": None, "default": BOOL},
    **dict.fromkeys("nav header footer main section article aside".split(), {}),
    "details": {"open": BOOL}, "summary": {}, **dict.fromkeys("figure figcaption picture".split(), {}),
    "map": {"name": None},
    "area": {"alt": None, "coords": None, "shape": ["default", "rect", "circle", "poly"], "href": None, "target": TARGETS},
    **dict.fromkeys("html head title".split(), {}),
    "meta": dict.fromkeys("charset name content http-equiv viewport".split()),
    "link": dict.fromkeys("rel href type media sizes".split()),
    **dict.fromkeys("br hr template".split(), {}),
    **dict.fromkeys("svg circle rect path line text".split(), SVG),
}
FRAMEWORKS = {
    "hx-": "HTMX", "phx-": "Phoenix LiveView", "x-": "Alpine.js", "v-": "Vue.js", "@": "Vue.js Events",
    ":": "Vue.js/Phoenix Directives", "data-": "HTML Data", "aria-": "ARIA", "*ng": "Angular",
    "[": "Angular Property", "(": "Angular Event", "bind:": "Svelte Bind", "on:": "Svelte Event",
    "use:": "Svelte Action",
}
DYNAMIC_PREFIXES = ["aria-", "data-", "x-on:", "x-bind:", "phx-value-", "v-on:", "v-bind:"]
SAFE_URI_PREFIXES = ["http://", "https://", "mailto:", "/", "#"]
# ---------------------------------------------------------------------------------------------------

ELEMENTS = list(OWN)


def allowed(tag: str) -> dict[str, list[str] | None]:
    """Whitelisted attributes of a tag with their value lists; the first entry of a name wins."""
    return {**COMMON, **OWN[tag]} if tag in OWN else {}


ALL_ATTRS = sorted({a for t in ELEMENTS for a in allowed(t)})


def spec_elements(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(t, t in VOID_TAGS or t == "iframe") for t in ELEMENTS], "tag string, void_element boolean")


def spec_attrs(spark: SparkSession) -> DataFrame:
    """(tag, attr, valid_values) rows; null values mean any value is allowed.

    The size is fixed by the specification, so joins may broadcast it."""
    rows = [(t, a, v) for t in ELEMENTS for a, v in allowed(t).items()]
    return spark.createDataFrame(rows, "tag string, attr string, valid_values array<string>")


def allowed_attributes(spark: SparkSession, tag: str) -> DataFrame:
    return spec_attrs(spark).filter(F.col("tag") == tag)


# The rules below are SQL text over SQL operands, so the same rule serves columns (``tag``), exploded
# rows (``name``) and lambda variables (``a.name``); the Column functions wrap them with F.expr.

def quote(text: str) -> str: return "'" + text.replace("'", "\\'") + "'"
def in_list(x: str, values) -> str: return f"{x} IN ({', '.join(map(quote, values))})"
def starts(x: str, prefixes) -> str: return "(" + " OR ".join(f"startswith({x}, {quote(p)})" for p in prefixes) + ")"


def spec_element_sql(tag: str) -> str: return f"coalesce({in_list(tag, ELEMENTS)}, false)"
def framework_sql(name: str) -> str: return starts(name, FRAMEWORKS)


def whitelist_sql(tag: str, name: str) -> str:
    """Exact (tag, attribute) membership: hash-set lookups on literals."""
    own = [f"{t} {a}" for t in ELEMENTS for a in OWN[t]]
    return (f"coalesce(({spec_element_sql(tag)} AND {in_list(name, COMMON)}) "
            f"OR {in_list(f'concat({tag}, {quote(chr(32))}, {name})', own)}, false)")


def allowed_sql(tag: str, name: str) -> str:
    return (f"({framework_sql(name)} OR ({spec_element_sql(tag)} AND {starts(name, DYNAMIC_PREFIXES)}) "
            f"OR {whitelist_sql(tag, name)})")


def value_valid_sql(tag: str, name: str, value: str) -> str:
    limits = {(t, a): v for t in ELEMENTS for a, v in allowed(t).items() if v}
    limited = in_list(f"concat({tag}, ' ', {name})", [f"{t} {a}" for t, a in limits])
    listed = in_list(f"concat({tag}, ' ', {name}, '=', coalesce({value}, ''))",
                     [f"{t} {a}={v}" for (t, a), values in limits.items() for v in values])
    return f"({framework_sql(name)} OR ({whitelist_sql(tag, name)} AND (NOT {limited} OR {listed})))"


def known_sql(name: str) -> str:
    return (f"({in_list(name, ALL_ATTRS)} OR startswith({name}, 'aria-') OR {name} RLIKE '^(data|hx)-.' "
            f"OR {starts(name, ['x-on:', 'x-bind:', 'v-on:', 'v-bind:', 'phx-value-'])})")


def dangerous_sql(value: str) -> str:
    v = f"lower(regexp_replace({value}, '(?s)^\"(.+)\"$', '$1'))"
    parts = [f"contains({v}, {quote(x)})" for x in ("<script", "</script", "javascript:", "vbscript:")]
    return ("(" + " OR ".join(parts) + f" OR (startswith({v}, 'data:') AND contains({v}, 'base64')) OR "
            + starts(v, ["file:", "ftp:", "//"]) + ")")


def safe_uri_sql(value: str) -> str: return starts(value, SAFE_URI_PREFIXES)
def target_sql(value: str) -> str: return in_list(value, TARGETS)


def is_spec_element(tag: str = "tag") -> Column: return F.expr(spec_element_sql(tag))
def is_framework_attribute(name: str) -> Column: return F.expr(framework_sql(name))


def framework_of(name: str) -> Column:
    """Framework owning an attribute name, first matching prefix wins, null for none."""
    cases = " ".join(f"WHEN startswith({name}, {quote(p)}) THEN {quote(label)}" for p, label in FRAMEWORKS.items())
    return F.expr(f"CASE {cases} END")


def is_framework_attribute_safe(name: str) -> Column:
    """Every listed framework is marked safe; unlisted names are not."""
    return is_framework_attribute(name)


def attribute_allowed(tag: str, name: str) -> Column:
    """Whitelisted on the element, a prefix entry, or a safe framework attribute."""
    return F.expr(allowed_sql(tag, name))


def attribute_value_valid(tag: str, name: str, value: str) -> Column:
    """Value check against the enumerated lists; unknown attributes are invalid."""
    return F.expr(value_valid_sql(tag, name, value))


def is_known_attribute(name: str) -> Column:
    """Used by any specified element, or an aria / data / framework dynamic name; ``on*`` never."""
    return F.expr(known_sql(name))


def is_dangerous_value(value: str) -> Column: return F.expr(dangerous_sql(value))
def is_safe_uri(value: str) -> Column: return F.expr(safe_uri_sql(value))
def is_valid_target(value: str) -> Column: return F.expr(target_sql(value))
