"""Column functions over node rows: names, kinds, attributes, classes, whitespace tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------
KNOWN_TAGS = (
    "a abbr address area article aside audio b base bdi bdo blockquote body br button canvas caption "
    "cite code col colgroup data datalist dd del details dfn dialog div dl dt em embed fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html i iframe img input ins "
    "kbd label legend li link main map mark menu meta meter nav noscript object ol optgroup option "
    "output p picture pre progress q rp rt ruby s samp script section select slot small source span "
    "strong style sub summary sup table tbody td template textarea tfoot th thead time title tr track "
    "u ul video wbr svg circle rect path line text g defs use"
).split()
VOID_TAGS = "area base br col embed hr img input link meta source track wbr".split()
PRESERVE_TAGS = "pre textarea script style code".split()
NO_ESCAPE_TAGS = "script style iframe".split()
# -------------------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_element(kind="node_type"): return _c(kind) == "element"
def is_text(kind="node_type"): return _c(kind) == "text"
def is_comment(kind="node_type"): return _c(kind) == "comment"
def is_document(kind="node_type"): return _c(kind) == "document"
def is_fragment(kind="node_type"): return _c(kind) == "fragment"


def node_type_name(kind="node_type") -> Column:
    """``#element``, ``#text``, ``#comment``, ``#document``, ``#document-fragment`` or ``#unknown``."""
    k = _c(kind)
    return (F.when(k.isin("element", "text", "comment", "document"), F.concat(F.lit("#"), k))
            .when(k == "fragment", "#document-fragment").otherwise("#unknown"))


def node_name(kind="node_type", tag="tag") -> Column:
    """DOM node name: upper-case tag for elements, ``#text`` and the like for the rest."""
    return F.when(is_element(kind), F.upper(_c(tag))).otherwise(node_type_name(kind))


def tag_name(tag="tag") -> Column: return F.upper(_c(tag))
def qualified_name(tag="tag") -> Column: return _c(tag)


def known_tag(tag="tag") -> Column:
    """The tag itself when it is a standard name, otherwise ``custom``."""
    return F.when(_c(tag).isin(KNOWN_TAGS), _c(tag)).otherwise("custom")


def is_known_tag(tag="tag") -> Column: return _c(tag).isin(KNOWN_TAGS)
def is_custom_element(tag="tag") -> Column: return _c(tag).contains("-")
def matches_tag(name: str, tag="tag") -> Column: return _c(tag) == name.lower()
def is_void(tag="tag") -> Column: return F.coalesce(_c(tag).isin(VOID_TAGS), F.lit(False))
def preserves_whitespace(tag="tag") -> Column: return F.coalesce(_c(tag).isin(PRESERVE_TAGS), F.lit(False))
def is_raw_text(tag="tag") -> Column: return F.coalesce(_c(tag).isin(NO_ESCAPE_TAGS), F.lit(False))


def is_whitespace_only(text="text") -> Column: return _c(text).rlike(r"^[ \t\n\r\x0B\f]*\z")
def is_text_empty(text="text") -> Column: return _c(text).rlike(r"^[ \t\n\r]*\z")
def is_collapsible_ws(text="text") -> Column: return _c(text).rlike(r"^[\t\n\r]*\z")


def attr_value(name: str, attrs="attrs") -> Column:
    """Value of an attribute: null when absent, '' when present without a value."""
    hit = F.filter(_c(attrs), lambda a: a["name"] == name)
    return F.when(F.size(hit) > 0, F.coalesce(F.get(hit, F.lit(0))["value"], F.lit("")))


def attr_sql(name: str, attrs: str = "attrs") -> str:
    """:func:`attr_value` of a plain attribute name as SQL text."""
    return f"get(transform(filter({attrs}, a -> a.name = '{name}'), a -> coalesce(a.value, '')), 0)"


def classes_sql(attrs: str = "attrs") -> str:
    """Distinct class tokens in first-seen order, as SQL text."""
    tokens = f"split(coalesce({attr_sql('class', attrs)}, ''), '[ \\\\t\\\\n\\\\r\\\\f]+')"
    return f"array_distinct(filter({tokens}, t -> t <> ''))"


def get_attribute(name: str, attrs="attrs") -> Column: return attr_value(name, attrs)
def has_attribute(name: str, attrs="attrs") -> Column: return F.exists(_c(attrs), lambda a: a["name"] == name)
def has_attributes(attrs="attrs") -> Column: return F.size(_c(attrs)) > 0
def element_id(attrs="attrs") -> Column: return F.coalesce(attr_value("id", attrs), F.lit(""))


def has_element_id(value: str, attrs="attrs") -> Column:
    """Empty ids never match."""
    return F.lit(False) if value == "" else F.coalesce(attr_value("id", attrs) == value, F.lit(False))


def class_tokens(text: Column) -> Column:
    """Distinct class tokens in first-seen order."""
    return F.array_distinct(F.filter(F.split(text, r"[ \t\n\r\f]+"), lambda t: t != ""))


def class_list(attrs="attrs") -> Column:
    return F.coalesce(class_tokens(attr_value("class", attrs)), F.array().cast("array<string>"))


def class_string(attrs="attrs") -> Column: return F.coalesce(attr_value("class", attrs), F.lit(""))
def class_count(attrs="attrs") -> Column: return F.size(class_list(attrs))
def has_class(name: str, classes="classes") -> Column: return F.array_contains(_c(classes), name)


def string_equals(a: Column, b: Column) -> Column: return a == b
def string_contains(where: Column, what: Column) -> Column: return F.contains(where, what)
