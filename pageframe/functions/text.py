"""String-level HTML functions: escaping, whitespace, string normalisation, interpolation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NBSP = " "


def _replace(c: Column, *pairs) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def escape_html(c: Column) -> Column:
    """Escape ``& < > " '`` for safe embedding as text."""
    return _replace(c, ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;"))


def text_node_sql(x: str) -> str:
    """Serialiser escaping of character data, as SQL text."""
    for old, new in (("&", "&amp;"), (NBSP, "&nbsp;"), ("<", "&lt;"), (">", "&gt;")):
        x = f"replace({x}, '{old}', '{new}')"
    return x


def attr_value_sql(x: str) -> str:
    """Serialiser escaping of attribute values, as SQL text."""
    return f"replace({text_node_sql(x)}, '\"', '&quot;')"


def normalize_text(c: Column) -> Column:
    """Collapse whitespace runs, drop them between ``>`` and ``<``, trim."""
    one = F.regexp_replace(c, r"[ \t\n\r\x0B\f]+", " ")
    return F.trim(F.replace(one, F.lit("> <"), F.lit("><")))


# Grammar of the string normaliser: a tag ends at the first '>', preserve tags are lower case and
# followed by a space or '>', anything unterminated is kept verbatim to the end of the string.
_COMMENT = r"<!--.*?-->"
_KEEP = "|".join([
    r"<!--(?!.*?-->).+",
    r"<(pre|textarea|script|style|code)(?=[ >])[^>]*>(?:.*?</\{g}>|.*)",
    r"<(?!!--.)[^>]*>",
    r"<.*",
])


def normalize_html_string(c: Column, remove_comments: bool = False,
                          remove_whitespace_text_nodes: bool = True) -> Column:
    """Drop whitespace-only text between tags (and comments), keep preserved bodies verbatim.

    One regexp pass: everything to keep is captured as group 1, the rest matches outside of it.
    """
    keep = _KEEP.replace("{g}", "2")
    comment = _COMMENT if remove_comments else r"(?!)"
    kept = keep if remove_comments else _COMMENT + "|" + keep
    text = r"[ \t\n\r]*+[^< \t\n\r][^<]*+" if remove_whitespace_text_nodes else r"[^<]++"
    return F.regexp_replace(c, f"(?s){comment}|({kept}|{text})|[ \\t\\n\\r]+", "$1")


def interpolate(template: Column, values: Column, escape: bool = True) -> Column:
    """Replace every ``{key}`` in one pass; unknown placeholders stay as they are.

    ``escape=False`` inserts values raw and expands placeholders inside values as well, one key
    after the other.
    """
    if not escape:
        return F.aggregate(F.map_entries(values), template, lambda acc, e: F.replace(
            acc, F.concat(F.lit("{"), e["key"], F.lit("}")), F.coalesce(e["value"], F.lit(""))))
    parts = F.regexp_extract_all(template, F.lit(r"\{[^{}]*\}|[^{]+|\{"), F.lit(0))

    def fill(p):
        value = F.try_element_at(values, F.regexp_replace(p, r"^\{|\}$", ""))
        return F.when(p.rlike(r"^\{[^{}]*\}$"), F.coalesce(escape_html(value), p)).otherwise(p)

    return F.array_join(F.transform(parts, fill), "")
