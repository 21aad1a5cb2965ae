"""Lossless tokenisation of HTML strings as a Catalyst expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Possessive groups keep the matcher iterative, so long attributes cannot exhaust the stack.
_IN_TAG = r"""(?:[^>="']++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+"""
RAW_TAGS = "script style textarea title iframe xmp noembed noframes".split()
_RAW = r"<({}script|style|textarea|title|iframe|xmp|noembed|noframes)(?=[\s/>])" + _IN_TAG
TOKEN_RX = "(?is)" + "|".join([
    r"<!--(?:-?>|.*?(?:--!?>|\z))",                                   # comment
    _RAW.format("") + r">.*?</\1(?=[\s/>])[^>]*>",                    # raw-text block
    _RAW.format("") + r"(?<!/)>.*\z",                                 # raw-text block without an end
    r"<[!?][^>]*(?:>|\z)",                                            # doctype, bogus comment
    r"</?[a-z]" + _IN_TAG + r"(?:>|\z)",                              # start or end tag
    r"</[^a-z][^>]*>",                                                # bogus end tag
    r"[^<]+",                                                         # text
    r"<",                                                             # stray <
])
ATTR_RX = r"""([^\s/>"'=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?"""


def token_array(html: Column) -> Column:
    """The page as an array of raw tokens; their concatenation is the input."""
    return F.regexp_extract_all(html, F.lit(TOKEN_RX), F.lit(0))


def token_tag(raw: Column) -> Column:
    """Lower-case tag name of a tag or raw block, null for anything else."""
    name = F.regexp_extract(raw, r"^</?([a-zA-Z][^\s/>]*)", 1)
    return F.when(raw.startswith("<") & (name != ""), F.lower(name))


def token_kind(raw: Column, tag: Column | None = None) -> Column:
    tag = token_tag(raw) if tag is None else tag
    closed = raw.rlike(r"(?is)</[a-z]+[^>]*>\z")
    return (
        F.when(~raw.startswith("<") | (raw == "<"), "text")
        .when(raw.startswith("</"), F.when(tag.isNull(), "comment").otherwise("end"))
        .when(tag.isNull(), F.when(F.lower(F.substring(raw, 1, 9)) == "<!doctype", "doctype").otherwise("comment"))
        .when(tag.isin(RAW_TAGS) & closed, "raw")
        .otherwise("start")
    )


def token_attrs(raw: Column) -> Column:
    """Attributes of a start tag as written (entities not decoded), first occurrence first."""
    inside = F.regexp_extract(raw, r"(?s)^<[a-zA-Z][^\s/>]*(" + _IN_TAG + ")>", 1)
    parts = F.regexp_extract_all(inside, F.lit(ATTR_RX), F.lit(0))
    return F.transform(parts, lambda a: F.struct(
        F.lower(F.regexp_extract(a, r"^([^\s=]+)", 1)).alias("name"),
        F.when(a.contains("="), F.regexp_replace(
            F.regexp_extract(a, r"(?s)^[^=]*=\s*(.*)$", 1), r"""(?s)^(["'])(.*)\1$""", "$2")).alias("value"),
    ))


def tokenize(pages: DataFrame) -> DataFrame:
    """One row per token: page_id, pos, kind, raw, tag, closing, attrs.  Row-local, no Python."""
    raw, tag = F.col("raw"), F.col("tag")
    source = pages.select("page_id", "html")
    return (
        source.select("page_id", F.posexplode(token_array(F.col("html"))).alias("pos", "raw"))
        .select("page_id", "pos", "raw", token_tag(raw).alias("tag"))
        .select(
            "page_id", "pos", token_kind(raw, tag).alias("kind"), "raw", "tag",
            raw.startswith("</").alias("closing"),
            F.when(tag.isNotNull() & ~raw.startswith("</"), token_attrs(raw)).alias("attrs"),
        )
    )
