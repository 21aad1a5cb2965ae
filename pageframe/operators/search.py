"""Element search by walker semantics: body descendants, case-sensitive tokens and values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .select import first_per_page


def _elements(nodes: DataFrame, scope: str) -> DataFrame:
    """Elements below body (body itself excluded), or every element of the page."""
    if scope not in ("body", "document"):
        raise ValueError(f"unknown scope: {scope}")
    found = nodes.filter((F.col("node_type") == "element") & (F.col("tree_id") == 0))
    return found.filter(F.col("in_body") & (F.col("tag") != "body")) if scope == "body" else found


def find_elements(nodes: DataFrame, predicate: Column, scope: str = "body") -> DataFrame:
    """All elements satisfying a Column predicate."""
    return _elements(nodes, scope).filter(predicate)


def find_first(nodes: DataFrame, predicate: Column, scope: str = "body") -> DataFrame:
    return first_per_page(find_elements(nodes, predicate, scope))


def map_elements(nodes: DataFrame, **columns: Column) -> DataFrame:
    """Process every element: named Column expressions, other node kinds keep their values."""
    element = F.col("node_type") == "element"
    return nodes.withColumns({
        n: F.when(element, c).otherwise(F.col(n)) if n in nodes.columns else F.when(element, c)
        for n, c in columns.items()})


def _attr(name: str, value: str | None, insensitive: bool = False) -> Column:
    def test(a):
        hit = a["name"] == name
        if value is None:
            return hit
        have = F.coalesce(a["value"], F.lit(""))
        return hit & (F.lower(have) == value.lower() if insensitive else have == value)
    return F.exists("attrs", test)


def id_is(value: str) -> Column: return F.coalesce(F.col("id") == value, F.lit(False))
def name_is(value: str) -> Column: return _attr("name", value)


def elements_by_class(nodes, name, scope="body"): return find_elements(nodes, F.array_contains("classes", name), scope)
def elements_by_tag(nodes, tag, scope="body"): return find_elements(nodes, F.col("tag") == tag.lower(), scope)
def elements_by_id(nodes, value, scope="body"): return find_elements(nodes, id_is(value), scope)


def elements_by_attribute(nodes, name, value, case_insensitive=False, scope="body"):
    return find_elements(nodes, _attr(name, value, case_insensitive), scope)


def elements_by_name(nodes, value, scope="body"): return find_elements(nodes, name_is(value), scope)
def elements_with_attribute(nodes, name, scope="body"): return find_elements(nodes, _attr(name, None), scope)
def first_by_id(nodes, value, scope="body"): return first_per_page(elements_by_id(nodes, value, scope))
def first_by_class(nodes, name, scope="body"): return first_per_page(elements_by_class(nodes, name, scope))
def first_by_tag(nodes, tag, scope="body"): return first_per_page(elements_by_tag(nodes, tag, scope))
def first_by_attribute(nodes, name, value=None, scope="body"): return find_first(nodes, _attr(name, value), scope)


def first_by_data_attribute(nodes, prefix, name, value=None, scope="body"):
    return first_by_attribute(nodes, f"{prefix}-{name}", value, scope)
