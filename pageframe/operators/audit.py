"""Attribute audit and per-page malicious-content reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import spec
from .shred import attributes


def _checks(attrs: DataFrame) -> DataFrame:
    """The individual tests as columns, each evaluated once."""
    return attrs.withColumns({
        "_danger": spec.is_dangerous_value("coalesce(value, '')"),
        "_event": F.expr("name RLIKE '^on[a-z]'"),
        "_allowed": spec.attribute_allowed("tag", "name"),
        "_known": spec.is_known_attribute("name"),
        "_valid": F.expr(f"{spec.value_valid_sql('tag', 'name', 'value')} OR name RLIKE '^(aria|data|x|v|phx)-'"),
    })


def audit_attributes(nodes: DataFrame) -> DataFrame:
    """findings: one row per attribute with verdict and reason; row-local, no shuffle."""
    c = F.col
    verdict = (
        F.when(c("_danger") | c("_event"), "dangerous")
        .when(~(c("_allowed") | c("_known")), "unknown")
        .when(c("_allowed") & ~c("_valid"), "invalid")
        .otherwise("ok"))
    reason = (
        F.when(c("_danger"), "dangerous value").when(c("_event"), "event handler")
        .when(~(c("_allowed") | c("_known")), "unknown attribute")
        .when(c("_allowed") & ~c("_valid"), "value not allowed")
        .when(~c("_allowed"), "not listed for element"))
    return _checks(attributes(nodes)).select(
        "page_id", "node_id", "tag", c("name").alias("attr"), "value", verdict.alias("verdict"), reason.alias("reason"))


def join_spec(attrs: DataFrame) -> DataFrame:
    """Attribute rows joined to the specification table (fixed size, safe to broadcast)."""
    table = F.broadcast(spec.spec_attrs(attrs.sparkSession).withColumnRenamed("attr", "name"))
    return attrs.join(table.withColumn("listed", F.lit(True)), ["tag", "name"], "left").withColumn(
        "listed", F.coalesce("listed", F.lit(False)))


def _attr_reason(name: str, value: str) -> str:
    """The audit reason of one attribute as SQL text; null when nothing is wrong."""
    allowed = spec.allowed_sql("tag", name)
    return f"""CASE WHEN {spec.dangerous_sql(f"coalesce({value}, '')")} THEN 'dangerous value'
        WHEN {name} RLIKE '^on[a-z]' THEN 'event handler'
        WHEN NOT ({allowed} OR {spec.known_sql(name)}) THEN 'unknown attribute'
        WHEN {allowed} AND NOT ({spec.value_valid_sql("tag", name, value)} OR {name} RLIKE '^(aria|data|x|v|phx)-')
        THEN 'value not allowed' END"""


def scan_pages(nodes: DataFrame, mode="strict") -> DataFrame:
    """(page_id, kind, reason, n): attribute findings and sanitiser removals counted per page.

    Both come from one pass over the nodes; only (page, kind, reason) counts are shuffled."""
    from .sanitize import Rules, options
    opts = options(mode)
    node = f"named_struct('kind', 'node', 'reason', {Rules(opts).reason() if opts else 'CAST(NULL AS STRING)'})"
    found = f"transform(attrs, a -> named_struct('kind', 'attribute', 'reason', {_attr_reason('a.name', 'a.value')}))"
    rows = nodes.selectExpr("page_id", f"explode(filter(concat(array({node}), {found}), x -> x.reason IS NOT NULL)) AS x")
    return rows.groupBy("page_id", F.col("x.kind").alias("kind"), F.col("x.reason").alias("reason")).agg(F.count("*").alias("n"))
