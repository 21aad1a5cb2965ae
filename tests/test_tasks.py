"""Work of large inputs is dealt out to tasks of bounded size."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from pageframe import session
from pageframe.operators import shred
from pageframe.plans import queries as Q
from pageframe.plans import varied

NAV = "<nav><ul><li><a href='/{0}'>x</a><li>{0}</ul></nav><p>{0}"


@pytest.fixture(scope="module")
def folder(spark):
    """Tables of one file and one row group each, the last rows without a key or text."""
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    n = 400
    part = spark.range(n).selectExpr("id AS p_partkey", "concat('name ', id) AS p_name", "concat('Brand#', id % 5) AS p_brand",
                                     "CASE WHEN id % 9 <> 8 THEN 'SMALL' END AS p_type", "int(id % 50) AS p_size", "id * 1.5 AS p_retailprice")
    part.toPandas().to_parquet(f"{path}/part.parquet")
    pages = spark.createDataFrame([(i, f"https://a/{i}", NAV.format(i) if i % 10 else None) for i in range(120)], "page_id long, url string, html string")
    pages.toPandas().to_parquet(f"{path}/pages.parquet")
    return path


def _rows(df): return sorted(map(str, df.collect()))


def test_count_of_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.tasks_for(spark, 0) is None and session.tasks_for(spark, cores * session.TASK_NODES) is None
    assert session.tasks_for(spark, 500 * session.TASK_NODES + 1) == 501


def test_estimate_of_nodes(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    n = shred.shred(pages, cluster=False).count()
    assert n <= shred.node_estimate(pages) <= 2 * n
    assert shred.node_estimate(pages.limit(0)) == 0


def test_tasks_of_edits_stay_small(spark, folder):
    """What the sorts of one task hold adds up, so tasks are as small on large inputs as on small ones; long texts count."""
    cores = spark.sparkContext.defaultParallelism
    assert session.tasks_for(spark, cores * 200_000) >= 8 * cores
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    long = pages.withColumn("html", F.concat(F.lit("<p>"), F.repeat(F.lit("é "), 500_000)))
    assert shred.node_estimate(long) >= 120 * 3_000
    bare = pages.withColumn("html", F.lit(None).cast("string"))
    assert shred.node_estimate(bare) == 120 * 5


@pytest.mark.parametrize("query", [Q.set_text, Q.edit_log, Q.insert_items, Q.insert_nested_siblings, Q.insert_banner,
                                   Q.replace_children, Q.insert_parsed, Q.append_fragment, Q.set_inner_html, varied.append_parsed])
def test_no_task_of_an_edit_is_large(spark, folder, monkeypatch, query):
    """No sort follows an exchange other than the one that deals pages out by the count of their nodes."""
    monkeypatch.setattr(session, "TASK_NODES", session.TASK_NODES // 400)
    cut = query(spark, folder)
    assert cut.rdd.getNumPartitions() >= 13
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan.split("REPARTITION_BY_NUM")[0]


@pytest.mark.parametrize("query", [Q.sanitize_snippets, Q.audit_parts, Q.sanitize_none_parts, varied.sanitize_unlisted])
def test_snippets_of_one_file_are_dealt_out(spark, folder, query):
    """The tree kernel runs above the exchange that deals out the rows."""
    plan = query(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    kernel = plan.index("ArrowEvalPython")
    assert "Repartition" in plan[kernel:]


@pytest.mark.parametrize("query", [Q.edit_log, Q.insert_items, Q.insert_nested_siblings, Q.insert_banner, Q.set_inner_html,
                                   Q.insert_parsed, varied.append_parsed, Q.empty_nodes, varied.resolved_links])
def test_rows_of_large_tables_are_dealt_out_before_they_are_parsed(spark, folder, monkeypatch, query):
    """The task that reads a file must not hold the node rows of all of it, nor sort its rows to deal them out."""
    whole = _rows(query(spark, folder))
    monkeypatch.setattr(session, "TASK_NODES", 40)
    cut = query(spark, folder)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    kernel = plan.rindex("ArrowEvalPython [_page_tree")
    assert "RepartitionByExpression" in plan[kernel:] and _rows(cut) == whole


def test_count_of_parsing_tasks(spark):
    """Few enough to write rows straight to their parts, on large inputs of many parts each."""
    size = session.TASK_NODES
    assert session.spread_parts(spark, 150 * size) == 150 and session.spread_parts(spark, 3000 * size) == session.DIRECT_PARTS
    assert session.spread_parts(spark, 16_000 * size) == 1000
    assert session.spread_parts(spark, 0) == 1


@pytest.mark.parametrize("query", [Q.set_text, Q.copy_subtree, Q.import_subtree, Q.part_template_use, Q.parse_and_append, Q.form_states,
                                   Q.append_fragment, Q.insert_parsed, Q.set_inner_html, varied.append_parsed])
def test_edits_in_many_small_tasks(spark, folder, monkeypatch, query):
    whole = _rows(query(spark, folder))
    monkeypatch.setattr(session, "TASK_NODES", 80, raising=False)
    cut = query(spark, folder)
    assert cut.rdd.getNumPartitions() >= 13 and _rows(cut) == whole
    assert cut.withColumn("_p", F.spark_partition_id()).groupBy("_p").count().agg(F.max("count")).first()[0] <= len(whole) // 4
