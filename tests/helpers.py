from __future__ import annotations

from pyspark.sql import functions as F

from pageframe.operators import serialize, shred


def table(spark, htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")


def nodes(spark, *htmls): return shred.shred(table(spark, htmls))


def body_outer(n):
    found = serialize.outer_html(n, (F.col("tag") == "body") & (F.col("depth") == 1))
    return [r.outer_html for r in found.orderBy("page_id").collect()]


def body_inner(n):
    found = serialize.inner_html(n, (F.col("tag") == "body") & (F.col("depth") == 1))
    return [r.inner_html for r in found.orderBy("page_id").collect()]


def one(spark, column): return spark.range(1).select(column.alias("x")).first().x
