"""Helpers shared by the operators: table access, saved intermediate tables, row keys, Arrow maps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
_SPARKS_OWN = {"10000", str(64 << 20), str(256 << 20)}


def tune(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of the session in bytes, where it still has Spark's own settings."""
    for key, value in ARROW.items():
        if spark.conf.get(key).removesuffix("b") in _SPARKS_OWN:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: spark.checkpoint.dir.

    Where it is unset, a local master gets a folder of its own; a cluster is refused, since executors
    could not read each other's local files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="pageframe-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/pageframe-{spark.sparkContext.applicationId}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def block_numbers(rows: DataFrame, key: str, most: int) -> DataFrame:
    """(key, block) of rows (key, size), by key: a block ends with the row that fills it to `most`.

    Rows are laid out in ranges of the key; the totals of the ranges, one row each, give every range its start.
    """
    laid = saved(rows.select(key, "size").repartitionByRange(key).sortWithinPartitions(key).withColumn("_part", F.spark_partition_id()), "sizes")
    upto = Window.rowsBetween(Window.unboundedPreceding, -1)
    starts = laid.groupBy("_part").agg(F.sum("size").alias("whole")).withColumn("_start", F.sum("whole").over(upto.orderBy("_part")))
    before = F.coalesce(F.sum("size").over(upto.partitionBy("_part").orderBy(key)), F.lit(0)) + F.coalesce("_start", F.lit(0))
    return laid.join(starts.select("_part", "_start"), "_part").select(key, F.floor(before / int(most)).cast("long").alias("block"))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """16 bytes naming a document by id and text, nulls included; equal rows share it."""
    ident = F.coalesce(F.col(doc_id).cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(ident, F.lit("\n"), F.coalesce(F.concat(F.lit("t"), F.col(text)), F.lit("")))))


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the columns an operator is about to add; names are compared without case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def arrow_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow with a function from one record batch to one record batch."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)
