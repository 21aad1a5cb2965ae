"""Session defaults for page-keyed plans.  Operators never touch the session: call ``tune`` where you build it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Setting: Spark's own value, ours.
DEFAULTS = {
    # Joins on (page_id, parent_id, ...) may reuse a distribution on page_id alone.  Leave this out where
    # other joins of the session are skewed on a part of their keys.
    "spark.sql.requireAllClusterKeysForCoPartition": ("true", "false"),
    # One page expands to many nodes: keep Arrow batches small enough for a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "512"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", str(16 << 20)),
    # Parsing is CPU-bound: do not coalesce a small input below the core count.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": ("1048576b", "256k"),
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the values above where the session still has Spark's own; what was set at start or run time stays."""
    for key, (sparks, ours) in DEFAULTS.items():
        if spark.conf.get(key).lower() in (sparks, sparks.removesuffix("b"), "1mb" if sparks == "1048576b" else sparks):
            spark.conf.set(key, ours)
    return spark


# Node rows of one task, about.  A chain of edits sorts each of them some ten times, and what its sorts hold adds up: small
# enough for one memory page of an executor each, so that a task needs about as much on a small input as on a large one.
TASK_NODES = 25_000


def tasks_for(spark: SparkSession, nodes: int) -> int | None:
    """Partitions for about so many node rows.  None where Spark's own choice, no fewer tasks than cores, is fine enough."""
    n = -(-nodes // TASK_NODES)
    return n if n > spark.sparkContext.defaultParallelism else None


# Up to so many parts Spark's shuffle writes each row straight to its part; with more, a task holds the rows it deals out.
DIRECT_PARTS = 200


def spread_parts(spark: SparkSession, nodes: int) -> int:
    """Tasks that parse rows of about so many nodes.  No more than DIRECT_PARTS while each then parses at most 16 parts of
    ``tasks_for``: the task that reads the input holds nothing, and the one that parses holds what it parses."""
    n = tasks_for(spark, nodes) or max(1, min(spark.sparkContext.defaultParallelism, -(-nodes // (TASK_NODES // 5))))
    return min(n, max(DIRECT_PARTS, -(-n // 16)))


def spread(df: DataFrame, nodes: int, *by: str) -> DataFrame:
    """Rows dealt out by the columns ``by`` before they are parsed to about so many node rows: a file, which Spark reads in one
    task or a few, may hold very many of them.  Give a key and a text, so that rows of one key are dealt out too."""
    return df.repartition(spread_parts(df.sparkSession, nodes), *by)


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only a local master, whose tasks share the driver's disk, gets one of its own when that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back: every reader sees the same rows in the same places."""
    import uuid
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
