"""Training-data pipeline: quality rules, near-duplicates, benchmark passages, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pageframe.llm import decontamination, near_dup, packing, quality, secret_scan
from pageframe.llm.common import saved, table, tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    tune(spark)
    return quality.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    tune(spark)
    return near_dup.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item."""
    return decontamination.keep_uncontaminated(docs, table(tune(spark), sf_dir, "benchmark"), unnamed=True)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    tune(spark)
    return secret_scan.redact(docs, secret_scan.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences, token ids included."""
    tune(spark)
    return packing.pack(docs, added=packing.ADDED)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_passages),
    ("secret_scans", secrets),
    ("packing", packed),
]

ORACLE_SQL = None   # tokenizers and trained models have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again, as between jobs."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
