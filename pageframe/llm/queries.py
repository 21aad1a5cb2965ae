"""Registered queries of the dealt operators: thin rows over each operator's own outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pageframe.llm import conversations, decontamination, licenses, near_dup, packing, pii, quality, search, secret_scan, sharding, spans, url_filter, warc
from pageframe.llm.common import shared_folder, table, tune
from pageframe.llm.oracles import ORACLES  # noqa: F401  registered beside the queries


def op1_hypergeometric_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    dealt = sharding.shuffle(rows, 8)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pii.surrogates(docs, key="corpus")
    return done.select("doc_id", "text", *[F.col(f"entities.{k}").alias(f"n_{k}") for k in pii.PATTERNS])


def op3_pack_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(tune(spark), sf_dir, "documents"), with_ids=False, added=packing.ADDED)


def op4_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean(table(tune(spark), sf_dir, "documents"), with_text=False)


def op5_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(tune(spark), sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op6_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents").select("doc_id", "text")
    return spans.cut_repeats(docs, alone=spans.ALONE)


def op7_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(tune(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.search(docs, benchmark, unnamed=True)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        "longest", "longest_item", "longest_start")


def op9_secret_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "markov")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"),
                        count("markov"))


def op10_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(tune(spark), sf_dir, "documents"))


def op11_warc_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(warc.page_records(table(tune(spark), sf_dir, "pages")), folder)
    return warc.page_report(warc.read(spark, folder), warc.read(spark, folder, payload=False))


def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(tune(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_interval_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(table(tune(spark), sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_hypergeometric_shuffle, op2_surrogates, op3_pack_power_of_two, op4_quality_lines, op5_url_automaton, op6_license_digests,
    op7_suffix_arrays, op8_sentence_spans, op9_secret_models, op10_bottom_k,
    op11_warc_source, op12_reversed_search, op13_interval_repair)}

