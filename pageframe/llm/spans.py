"""Substring dedup by sliding sentence spans: later copies of a run of sentences are cut out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pageframe.llm.common import arrow_map, saved, without

SENTENCES = 2    # a span is the shortest run of consecutive sentences that has so many of them ...
WORDS = 0        # ... and so many words: no minimum
ALONE = 50       # a sentence of more words can be a span by itself, and so can the only one of a text
# Zero-width cuts: after a line break, or after a sentence end and the white space behind it.
CUT = r"""(?<=\s)(?=\S)(?:(?<=\n)|(?<=[.!?…。！？]\s)|(?<=[.!?…。！？]["'”»)]\s)|(?<=[.!?…。！？]\s\s))"""

SPAN_FIELDS = "`low` long, `high` long, doc long, text_hash long, start int, until int"


def sentences_of(text: str, cut) -> list[str]:
    """The sentences, white space behind them included: joined they are the text."""
    return cut.split(text)


def sentence_spans(docs: DataFrame, sentences: int = SENTENCES, words: int = WORDS, alone: int | None = None) -> DataFrame:
    """One row per span: a 128-bit hash of its words in lower case, its document and its sentence numbers."""

    def run(batch):
        import hashlib
        import re

        import numpy as np
        import pyarrow as pa

        cut = re.compile(CUT)
        digests, rows, starts, ends = [], [], [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            if not text:
                continue
            parts = [s.lower().split() for s in sentences_of(text, cut)]
            length = [len(p) for p in parts]
            plain = [" ".join(p).encode() + b"\n" for p in parts]
            if alone is not None:
                only = sum(map(bool, length)) == 1
                for at in range(len(parts)):
                    if length[at] > (0 if only else alone):
                        digests.append(hashlib.blake2b(plain[at], digest_size=16).digest())
                        rows.append(row)
                        starts.append(at)
                        ends.append(at + 1)
            end = total = 0
            for at in range(len(parts)):
                while end < len(parts) and (end - at < sentences or total < words):
                    total += length[end]
                    end += 1
                if end - at < sentences or total < words:
                    break
                digests.append(hashlib.blake2b(b"".join(plain[at:end]), digest_size=16).digest())
                rows.append(row)
                starts.append(at)
                ends.append(end)
                total -= length[at]
        hashes = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
        of = pa.array(rows, pa.int32())
        return pa.RecordBatch.from_pydict({
            "low": np.ascontiguousarray(hashes[:, 0]), "high": np.ascontiguousarray(hashes[:, 1]),
            "doc": batch.column("doc").take(of), "text_hash": batch.column("text_hash").take(of),
            "start": pa.array(starts, pa.int32()), "until": pa.array(ends, pa.int32())})

    return arrow_map(docs.select(*_names(), "text"), run, SPAN_FIELDS)


def _names():
    """What names a document in span rows: its id (the largest number for null) and a hash of its text."""
    return (F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("text_hash"))


def repeated_spans(docs: DataFrame, sentences: int = SENTENCES, words: int = WORDS, alone: int | None = None) -> DataFrame:
    """(doc, text_hash, spans): per document the spans that occur before it or earlier in it.

    First come the hashes that occur twice, counted with map-side sums; only their spans are then
    brought together, the first of each hash found by a minimum, and the others kept.  A passage that a
    third of all documents hold costs one row per occurrence; the joins may split it.
    """
    spans = sentence_spans(docs, sentences, words, alone)
    often = saved(spans.groupBy("low").agg(F.count("*").alias("n")).where("n > 1").select("low"), "span-hashes")
    shared = saved(spans.join(often, "low"), "shared-spans")
    place = F.struct("doc", "text_hash", "start")
    first = saved(shared.groupBy("low", "high").agg(F.min(place).alias("first")), "first-spans")
    later = shared.join(first, ["low", "high"]).where(place != F.col("first"))
    return later.groupBy("doc", "text_hash").agg(F.array_sort(F.collect_set(F.struct("start", "until"))).alias("spans"))


def cut_repeats(docs: DataFrame, *, sentences: int = SENTENCES, words: int = WORDS, alone: int | None = None) -> DataFrame:
    """All columns of `docs`, the text without sentences of repeated spans, and n_sentences, n_removed.

    A span is the shortest run of consecutive sentences, from each sentence on, with at least `sentences`
    sentences and `words` words (by default every run of two); case and white space don't count.  With
    `alone`, a sentence of more than `alone` words is a span of its own too, and so is the only sentence of
    a text, however short.  Of equal spans the first, by doc_id
    (null last), text hash and place, stays; every sentence inside any other goes.  Other texts are
    unchanged to the byte.  A null text stays null with no sentences; an empty one has none.  Repeated
    rows (same id and text) are one document to this operator and get the same result.  Columns named
    n_sentences or n_removed are replaced.
    """
    base = without(docs, "n_sentences", "n_removed", "_doc", "_hash")
    found = repeated_spans(docs, sentences, words, alone).toDF("_doc", "_hash", "_spans")
    doc, text_hash = _names()
    joined = base.withColumns({"_doc": doc, "_hash": text_hash}).join(found, ["_doc", "_hash"], "left")

    @F.arrow_udf("struct<text:string,n_sentences:long,n_removed:long>")
    def remove(texts, spans):
        import re

        import pyarrow as pa

        cut, out = re.compile(CUT), []
        for text, ranges in zip(texts.to_pylist(), spans.to_pylist()):
            parts = sentences_of(text, cut) if text else []
            keep, at = [], 0
            for r in ranges or []:                          # sorted by start: one pass
                keep += parts[at:r["start"]]
                at = max(at, r["until"])
            keep += parts[at:]
            out.append({"text": "".join(keep) if ranges and text else text, "n_sentences": len(parts),
                        "n_removed": len(parts) - len(keep)})
        return pa.array(out, pa.struct([("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64())]))

    done = joined.withColumn("_done", remove("text", "_spans"))
    columns = [F.col("_done.text").alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in base.columns]
    return done.select(*columns, "_done.n_sentences", "_done.n_removed")
