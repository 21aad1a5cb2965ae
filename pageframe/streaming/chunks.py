"""Pages arriving in chunks: reassembly, protocol checks, streaming twins of row-local operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.text import interpolate, normalize_html_string
from ..operators.shred import shred
from ..operators.template import sanitize_column
from ..operators.tokens import tokenize

BLOCK = 1024   # chunks concatenated per first-level group


def split_pages(pages: DataFrame, size: int, ts: Column | None = None) -> DataFrame:
    """pages -> chunks rows: begin, pieces of ``size`` characters, end."""
    pieces = F.regexp_extract_all("html", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    row = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.cast("string").alias("chunk"))
    rows = F.concat(F.array(row("begin", F.lit(None))), F.transform(pieces, lambda p: row("chunk", p)),
                    F.array(row("end", F.lit(None))))
    ts = F.lit("2024-01-01").cast("timestamp") if ts is None else ts
    return pages.select("page_id", ts.alias("ts"), F.posexplode(rows).alias("seq", "r")).select(
        "page_id", "seq", "r.kind", "r.chunk", "ts")


def deduplicate(chunks: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Drop repeated (page_id, seq) rows; on a stream, rows later than the watermark are dropped and
    counted in the query progress (numRowsDroppedByWatermark)."""
    if chunks.isStreaming:
        return chunks.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["page_id", "seq"])
    return chunks.dropDuplicates(["page_id", "seq"])


def _joined(order: str, text: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text]), "")


def reassemble_batch(chunks: DataFrame) -> DataFrame:
    """(page_id, html, n_chunks): chunk texts joined in ``seq`` order.

    Two levels, blocks of consecutive chunks first: a page cut into very many chunks is spread over
    tasks, and only its few blocks meet at the end, where the page string itself is built."""
    blocks = (chunks.filter("kind = 'chunk'").withColumn("_block", F.floor(F.col("seq") / BLOCK))
              .groupBy("page_id", "_block").agg(_joined("seq", "chunk").alias("_text"), F.count("*").alias("_n")))
    return blocks.groupBy("page_id").agg(_joined("_block", "_text").alias("html"), F.sum("_n").alias("n_chunks"))


def reassemble(chunks: DataFrame, gap: str = "30 seconds", watermark: str = "1 minute") -> DataFrame:
    """Streaming reassembly: (page_id, html, n_chunks, error), emitted (append mode) when a session closes.

    A session is a page when it holds one begin row numbered 0, one end row and every number between;
    rows that arrive twice count once.  Anything else, a page with a missing chunk or the halves of one
    that paused for longer than ``gap``, is reported as a row with null html and an error."""
    stream = chunks.withWatermark("ts", watermark)
    sessions = stream.groupBy(F.session_window("ts", gap), "page_id").agg(
        F.array_sort(F.collect_set(F.struct("seq", "kind", "chunk"))).alias("_rows"))
    count = lambda kind: F.size(F.filter("_rows", lambda r: r["kind"] == kind))
    first, last, n = F.get("_rows", F.lit(0)), F.get("_rows", F.size("_rows") - 1), F.size("_rows")
    error = (F.when(count("begin") > 1, "begin twice").when((first["kind"] != "begin") | (first["seq"] != 0), "no begin")
             .when((count("end") != 1) | (last["kind"] != "end"), "no end").when(last["seq"] != n - 1, "missing seq"))
    html = F.array_join(F.transform("_rows", lambda r: F.coalesce(r["chunk"], F.lit(""))), "")
    return sessions.select("page_id", F.when(error.isNull(), html).alias("html"),
                           count("chunk").cast("long").alias("n_chunks"), error.alias("error"))


class _Assembler(StatefulProcessor):
    """Holds the chunks of one page until its ``end`` row and all sequence numbers are in.

    A batch of rows costs one write of each state: the new chunks are appended as a list, and a small value keeps the
    numbers seen (a bit each), the number of the end row, and whether the page is out already."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.parts = handle.getListState("parts", "seq int, kind string, chunk string")
        self.seen = handle.getValueState("seen", "bits binary, end_seq int, last_ms bigint, done boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bits, end, last, done = self.seen.get() if self.seen.exists() else (b"", -1, 0, False)
        bits, new = int.from_bytes(bits, "little"), []
        for pdf in rows:
            last = max(last, int(pdf["event_ms"].max()))
            for seq, kind, chunk in zip(pdf["seq"], pdf["kind"], pdf["chunk"]):
                if not bits >> int(seq) & 1:
                    bits |= 1 << int(seq)
                    new.append((int(seq), kind, chunk if isinstance(chunk, str) else None))
                    end = int(seq) if kind == "end" and end < 0 else end
        if not done and end >= 0 and bits.bit_count() == end + 1:   # the parts are read once, when all are in
            parts = sorted([*self.parts.get(), *new] if self.parts.exists() else new, key=lambda p: p[0])
            errors = [] if parts[0][1] == "begin" else ["chunk before begin"]
            errors += ["begin twice"] * (sum(p[1] == "begin" for p in parts) > 1)
            yield self._row(key, "".join(p[2] or "" for p in parts if p[1] == "chunk"), len(parts), "; ".join(errors) or None)
            self.parts.clear()
            done, new = True, []
            if not self.idle_ms:
                self.seen.clear()
                return
        if new and not done:
            self.parts.appendList(new)
        self.seen.update((bits.to_bytes((bits.bit_length() + 7) // 8, "little"), end, last, done))
        if self.idle_ms:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(last + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        bits, _, _, done = self.seen.get() if self.seen.exists() else (b"", -1, 0, True)
        self.parts.clear()
        self.seen.clear()
        if not done:
            yield self._row(key, None, int.from_bytes(bits, "little").bit_count(), "abandoned before end")

    @staticmethod
    def _row(key, html, n, error):
        return pd.DataFrame({"page_id": [key[0]], "html": [html], "n_rows": [n], "error": [error]})

    def close(self) -> None:
        pass


def reassemble_eager(chunks: DataFrame, idle_ms: int = 600_000, watermark: str = "1 minute") -> DataFrame:
    """Emit each page as soon as its last missing row arrives: (page_id, html, n_rows, error).

    A page that got no row for ``idle_ms`` of event time, as the watermark tells, is reported as abandoned and its
    state dropped, also in a run that ends with its input (``availableNow``).  A finished page is remembered that long,
    so rows that arrive again do not open it anew.  With ``idle_ms=0`` unfinished pages stay in state.  Needs the
    RocksDB state store."""
    stream = chunks.withWatermark("ts", watermark) if idle_ms else chunks
    stream = stream.withColumn("event_ms", F.coalesce(F.unix_millis("ts"), F.lit(0)) if idle_ms else F.lit(0).cast("long"))
    return stream.groupBy("page_id").transformWithStateInPandas(
        statefulProcessor=_Assembler(idle_ms), outputStructType="page_id long, html string, n_rows int, error string",
        outputMode="append", timeMode="EventTime" if idle_ms else "None")


def chunk_protocol_errors(chunks: DataFrame) -> DataFrame:
    """(page_id, seq, kind, error): chunk before begin, begin twice, end without begin, missing seq.

    Sequences are checked per block of consecutive numbers; what a block needs to know about the
    rows before it (last marker, last seq) comes from one summary row per earlier block."""
    rows = chunks.select("page_id", "seq", "kind").withColumn("_block", F.floor(F.col("seq") / BLOCK))
    marker = F.when(F.col("kind").isin("begin", "end"), F.col("kind"))
    summary = rows.groupBy("page_id", "_block").agg(
        F.max_by(marker, F.when(marker.isNotNull(), F.col("seq"))).alias("_m"), F.max("seq").alias("_s"))
    earlier = Window.partitionBy("page_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select("page_id", "_block", F.last("_m", ignorenulls=True).over(earlier).alias("_carry_m"),
                           F.max("_s").over(earlier).alias("_carry_s"))
    here = Window.partitionBy("page_id", "_block").orderBy("seq")
    seen = rows.withColumns({
        "_state": F.last(marker, ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, -1)),
        "_prev": F.lag("seq").over(here)}).join(carry, ["page_id", "_block"])
    opened = F.coalesce(F.coalesce("_state", "_carry_m") == "begin", F.lit(False))
    prev = F.coalesce("_prev", "_carry_s", F.lit(-1))
    errors = F.array_compact(F.array(
        F.when((F.col("kind") == "chunk") & ~opened, F.lit("chunk before begin")),
        F.when((F.col("kind") == "begin") & opened, F.lit("begin twice")),
        F.when((F.col("kind") == "end") & ~opened, F.lit("end without begin")),
        F.when(F.col("seq") - prev > 1, F.lit("missing seq"))))
    return seen.select("page_id", "seq", "kind", F.explode(errors).alias("error"))


# -- row-local operators on streams: the batch functions unchanged -----------------------------------

def stream_tokenize(pages: DataFrame) -> DataFrame: return tokenize(pages)
def stream_shred(pages: DataFrame) -> DataFrame: return shred(pages, cluster=False)


def stream_normalize(pages: DataFrame, **options) -> DataFrame:
    return pages.withColumn("html", normalize_html_string(F.col("html"), **options))


def stream_sanitize(df: DataFrame, column: str = "html", mode="strict") -> DataFrame:
    """Sanitise a column of snippets; whole pages go through ``page_sink`` and the batch operators."""
    return sanitize_column(df, column, mode)


def stream_interpolate(df: DataFrame, template: str, values: Column, escape: bool = True) -> DataFrame:
    return df.withColumn("html", interpolate(F.lit(template), values, escape))


def page_sink(pages: DataFrame, transform, write):
    """Writer of ``transform(nodes)`` per micro-batch, page-level joins and aggregates included.

    ``write`` is the folder of the result: a batch writes ``batch=<id>`` there and replaces what an earlier attempt at the
    same batch left, so a batch that is run again, after a failure or from a lost checkpoint over the same input, leaves
    its rows once.  It may also be a function of (df, batch_id), which must be idempotent itself."""
    def replace(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{write}/batch={batch_id}")
    sink = replace if isinstance(write, str) else write
    return pages.writeStream.foreachBatch(lambda df, batch_id: sink(transform(shred(df)), batch_id))


def drain(rows: DataFrame, root: str) -> DataFrame:
    """Run a stream to the end of its input, appending to ``root``/out, and its counts to ``root``/counts:
    (run, batch, n_input, n_late, n_repeated) from the query's progress.  Returns all rows written so far.

    n_late are rows dropped as later than the watermark, n_repeated those dropped as seen before.  Progress keeps as
    many batches as ``spark.sql.streaming.numRecentProgressUpdates``; a run of more has only its last ones counted."""
    spark = rows.sparkSession
    query = (rows.writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    counts = []
    for p in query.recentProgress:
        late = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        repeated = sum(int(o.customMetrics.get("numDroppedDuplicateRows", 0)) for o in p.stateOperators)
        counts.append((str(query.runId), p.batchId, p.numInputRows, late, repeated))
    table = spark.createDataFrame(counts, "run string, batch long, n_input long, n_late long, n_repeated long")
    table.coalesce(1).write.mode("append").parquet(f"{root}/counts")
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


def drain_counts(spark, root: str) -> DataFrame:
    """The counts that :func:`drain` has kept below ``root``; a batch reported twice counts once."""
    return spark.read.parquet(f"{root}/counts").dropDuplicates(["run", "batch"])
