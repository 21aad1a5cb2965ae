"""Chunk streams, streaming twins of batch operators, sources and sinks."""

from __future__ import annotations

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import body_inner, nodes
from pageframe.operators import normalize, sanitize, serialize, shred
from pageframe.sources import pages as P
from pageframe.streaming import chunks as S

WHOLE = "<html><body><h2>Stock</h2><p>Seven bolts</p></body></html>"
TAIL = "<html><body><p>open <i>all</i></section><u>end</u></body></html>"
SPLIT = [WHOLE[i:i + 9] for i in range(0, len(WHOLE), 9)]     # cuts fall inside tags
STRAY = [TAIL[i:i + 7] for i in range(0, len(TAIL), 7)]       # with an end tag that nothing opened


def _chunks(spark, **docs):
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for page, parts in enumerate(docs.values()):
        rows.append((page, 0, "begin", None, t0))
        rows += [(page, i, "chunk", p, t0 + dt.timedelta(seconds=i)) for i, p in enumerate(parts, 1)]
        rows.append((page, len(parts) + 1, "end", None, t0 + dt.timedelta(seconds=len(parts) + 1)))
    return spark.createDataFrame(rows, "page_id long, seq int, kind string, chunk string, ts timestamp")


def _folder(): return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def _stream(spark, df, files=3):
    path = _folder() + "/in"
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _drain(stream, mode="append"):
    out, check = _folder() + "/out", _folder()
    q = (stream.writeStream.outputMode(mode).format("parquet").option("path", out)
         .option("checkpointLocation", check).trigger(availableNow=True).start())
    assert q.awaitTermination(180) and q.exception() is None
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def test_batch_reassembly(spark):
    c = _chunks(spark, split=SPLIT, stray=STRAY)
    pages = S.reassemble_batch(S.deduplicate(c.union(c)))
    assert {r.page_id: r.n_chunks for r in pages.collect()} == {0: len(SPLIT), 1: len(STRAY)}
    n = shred.shred(pages)
    assert body_inner(n) == ["<h2>Stock</h2><p>Seven bolts</p>", "<p>open <i>all</i><u>end</u></p>"]
    long = spark.range(5000).select(F.lit(7).cast("long").alias("page_id"), F.col("id").cast("int").alias("seq"), F.lit("chunk").alias("kind"),
                                    F.concat(F.col("id").cast("string"), F.lit(",")).alias("chunk"), F.current_timestamp().alias("ts"))
    assert S.reassemble_batch(long).first().html == "".join(f"{i}," for i in range(5000))


def test_protocol(spark):
    c = _chunks(spark, a=["x", "y"], b=["x", "y"], c=["x", "y"])
    assert S.chunk_protocol_errors(c).count() == 0
    broken = c.filter("not (page_id = 0 and seq = 0)").filter("not (page_id = 2 and seq = 1)").withColumn(
        "kind", F.when((F.col("page_id") == 1) & (F.col("seq") == 2), "begin").otherwise(F.col("kind")))
    got = sorted((r.page_id, r.seq, r.error) for r in S.chunk_protocol_errors(broken).collect())
    assert got == [(0, 1, "chunk before begin"), (0, 1, "missing seq"), (0, 2, "chunk before begin"), (0, 3, "end without begin"),
                   (1, 2, "begin twice"), (2, 2, "missing seq")]


def test_protocol_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 4)
    c = _chunks(spark, a=list("abcdefghijklmnop"), b=list("abcdefghijklmnop"))
    assert S.chunk_protocol_errors(c).count() == 0
    assert S.reassemble_batch(c).filter("html <> 'abcdefghijklmnop'").count() == 0
    gap = c.filter("not (page_id = 1 and seq between 3 and 9)")
    assert [(r.page_id, r.seq, r.error) for r in S.chunk_protocol_errors(gap).collect()] == [(1, 10, "missing seq")]


def test_session_reassembly(spark):
    c = _chunks(spark, split=SPLIT, stray=STRAY, late=["z"], lacking=["a", "b", "c"], paused=["a", "b", "c"], twice=["a"])
    c = c.filter("not (page_id = 3 and seq = 2)")
    c = c.withColumn("ts", F.when((F.col("page_id") == 4) & (F.col("seq") > 2), F.col("ts") + F.expr("interval 69 seconds")).otherwise(F.col("ts")))
    late = c.filter("page_id = 2").withColumn("ts", F.col("ts") + F.expr("interval 2 hours"))
    rows = c.filter("page_id <> 2").unionByName(c.filter("page_id = 5")).unionByName(late)
    got = sorted((r.page_id, r.html, r.n_chunks, r.error) for r in
                 _drain(S.reassemble(_stream(spark, rows, files=1), gap="30 seconds", watermark="1 minute")).collect() if r.page_id != 2)
    assert got[:2] == [(0, WHOLE, len(SPLIT), None), (1, TAIL, len(STRAY), None)]
    assert got[2] == (3, None, 2, "missing seq")
    assert sorted(g[2:] for g in got if g[0] == 4) == [(1, "no begin"), (2, "no end")]
    assert got[-1] == (5, "a", 1, None)


def test_eager_reassembly(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    c = _chunks(spark, split=SPLIT, stray=STRAY, again=["begin", "x"])
    c = c.withColumn("kind", F.when((F.col("page_id") == 2) & (F.col("seq") == 1), "begin").otherwise(F.col("kind")))
    got = {r.page_id: (r.html, r.error) for r in _drain(S.reassemble_eager(_stream(spark, c.union(c)), idle_ms=0)).collect()}
    assert got == {0: (WHOLE, None), 1: (TAIL, None), 2: ("x", "begin twice")}


def _arriving(spark, root, batches, run):
    """Run a stream once after each batch of (page_id, seq, kind, chunk, seconds); what each run adds."""
    seen, out = 0, []
    for rows in batches:
        frame = spark.createDataFrame(rows, "page_id long, seq int, kind string, chunk string, s long")
        frame.selectExpr("page_id", "seq", "kind", "chunk", "timestamp_seconds(1000000 + s) AS ts").coalesce(1).write.mode("append").parquet(f"{root}/in")
        schema = "page_id long, seq int, kind string, chunk string, ts timestamp"
        done = S.drain(run(spark.readStream.schema(schema).parquet(f"{root}/in")), root).collect()
        out.append(len(done) - seen)
        seen = len(done)
    return done, out


def test_abandoned_and_finished_pages_by_event_time(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    whole = [(1, 0, "begin", None, 0), (1, 1, "chunk", "a", 1), (1, 2, "end", None, 2)]
    batches = [
        [whole[0], whole[2], (2, 0, "begin", None, 0), (2, 1, "chunk", "x", 5)],
        [whole[1], whole[1], (2, 1, "chunk", "x", 5), (3, 1, "chunk", "late begin", 10)],
        [whole[1], (3, 0, "begin", None, 900), (9, 0, "begin", None, 1000)],                # 1 is out already; 2 is idle
        [(3, 2, "end", None, 1100), (9, 1, "end", None, 5000)]]
    done, added = _arriving(spark, _folder(), batches, lambda c: S.reassemble_eager(c, idle_ms=600_000, watermark="300 seconds"))
    got = {r.page_id: (r.html, r.n_rows, r.error) for r in done}
    assert got[1] == ("a", 3, None) and got[2] == (None, 2, "abandoned before end") and got[9] == ("", 2, None)
    assert got[3] == ("late begin", 3, None) or got[3][2] == "abandoned before end"
    assert len(done) == len(got) == 4 and added[:2] == [0, 1]


def test_late_and_repeated_rows_are_counted(spark):
    root = _folder()
    batches = [[(1, 0, "begin", None, 0), (1, 0, "begin", None, 0), (1, 1, "end", None, 0)], [(2, 0, "begin", None, 100_000)],
               [(1, 5, "chunk", "too late", 0), (2, 0, "begin", None, 100_000), (2, 1, "end", None, 100_000)]]
    done, added = _arriving(spark, root, batches, S.deduplicate)
    assert added == [2, 1, 1] and sorted((r.page_id, r.seq) for r in done) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    total = S.drain_counts(spark, root).groupBy().sum("n_input", "n_late", "n_repeated").first()
    assert tuple(total) == (7, 1, 2)


def test_a_batch_that_runs_again_replaces_its_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = _folder()
    for _ in range(2):
        run = S.page_sink(_stream(spark, pages), serialize.to_html, out)
        run.option("checkpointLocation", _folder()).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 50


def test_stream_operators_match_batch(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    same = lambda a, b: a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    clean = _drain(S.stream_normalize(_stream(spark, pages), remove_comments=True))
    assert same(clean, S.stream_normalize(pages, remove_comments=True).select(*clean.columns))
    cols = ["page_id", "pre", "last", "tag", "text"]
    assert same(_drain(S.stream_shred(_stream(spark, pages)).select(*cols)), shred.shred(pages).select(*cols))
    tok = ["page_id", "pos", "kind", "raw"]
    assert same(_drain(S.stream_tokenize(_stream(spark, pages)).select(*tok)), S.stream_tokenize(pages).select(*tok))
    snippets = pages.select("page_id", F.concat(F.lit("<p onclick=x>"), "url", F.lit("<script>1</script>")).alias("html"))
    assert same(_drain(S.stream_sanitize(_stream(spark, snippets))), S.stream_sanitize(snippets))
    filled = lambda d: S.stream_interpolate(d, "<a href={url}>", F.create_map(F.lit("url"), F.col("url"))).select("page_id", "html")
    assert same(_drain(filled(_stream(spark, pages))), filled(pages))


def test_page_sink(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = _folder()
    run = S.page_sink(_stream(spark, pages), lambda n: serialize.to_html(sanitize.sanitize(n, "strict", reindex=False)),
                      lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
    q = run.option("checkpointLocation", _folder()).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None
    want = serialize.to_html(sanitize.sanitize(shred.shred(pages), "strict", reindex=False))
    got = spark.read.parquet(out).select("page_id", "html")
    assert got.count() == 50 and got.exceptAll(want).count() == 0


def test_sources(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    root = _folder()
    for fmt in ("parquet", "orc", "json"):
        pages.write.format(fmt).save(f"{root}/{fmt}")
        assert P.read_pages(spark, f"{root}/{fmt}", fmt).exceptAll(pages).count() == 0
    for i in range(3):
        with open(f"{root}/{i}.html", "w", encoding="utf-8") as f:
            f.write(f"<p>é{i}\n</p>")
    for fmt in ("text", "binaryFile"):
        got = P.read_pages(spark, f"{root}/*.html", fmt)
        assert sorted(r.html for r in got.collect()) == [f"<p>é{i}\n</p>" for i in range(3)]
        assert got.select("page_id").distinct().count() == 3
    with pytest.raises(ValueError):
        P.read_pages(spark, root, "xml")
    n = shred.shred(pages)
    P.write_pages(n, f"{root}/out")
    assert spark.read.parquet(f"{root}/out").where("error is null").count() == 50
    pages.write.option("header", True).option("escape", '"').csv(f"{root}/csv")
    assert P.read_pages(spark, f"{root}/csv", "csv").exceptAll(pages).count() == 0
    odd = spark.createDataFrame([(1, "<p>a"), (2, None), (3, "")], "page_id long, html string")
    P.write_pages(shred.shred(odd), f"{root}/odd", pages=odd)
    got = {r.page_id: (r.html, r.error) for r in spark.read.parquet(f"{root}/odd").collect()}
    assert got == {1: ("<html><head></head><body><p>a</p></body></html>", None), 2: (None, "page is null"),
                   3: ("<html><head></head><body></body></html>", None)}


def test_one_line_csv_and_checked_keys(spark):
    root = _folder()
    htmls = ["a\nb\r\n", "\\n \\\\ \\", "", None, "\\N", '"q", ,\'', "\\\\n\n\\r", "é \u0085"]
    pages = spark.createDataFrame([(i, f"u\n{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    pages.select("page_id", P.escaped("url").alias("url"), P.escaped("html").alias("html")).coalesce(1).write.options(**P.CSV).csv(f"{root}/csv")
    back = P.read_pages(spark, f"{root}/csv", "csv_lines")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pages.collect()), key=lambda r: r[0])
    lines = spark.read.text(f"{root}/csv").count()
    assert lines == len(htmls) + 1                                       # a header, then a line a page
    P.write_pages(shred.shred(pages), f"{root}/out", "csv_lines")
    assert P.read_pages(spark, f"{root}/out", "csv_lines").count() == len(htmls)
    twice = pages.unionByName(pages.where("page_id < 2")).unionByName(pages.selectExpr("CAST(NULL AS LONG) AS page_id", "url", "html").limit(2))
    got = P.checked(twice).collect()
    assert len(got) == len(htmls) + 4
    assert sorted((r.page_id, r.error) for r in got if r.error and r.page_id is not None) == [(0, "page_id repeats")] * 2 + [(1, "page_id repeats")] * 2
    assert all(r.html is None for r in got if r.error) and sum(r.error == "page_id is null" for r in got) == 2
    assert P.read_pages(spark, f"{root}/csv", "csv_lines", check=True).where("error IS NOT NULL").count() == 0


def test_shared_folder(spark):
    from pageframe.session import shared_folder
    assert shared_folder(spark) == shared_folder(spark)


def test_operators_leave_the_session_alone(spark):
    from pageframe.session import DEFAULTS, tune
    before = {k: spark.conf.get(k) for k in DEFAULTS}
    shred.shred(spark.createDataFrame([(1, "<p>a")], "page_id long, html string")).count()
    assert {k: spark.conf.get(k) for k in DEFAULTS} == before
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "37")
    try:
        tune(spark)
        assert spark.conf.get(key) == "37"
    finally:
        spark.conf.set(key, before[key])


def test_bucketed_nodes_need_no_shuffle(spark):
    n = shred.shred(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    P.write_nodes(n, "nodes_t", 4, path=_folder() + "/nodes_t")
    stored = P.read_nodes(spark, "nodes_t")
    assert stored.exceptAll(n).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from pageframe.operators import axes, select
        for df in (select.select_all(stored, "nav > ul > li ~ li a"), serialize.to_html(stored),
                   sanitize.sanitize(stored, "strict"), normalize.normalize_dom(stored), axes.parent(stored, stored.filter("tag = 'a'"))):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan.replace("ReusedExchange", ""), plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_table_as_stream(spark):
    from pageframe.plans import varied
    html = [WHOLE, TAIL, "<ul><li>a<li>b</ul>", "<ul></ul>"]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    many, single = _folder(), _folder()
    pages.repartition(3).write.parquet(f"{many}/pages.parquet")
    pages.toPandas().to_parquet(f"{single}/pages.parquet")
    for folder in (many, single):     # a folder of files, and one file
        assert _drain(P.stream_table(spark, f"{folder}/pages.parquet")).count() == 4
        assert sorted(map(tuple, varied.sink_replayed(spark, folder).collect())) == [(0, 1, 0), (1, 1, 0), (2, 1, 2), (3, 1, 0)]
