from __future__ import annotations

import gzip
import os
import tempfile

import pytest
from brute import page_report

from pageframe.llm import warc
from pageframe.llm.queries import QUERIES
from pyspark.sql import functions as F

PAGES = [(1, "http://a.example/1", "<p>one</p>"), (2, "http://a.example/2", "<p>two é \U0001f600</p>"), (3, None, "<p>one</p>"),
         (9, "http://b.example/\r\nWARC-Type: fake", "x" * 3_000_000), (4, "", None), (5, "u", ""), (None, "n", "<p>one</p>"), (None, "n", "alone"),
         (None, None, None), (7, "t", "WARC/1.1\r\nWARC-Type: response\r\n\r\nnot a record\r\n\r\n"), (7, "t", "other"), (1, "again", "<p>one</p>"),
         (-8, "neg", "<p>two é \U0001f600</p>")]


def folder():
    return tempfile.mkdtemp(prefix="warc-", dir="/tmp")


def table(spark, pages):
    return spark.createDataFrame([(*p, "x", "y", 1) for p in pages], "page_id long, url string, html string, record_type string, digest string, raw int").repartition(3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"split_bytes": 300, "file_bytes": 2000}, {"compression": "none", "split_bytes": 1}])
def test_pages_come_back(spark, options):
    path = folder()
    warc.write(warc.page_records(table(spark, PAGES)), path, **options)
    records = warc.read(spark, path)
    assert rows(warc.page_report(records, warc.read(spark, path, payload=False))) == page_report([(p, h) for p, _, h in PAGES])
    bodies = {(r.record_id, bytes(r.payload)) for r in records.where("record_type = 'response'").collect()}
    assert (warc.page_name(F.lit(9)) is not None) and ("<urn:x-page:7>", PAGES[9][2].encode()) in bodies
    if "split_bytes" in options:
        assert records.rdd.getNumPartitions() > 3
    assert records.where("payload IS NOT NULL AND record_type = 'revisit'").count() == 0


def test_least_payload_and_empty_table(spark):
    path = folder()
    warc.write(warc.page_records(table(spark, PAGES), least=5), path)
    assert rows(warc.page_report(warc.read(spark, path), warc.read(spark, path, False))) == page_report([(p, h) for p, _, h in PAGES], 5)
    nothing = folder()
    warc.write(warc.page_records(table(spark, PAGES).limit(0)), nothing)
    assert warc.read(spark, nothing).count() == 0


def test_modes(spark):
    path, part = folder(), warc.page_records(table(spark, PAGES[:2]))
    warc.write(part, path)
    warc.write(part, path)
    assert warc.read(spark, path).count() == 4
    warc.write(part, path, mode="overwrite")
    assert warc.read(spark, path).count() == 2
    open(f"{path}/part-of-a-lost-task.warc.gz", "wb").write(b"rubbish")     # not in a commit
    assert warc.read(spark, path).count() == 2


PREDICATES = ["record_type = 'revisit'", "record_type IN ('revisit', 'warcinfo')", "target_uri LIKE 'http://a%'", "target_uri IS NULL", "NOT target_uri = 'u'",
              "refers_to <=> '<urn:x-page:1>'", "block_bytes > 90 AND target_uri >= 'n'", "target_uri LIKE '%example%' OR record_type = 'revisit'",
              "payload_digest = '3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ'", "payload_bytes > 11", "NOT (target_uri IS NULL)", "record_id != '<urn:x-page:1>'"]


@pytest.mark.parametrize("predicate", PREDICATES)
def test_pushed_predicates_change_nothing(spark, predicate):
    path = folder()
    warc.write(warc.page_records(table(spark, PAGES)), path)
    stored = warc.read(spark, path).drop("headers")
    copy = folder() + "/t"
    stored.write.parquet(copy)
    assert rows(stored.where(predicate).drop("file")) == rows(spark.read.parquet(copy).where(predicate).drop("file"))


def test_unwanted_blocks_are_not_inflated(spark):
    """A response whose compressed block is damaged does no harm to a search for revisits."""
    path = folder()
    big = os.urandom(400_000).hex()
    warc.write(warc.page_records(table(spark, [(1, "a", big), (2, "b", big), (3, "c", "<p>")]).coalesce(1)), path)
    name = next(f for f in os.listdir(path) if f.endswith(".gz"))
    raw = bytearray(open(f"{path}/{name}", "rb").read())
    raw[300_000:300_100] = b"\xff" * 100
    open(f"{path}/{name}", "wb").write(raw)
    assert [r.record_id for r in warc.read(spark, path).where("record_type = 'revisit'").collect()] == ["<urn:x-page:2>"]
    assert "Filter" not in warc.read(spark, path).where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString().split("record_type#")[0]
    assert warc.read(spark, path, payload=False).count() == 3


def test_archives_of_other_writers(spark):
    """Plain, gzipped by record without lengths, and gzipped as a whole; other record types and folded headers."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:i>\r\nX-Note: folded\r\n  line\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    one = warc.record({"record_type": "response", "record_id": "<urn:1>", "payload": "first \r\n\r\n page" * 9000})
    two = warc.record({"record_type": "resource", "record_id": "<urn:2>", "payload": b"\xff\x00"}).replace(b"application/http; msgtype=response", b"image/x")
    whole = info + one + two
    for name, raw in (("a.warc", whole), ("b.warc.gz", b"".join(map(gzip.compress, (info, one, two)))), ("c.warc.gz", gzip.compress(whole)),
                      ("d.warc.gz", gzip.compress(whole[:70_000]) + gzip.compress(whole[70_000:]))):
        path = folder()
        open(f"{path}/{name}", "wb").write(raw)
        got = {r.record_id: r for r in warc.read(spark, path).collect()}
        assert list(got) == ["<urn:i>", "<urn:1>", "<urn:2>"]
        assert got["<urn:1>"].payload == b"first \r\n\r\n page" * 9000 and got["<urn:1>"].http_status == 200
        assert got["<urn:i>"].payload == b"hello" and got["<urn:i>"].headers["x-note"] == "folded line"
        assert [r.record_id for r in warc.read(spark, path).where("record_type = 'resource'").collect()] == ["<urn:2>"]


def test_query(spark):
    data = "/root/testdata/sf0.001"
    pages = [tuple(r) for r in spark.read.parquet(f"{data}/pages.parquet").select("page_id", "html").collect()]
    assert rows(QUERIES["op11_warc_source"](spark, data)) == page_report(pages)
