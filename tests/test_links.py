from __future__ import annotations

import random
from urllib.parse import urljoin

from helpers import nodes, table
from pageframe.operators import links, shred
from pyspark.sql import functions as F

def test_links_resolve_as_the_standard_library_does(spark):
    rng = random.Random(6)
    path = lambda: "/".join(rng.choice([".", "..", "a", "b.c", "...", "x y", "é"]) for _ in range(rng.randint(1, 6)))
    rows = [(f"http://www.example/{path()}?z#y", rng.choice(["", "/"]) + path() + rng.choice(["", "/", "?q=1", "#f", "?a=../b#c/.."])) for _ in range(800)]
    got = spark.createDataFrame(rows, "base string, href string").select("*", links.resolve(F.col("href"), F.col("base")).alias("t")).collect()
    assert [r.t for r in got] == [urljoin(r.base, r.href) for r in got]
    other = spark.createDataFrame([("//h.example/a/./../b/..?x", "http://h.example/?x"), ("//h.example", "http://h.example")], "href string, want string")
    assert other.where(links.resolve(F.col("href"), F.lit("http://www.example/q")) != F.col("want")).count() == 0


def test_empty_links_and_bases(spark):
    pages = spark.createDataFrame([
        (1, "http://h/a/b?c#d", "<a href=''>x</a><a href=?>y</a><a>z</a>"), (2, "http://h", "<a href=x>x</a><a href='#t'>t</a>"),
        (3, "http://h/p/", "<base><base href='q/'><template><base href=no><a href=in></a></template><a href=../x>x</a>"),
        (4, None, "<a href=x>x</a><a href='http://o/'>o</a>"), (5, "http://h/", None)], "page_id long, url string, html string")
    want = {(1, "", "http://h/a/b?c"), (1, "?", "http://h/a/b?"), (2, "x", "http://h/x"), (2, "#t", "http://h#t"), (3, "../x", "http://h/p/x"),
            (4, "x", None), (4, "http://o/", "http://o/")}
    carried = links.links(shred.shred(pages, carry=["url"]))
    joined = links.links(shred.shred(pages), pages, text=False)
    assert {(r.page_id, r.href, r.target) for r in carried.collect()} == want == {(r.page_id, r.href, r.target) for r in joined.collect()}


def test_links_without_addresses(spark):
    found = links.links(nodes(spark, "<p><a href=x>one <b>two</b></a>")).collect()
    assert [(r.href, r.link_text) for r in found] == [("x", "one two")]
    assert links.links(shred.shred(table(spark, []))).count() == 0
