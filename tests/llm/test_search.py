from __future__ import annotations

import random

import pytest
from brute import ranking
from cases import documents, empty, prose, rows

from pageframe.llm import search
from pageframe.llm.queries import QUERIES

ITEMS = [(1, "amber brook cedar"), (2, "amber amber NORTH north"), (3, ""), (4, None), (5, "word été straße"), (None, "pine oak willow"), (2, "amber amber NORTH north"),
         (9, "nothingofthiskind"), (7, "mail.example_com [x] 1984 {ANNA}")]


def items(spark, some=ITEMS):
    return spark.createDataFrame([(*i, 1, 2, "r") for i in some], "item_id long, text string, item long, block int, rank string").repartition(3)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_terms", [search.BLOCK_TERMS, 4, 1])
def test_ranks_match_brute_force(spark, block_terms):
    docs = [r[:2] for r in rows()]
    assert found(search.ranked(documents(spark), items(spark), block_terms=block_terms)) == ranking(docs, ITEMS)


def test_ties_and_copies(spark):
    """A third of all documents are equal: the smallest ids win, ids that repeat come twice, those without one last."""
    docs = [(i, "amber brook") for i in range(400, 0, -1)] + [(5, "amber brook"), (None, "amber brook")] + [(1000 + i, prose(random.Random(i), 20, ["pine", "oak", "vale"])) for i in range(300)]
    table = [(*d, "en", "s", 1) for d in docs]
    got = found(search.ranked(documents(spark, table), items(spark), top=7))
    assert got == ranking(docs, ITEMS, 7)
    assert [doc for item, rank, doc, _ in sorted(g for g in got if g[0] == 1)] == [1, 2, 3, 4, 5, 5, 6]


def test_small_groups_of_documents(spark, monkeypatch):
    monkeypatch.setattr(search, "_CELLS", 20)
    monkeypatch.setattr(search, "_CHUNK", 64)
    docs = [r[:2] for r in rows()]
    assert found(search.ranked(documents(spark), items(spark), top=3)) == ranking(docs, ITEMS, 3)


def test_empty_tables(spark):
    assert found(search.ranked(empty(spark), items(spark))) == []
    assert found(search.ranked(documents(spark), items(spark, []))) == []
    assert found(search.ranked(documents(spark), items(spark, [(1, ""), (2, None)]))) == []


def test_very_long_text(spark):
    docs = [(1, "amber " * 1_500_000), (2, "x" * 5_000_000), (3, "brook")]
    assert found(search.ranked(documents(spark, [(*d, "en", "s", 1) for d in docs]), items(spark))) == ranking(docs, ITEMS)


def test_query(spark):
    data = "/root/testdata/sf0.001"
    docs, given = ([tuple(r) for r in spark.read.parquet(f"{data}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert found(QUERIES["op12_reversed_search"](spark, data)) == ranking(docs, given)
