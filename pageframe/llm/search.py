"""Ranked lexical search the other way round: the items are indexed, the documents stream past the index.

An inverted index over the terms of a block of items is broadcast.  Every task counts the terms of its documents, adds
up the scores of the items they share terms with and keeps the best documents of each item in a bounded heap; the
heaps of all tasks are merged by item.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from pageframe.llm.common import block_numbers, saved

TOP = 20
BLOCK_TERMS = 500_000     # postings of one broadcast index, or those of a single larger item
MERGES = 64               # heaps of so many groups of tasks are merged before those of an item
_CHUNK = 4 << 20
_CELLS = 1 << 20          # scores (document, item) that a task holds at a time
_LOWER = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_counts(raw: bytes, known=None) -> tuple:
    """Number of terms of a text in UTF-8 and how often each occurs (of the `known` ones, if given); long texts go in chunks."""
    n, counts, at = 0, Counter(), 0
    while at < len(raw):
        end = at + _CHUNK
        while end < len(raw) and _LOWER[raw[end]] != 32:
            end += 1
        terms = raw[at:end].translate(_LOWER).split(b" ")
        terms = [t for t in terms if t]
        n, at = n + len(terms), end
        counts.update(terms if known is None else filter(known.__contains__, terms))
    return n, counts


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term, often): the distinct terms of each row of items; rows are numbered, terms are bytes."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = pa.schema([("item", pa.int64()), batch.schema.field("item_id"), ("term", pa.binary()), ("often", pa.int64())])
            for item, item_id, text in zip(*[batch.column(c).to_pylist() for c in ("item", "item_id", "raw")]):
                counts = term_counts(text or b"")[1]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                    ([item] * len(counts), [item_id] * len(counts), list(counts), list(counts.values())), made)], schema=made)

    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("binary").alias("raw"))
    return numbered.mapInArrow(run, f"item long, item_id {kind}, term binary, often long")


def blocks(terms: DataFrame, most: int) -> tuple[DataFrame, list]:
    """item_terms with a block number, and those numbers; a block ends with the item that fills it."""
    placed = saved(block_numbers(terms.groupBy("item").agg(F.count("*").alias("size")), "item", most), "item-blocks")
    return saved(terms.join(placed, "item"), "item-terms"), [r["block"] for r in placed.select("block").distinct().orderBy("block").collect()]


class Index:
    """Postings of a block of items by term: starts[t] to starts[t + 1] are the owners of term t and their weights."""

    def __init__(self, postings: list, frequency: dict, documents: int, terms: int):
        import numpy as np

        ordered = sorted(postings, key=lambda p: p["term"])
        names = sorted({p["term"] for p in ordered})
        self.documents, self.terms = documents, terms
        self.number = {term: i for i, term in enumerate(names)}
        self.items = sorted({(p["item"], p["item_id"]) for p in ordered}, key=lambda i: i[0])
        place = {item: i for i, (item, _) in enumerate(self.items)}
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(t, 0) + 1))) if documents else 0 for t in names]
        lengths = Counter(p["term"] for p in ordered)
        self.starts = np.concatenate([[0], np.cumsum([lengths[t] for t in names])]).astype(np.int64)
        self.owners = np.array([place[p["item"]] for p in ordered], dtype=np.int64)
        self.weights = np.array([weight[self.number[p["term"]]] * p["often"] for p in ordered], dtype=np.int64)

    def gains(self, n: int, counts: Counter):
        """Term numbers of a document of n terms and what each is worth there."""
        import numpy as np

        m = 75 + 25 * n * self.documents // self.terms
        often = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
        return np.array([self.number[t] for t in counts], dtype=np.int64), 1_000_000_000 * often // (1000 * often + 12 * m)

    def scores(self, found: list):
        """Scores of some documents, each given by its gains, for all items of the block."""
        import numpy as np

        terms, gains = np.concatenate([t for t, _ in found]), np.concatenate([g for _, g in found])
        rows = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
        lengths = self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(self.starts[terms] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        out = np.zeros(len(found) * len(self.items), dtype=np.int64)
        np.add.at(out, np.repeat(rows * len(self.items), lengths) + self.owners[at], np.repeat(gains, lengths) * self.weights[at])
        return out.reshape(len(found), len(self.items))


class Heaps:
    """The best documents of each item: highest score, then smallest doc_id, those without one last."""

    LAST = (1 << 63) - 1

    def __init__(self, items: int, top: int):
        import numpy as np

        self.top, self.kept = top, [[] for _ in range(items)]
        self.floor, self.limit = np.ones(items, dtype=np.int64), np.full(items, self.LAST)   # a score and a doc_id that still get in

    def update(self, ids: list, scores) -> None:
        import numpy as np

        order = np.array([self.LAST if i is None else i for i in ids], dtype=np.int64)[:, None]
        for row, item in np.argwhere((scores > self.floor) | ((scores == self.floor) & (order <= self.limit))):
            heap, doc = self.kept[item], ids[row]
            entry = (int(scores[row, item]), doc is not None, 0 if doc is None else -doc)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            else:
                continue
            if len(heap) == self.top:
                self.floor[item], self.limit[item] = heap[0][0], self.LAST if not heap[0][1] else -heap[0][2]


def _statistics(docs: DataFrame, shared) -> dict:
    """How many documents hold each of the shared terms; under None the documents with terms and their terms."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        number = {t: i for i, t in enumerate(shared.value)}
        holding, documents, terms = np.zeros(len(number), dtype=np.int64), 0, 0
        for batch in batches:
            for raw in batch.column("raw").to_pylist():
                n, counts = term_counts(raw or b"", number)
                documents, terms = documents + (n > 0), terms + n
                holding[[number[t] for t in counts]] += 1
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_pydict({"place": np.concatenate([[-1, -2], some]), "n": np.concatenate([[documents, terms], holding[some]])})

    counted = docs.select(F.col("text").cast("binary").alias("raw")).mapInArrow(run, "place long, n long")
    return {r["place"]: r["n"] for r in counted.groupBy("place").agg(F.sum("n").alias("n")).collect()}


def _best(docs: DataFrame, shared, top: int, kind: str) -> DataFrame:
    """(item, item_id, doc_id, score): the bounded heaps of every task."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index = shared.value
        heaps = Heaps(len(index.items), top)
        room = max(1, _CELLS // len(index.items))
        ids, found, postings = [], [], 0

        def flush():
            if found:
                heaps.update(ids, index.scores(found))

        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist()):
                n, counts = term_counts(raw or b"", index.number)
                if not counts:
                    continue
                terms, gains = index.gains(n, counts)
                ids.append(doc)
                found.append((terms, gains))
                postings += int((index.starts[terms + 1] - index.starts[terms]).sum())
                if len(found) == room or postings > _CELLS:
                    flush()
                    ids, found, postings = [], [], 0
        flush()
        out = [(item, item_id, None if not named else -doc, score) for (item, item_id), heap in zip(index.items, heaps.kept) for score, named, doc in heap]
        for at in range(0, len(out), 100_000):
            part = list(zip(*out[at:at + 100_000]))
            yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int64()), pa.array(part[1]), pa.array(part[2], pa.int64()), pa.array(part[3], pa.int64())],
                                             names=["item", "item_id", "doc_id", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw"))
    return source.mapInArrow(run, f"item long, item_id {kind}, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents (doc_id, text) of each row of items (item_id, text).

    A document's score sums over the item's terms, repeats included, the weight of the term times its worth in the
    document, all in whole numbers.  Equal scores rank by doc_id, those without one last.  Documents with score 0 have
    no rank.  Null and empty texts have no terms; rows that repeat are documents or items of their own, so a repeated
    item has its ranks twice.  No items, or no documents with terms: no rows.  Other columns are not read.

    Items go in blocks of at most `block_terms` postings (or one larger item): one block's index is on the driver and
    broadcast at a time, and dropped before the next; a block reads the documents twice, for the frequencies of its
    terms and for the scores.
    """
    context = docs.sparkSession.sparkContext
    kind = items.schema["item_id"].dataType.simpleString()
    terms, numbers = blocks(item_terms(items), block_terms)
    done = []
    for block in numbers:
        postings = terms.where(F.col("block") == block).select("item", "item_id", "term", "often").collect()
        names = sorted({bytes(p["term"]) for p in postings})
        shared = context.broadcast(names)
        counts = _statistics(docs, shared)
        shared.destroy()
        frequency = {names[place]: held for place, held in counts.items() if place >= 0}
        index = Index([{**p.asDict(), "term": bytes(p["term"])} for p in postings], frequency, counts.get(-1, 0), counts.get(-2, 0))
        if not index.documents:
            break
        shared = context.broadcast(index)
        done.append(saved(merged(_best(docs, shared, top, kind), top), "ranked"))
        shared.destroy()
    if not done:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def merged(heaps: DataFrame, top: int) -> DataFrame:
    """Heaps of tasks to ranks: those of MERGES groups of tasks first, then those of an item."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = heaps.withColumn("group", F.spark_partition_id() % MERGES)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "group").orderBy(*order))).where(F.col("rank") <= top)
    ranks = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranks.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
