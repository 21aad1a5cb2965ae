"""Benchmark decontamination with suffix arrays over shards of the training texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pageframe.llm.common import block_numbers, saved

WINDOW = 10
BLOCK_BYTES = 4 << 20     # benchmark text in one table, or a single longer text
PASS_BYTES = 32 << 20     # benchmark text whose tables the tasks hold at once; more is searched in passes
SHARD_BYTES = 16 << 20    # training text under one suffix array
UNNAMED = (1 << 63) - 1   # stands for a null item id: it comes last and is in no list of items

BEST = ("words", "item", "diagonal", "first")
SCHEMA = "n_words long, n_hit long, items array<long>, longest long, longest_item long, longest_start long"


def _words(raw: bytes) -> list:
    """A-Z lower-cased; maximal runs without ASCII characters other than digits and letters."""
    keep = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
    return raw.translate(keep).lower().split()


class Suffixes:
    """The suffixes of a block of benchmark texts: windows to look up in a shard's suffix array, and a suffix array of
    their own that gives the longest match at a place of a document.

    A window is `size` consecutive words of a text, or the whole of a shorter one.  Equal windows are one entry with
    the set of the items that hold it; equal sets are one.  `texts` are (ascending item ids, words).
    """

    def __init__(self, texts: list, size: int = WINDOW):
        import numpy as np

        self.size, self.number, holders = size, {}, {}
        number, streams, begins, at = self.number, [], [], 0
        for text, (_, words) in enumerate(texts):
            numbers = [number.setdefault(w, len(number) + 1) for w in words]
            for k in range(max(1, len(numbers) - size + 1)):
                held = holders.setdefault(tuple(numbers[k:k + size]), [])
                if not held or held[-1] != text:
                    held.append(text)
            begins.append(at)
            streams.append(np.array([*numbers, 0], dtype=np.int64))       # 0 ends a text
            at += len(numbers) + 1
        self.bits = 21 if len(number) < (1 << 21) - 1 else 31
        windows = list(holders)
        self.length = np.array([len(w) for w in windows], dtype=np.int64)
        sets = {}
        self.set_of = np.array([sets.setdefault(tuple(h), len(sets)) for h in holders.values()], dtype=np.int64)
        ids = [sorted({i for t in h for i in texts[t][0]}) for h in sets]
        self.items = [np.array([i for i in some if i != UNNAMED], dtype=np.int64) for some in ids]
        self.first_item = np.array([some[0] for some in ids], dtype=np.int64)
        self.low, self.high = self._bounds(windows, 0), self._bounds(windows, (1 << self.bits) - 1)
        self.single = np.zeros(len(number) + 1, dtype=bool)
        self.single[[w[0] for w in windows if len(w) == 1]] = True
        self.pairs = np.unique(np.array([w[0] << self.bits | w[1] for w in windows if len(w) > 1], dtype=np.int64))

        stream = np.concatenate(streams) if streams else np.zeros(1, dtype=np.int64)
        self.longest = max((len(w) for _, w in texts), default=0)
        self.array = _suffix_array(stream, self.longest)
        self.bytes = stream.astype(">u4").tobytes()
        of = np.repeat(np.arange(len(streams)), [len(x) for x in streams]) if streams else np.zeros(1, dtype=np.int64)
        self.item = np.array([texts[t][0][0] for t in range(len(texts))] or [UNNAMED], dtype=np.int64)[of]
        self.at = np.arange(len(stream)) - np.array(begins or [0], dtype=np.int64)[of]

    def _bounds(self, windows: list, fill: int):
        import numpy as np

        padded = np.full((len(windows), self.size), fill, dtype=np.int64)
        for row, window in zip(padded, windows):
            row[:len(window)] = window
        return sort_keys([padded[:, k] for k in range(self.size)], self.bits)

    def _place(self, pattern: bytes, after: bool = False) -> int:
        """Number of suffixes that sort before the pattern (or before what follows all that start with it)."""
        low, high, array, raw, n = 0, len(self.array), self.array, self.bytes, len(pattern)
        while low < high:
            middle = (low + high) // 2
            start = 4 * int(array[middle])
            found = raw[start:start + n]
            if found < pattern or after and found == pattern:
                low = middle + 1
            else:
                high = middle
        return low

    def match(self, words, least: int) -> tuple | None:
        """(words, item, place in its text) of the longest match of a text's beginning, if it has `least` words: by the
        neighbours in the array, then the smallest item and its last place among all suffixes that share the match."""
        import numpy as np

        pattern = words[:self.longest].astype(">u4").tobytes()
        at, best = self._place(pattern), 0
        for near in (at - 1, at):
            if 0 <= near < len(self.array):
                start = 4 * int(self.array[near])
                other = np.frombuffer(self.bytes[start:start + len(pattern)], dtype=">u4")
                differ = np.flatnonzero(other != np.frombuffer(pattern, dtype=">u4")[:len(other)])
                best = max(best, int(differ[0]) if len(differ) else len(other))
        if best < least:
            return None
        shared = pattern[:4 * best]
        held = self.array[self._place(shared):self._place(shared, after=True)]
        item = self.item[held].min()
        return best, int(item), int(self.at[held][self.item[held] == item].max())


def _suffix_array(stream, longest: int):
    """The places of a word sequence in the order of what follows, told apart by `longest` words at least."""
    import numpy as np

    rank, order, step = np.unique(stream, return_inverse=True)[1].astype(np.int64), np.argsort(stream, kind="stable"), 1
    while step <= longest and len(stream) > 1:
        after = np.zeros(len(stream), dtype=np.int64)
        after[:-step] = rank[step:] + 1 if step < len(stream) else 0
        key = rank * (len(stream) + 2) + after
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(len(stream), dtype=np.int64)
        rank[order] = fresh
        if fresh[-1] == len(stream) - 1:
            break
        step *= 2
    return order


def sort_keys(columns: list, bits: int):
    """Word numbers, one array per word, as byte strings in the same order."""
    import numpy as np

    packed, each = [], 63 // bits
    for k in range(0, len(columns), each):
        part = np.zeros(len(columns[k]), dtype=np.int64)
        for column in columns[k:k + each]:
            part = part << bits | column
        packed.append(part)
    return np.stack(packed, axis=1).astype(">u8").view(f"S{8 * len(packed)}").ravel()   # big-endian: bytes sort as words


def occurrences(parts: list, n: int, suffixes: Suffixes) -> tuple:
    """Every occurrence of a window in a shard: its place and the window; and the shard's words as numbers.

    `parts` holds the words of each text.  The suffix array has every training suffix that starts like
    some window (others can't match any), sorted by its next `size` words; each window is one binary
    search at either end of its range.  A place has one occurrence for each length of window at most.
    """
    import itertools

    import numpy as np

    get, size, end = suffixes.number.get, suffixes.size, np.zeros(1, dtype=np.int64)
    ids = []
    for words in parts:
        ids.append(np.fromiter(map(get, words, itertools.repeat(0)), dtype=np.int64, count=len(words)))
        ids.append(end)                                    # a text's end, equal to no word
    ids = np.concatenate([*ids, np.zeros(size, dtype=np.int64)])
    at = np.flatnonzero(ids[:n])
    if len(suffixes.pairs):
        pair = ids[at] << suffixes.bits | ids[at + 1]
        near = np.minimum(np.searchsorted(suffixes.pairs, pair), len(suffixes.pairs) - 1)
        fits = suffixes.pairs[near] == pair
    else:
        fits = np.zeros(len(at), dtype=bool)
    at = at[fits | suffixes.single[ids[at]]]
    keys = sort_keys([ids[at + k] for k in range(size)], suffixes.bits)
    order = np.argsort(keys, kind="stable")
    array, keys = at[order], keys[order]                   # the shard's suffix array
    low = np.searchsorted(keys, suffixes.low, side="left")
    hits = np.searchsorted(keys, suffixes.high, side="right") - low
    window = np.repeat(np.arange(len(hits)), hits)
    where = array[np.arange(len(window)) - np.repeat(np.cumsum(hits) - hits, hits) + np.repeat(low, hits)]
    return where, window, ids


def _longest(where, window, ids, doc, start, suffixes: Suffixes, best: list) -> None:
    """Lower `best` (a key per text: -words, item, diagonal, first) to the longest matches with the block's texts.

    A match of a window's length or more lies in a run of places that all have whole windows; one search of the block's
    array a place gives its longest match, and no place is searched whose run ends before it could do better.  Texts
    shorter than a window match as wholes.
    """
    import numpy as np

    whole = suffixes.length[window] == suffixes.size
    places = np.unique(where[whole])
    of = np.searchsorted(start, places, side="right") - 1
    breaks = np.flatnonzero(np.concatenate([[True], (np.diff(places) != 1) | (np.diff(of) != 0)])) if len(places) else []
    for k, low in enumerate(breaks):
        last = int(places[(breaks[k + 1] if k + 1 < len(breaks) else len(places)) - 1]) + suffixes.size
        d = int(of[low])
        for p in range(int(places[low]), last - suffixes.size + 1):
            least = max(suffixes.size, -best[d][0])
            if last - p < least:
                break
            found = suffixes.match(ids[p:last], least)
            if found:
                first = p - int(start[d])
                best[d] = min(best[d], (-found[0], found[1], first - found[2], first))
    short = np.flatnonzero(~whole)
    for k in short.tolist():
        d, first = int(doc[k]), int(where[k] - start[doc[k]])
        best[d] = min(best[d], (-int(suffixes.length[window[k]]), int(suffixes.first_item[suffixes.set_of[window[k]]]), first, first))


def search_shard(texts: list, tables: list, earlier: tuple = None, last: bool = True) -> dict:
    """Per text: its words, the words inside occurrences of windows, the items hit and the longest verbatim match.

    Before the `last` pass: per text the stretches of hit words so far, the items hit and the best match, to be handed
    to the next pass as `earlier`.
    """
    import numpy as np

    parts = [_words(raw) if raw else [] for raw in texts]
    count = [len(p) for p in parts]
    start = np.concatenate([[0], np.cumsum(np.array(count, dtype=np.int64) + 1)])
    n = int(start[-1])
    cover, items, best = np.zeros(n + 1, dtype=np.int64), [set() for _ in texts], [(0, UNNAMED, 0, 0)] * len(texts)
    if earlier:
        of, begin, end = earlier[0]
        np.add.at(cover, start[of] + begin, 1)
        np.add.at(cover, start[of] + end, -1)
        for known, more in zip(items, earlier[1]):
            known.update(more)
        best = [tuple(b) for b in earlier[2]]
    for table in tables:
        where, window, ids = occurrences(parts, n, table)
        doc = np.searchsorted(start, where, side="right") - 1
        np.add.at(cover, where, 1)
        np.add.at(cover, where + table.length[window], -1)
        for d, s in np.unique(np.stack([doc, table.set_of[window]]), axis=1).T.tolist():
            items[d].update(table.items[s].tolist())
        _longest(where, window, ids, doc, start, table, best)
    hit = (np.cumsum(cover[:n]) > 0).astype(np.int64)
    items = [sorted(i) for i in items]
    if not last:
        edges = np.diff(np.concatenate([[0], hit, [0]]))
        begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        of = np.searchsorted(start, begin, side="right") - 1
        return {"spans": (of, begin - start[of], end - start[of]), "items": items, "best": best}
    covered = np.concatenate([[0], np.cumsum(hit)])
    n_hit = covered[start[1:]] - covered[start[:-1]]
    return {"n_words": count, "n_hit": n_hit.tolist(), "items": items, "longest": [-b[0] for b in best],
            "longest_item": [None if not b[0] or b[1] == UNNAMED else b[1] for b in best], "longest_start": [b[3] if b[0] else None for b in best]}


class Passes:
    """The benchmark as tables, one pass over the documents at a time.

    Equal texts are one with all their ids; texts are laid out in blocks by their bytes, in a written table.  The driver
    holds the texts of one block, and only the tables of the pass in hand are broadcast: `close` drops them.
    """

    def __init__(self, benchmark: DataFrame, window: int, block_bytes: int, pass_bytes: int, unnamed: bool = False):
        items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
        items = items.fillna(UNNAMED, ["item_id"]) if unnamed else items.where("item_id IS NOT NULL")
        texts = items.where("text <> ''").groupBy("text").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
        texts = saved(texts.withColumns({"number": F.monotonically_increasing_id(), "size": F.octet_length("text").cast("long")}), "benchmark-texts")
        block_bytes = min(block_bytes, pass_bytes)
        self.blocks = saved(texts.join(block_numbers(texts, "number", block_bytes), "number"), "benchmark-blocks")
        numbers = [r["block"] for r in self.blocks.select("block").distinct().orderBy("block").collect()]
        each = max(1, pass_bytes // block_bytes)
        self.passes = [numbers[k:k + each] for k in range(0, len(numbers), each)] or [[]]
        self.window, self.context, self.tables = window, benchmark.sparkSession.sparkContext, []

    def open(self, number: int) -> list:
        for block in self.passes[number] or [None]:
            rows = self.blocks.where(F.col("block") == block).orderBy("number").select("text", "ids").collect() if block is not None else []
            texts = [(list(r["ids"]), w) for r in rows if (w := _words(r["text"].encode("utf-8", "surrogatepass")))]
            self.tables.append(self.context.broadcast(Suffixes(texts, self.window)))
        return self.tables

    def close(self) -> None:
        for table in self.tables:
            table.destroy()
        self.tables = []


def search(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
           pass_bytes: int = PASS_BYTES, shard_bytes: int = SHARD_BYTES, keep: tuple = ("doc_id",),
           unnamed: bool = False) -> DataFrame:
    """The columns `keep` of every document and what its text shares with the benchmark.

    n_words, n_hit (words inside any occurrence of a window), items (ascending ids of the items that
    occur), longest (words of the longest verbatim match with one text), longest_item, longest_start (its
    place, in words).  A window is `window` consecutive words of an item or the whole of a shorter one.

    Training texts are cut into shards of about `shard_bytes` where they are read; each gets a suffix
    array in which every benchmark window is searched.  Nothing is shuffled but the benchmark and no
    window of the corpus leaves its task.  A place of a text counts once a window, however many items or places hold
    the window; the longest match is read from the neighbours in a suffix array of the benchmark's block.  The benchmark may
    have any size: equal texts are one, and it goes to the tasks as tables of up to `block_bytes` of text (or one longer
    text), searched one after another in the same shard.  Beyond `pass_bytes` the documents are read in passes, written in
    between with what was found so far, so that every result is over all passes; only one pass's tables exist
    at a time.  Texts are never split: a longer training text is a shard by itself.  Null and empty texts have no
    words and no hits, an empty benchmark hits nothing, null texts are ignored, rows with a null item id count in all
    but `items` where `unnamed` is set and are ignored otherwise, repeated documents count as they stand, and columns of
    `keep` that are named like a new one are replaced by it.
    """
    passes = Passes(benchmark, window, block_bytes, pass_bytes, unnamed)
    return searched(docs, passes, range(len(passes.passes)), shard_bytes, keep)


def searched(docs: DataFrame, passes: Passes, numbers, shard_bytes: int, keep: tuple) -> DataFrame:
    """`search` with some passes over the benchmark."""
    new = [f.split()[0] for f in SCHEMA.split(", ")]
    kept = [k for k in keep if k.lower() not in new]
    base = docs.select(*[F.col(f"`{k}`") for k in dict.fromkeys([*kept, "text"])])
    carried = [f for f in base.schema.fields if f.name in kept]
    between = base.schema.fields

    def fields(of):
        return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in of)

    def over(tables, first, last):
        def found(shard):
            import numpy as np
            import pyarrow as pa

            joined = pa.Table.from_batches(shard).combine_chunks()
            texts, earlier = joined.column("text").cast(pa.large_binary()).to_pylist(), None
            if not first:
                spans = pa.concat_arrays(joined.column("_pass_spans").chunks)
                flat = spans.flatten()
                of = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy(zero_copy_only=False))
                earlier = ((of, *(flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))), joined.column("_pass_items").to_pylist(),
                           [tuple(b[c] for c in BEST) for b in joined.column("_pass_best").to_pylist()])
            columns = {f.name: joined.column(f.name) for f in (carried if last else between)}
            result = search_shard(texts, [t.value for t in tables], earlier, last)
            if last:
                for name, values in result.items():
                    columns[name] = pa.array(values, pa.list_(pa.int64()) if name == "items" else pa.int64())
            else:
                of, *values = result["spans"]
                ends = np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)
                columns["_pass_spans"] = pa.ListArray.from_arrays(
                    pa.array(ends), pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], ["first", "last"]))
                columns["_pass_items"] = pa.array(result["items"], pa.list_(pa.int64()))
                columns["_pass_best"] = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in zip(*result["best"])], list(BEST))
            return pa.table(columns).to_batches()

        def run(batches):
            shard, size = [], 0
            for batch in batches:
                shard.append(batch)
                size += batch.nbytes
                if size >= shard_bytes:
                    yield from found(shard)
                    shard, size = [], 0
            if shard:
                yield from found(shard)

        return run

    state = ("_pass_spans array<struct<first: long, last: long>>, _pass_items array<long>, _pass_best struct<"
             + ", ".join(f"`{b}`: long" for b in BEST) + ">")
    numbers = list(numbers)
    for k, number in enumerate(numbers[:-1]):
        base = saved(base.mapInArrow(over(passes.open(number), k == 0, False), fields(between) + state), "benchmark-pass")
        passes.close()
    return base.mapInArrow(over(passes.open(numbers[-1]), len(numbers) == 1, True), fields(carried) + SCHEMA)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                        pass_bytes: int = PASS_BYTES, shard_bytes: int = SHARD_BYTES, unnamed: bool = False) -> DataFrame:
    """The documents that share no window with the benchmark, with all their columns.

    The benchmark is cut as in `search`; each pass over it reads the documents the last one left, written
    in between.
    """
    left, passes = docs, Passes(benchmark, window, block_bytes, pass_bytes, unnamed)
    for k in range(len(passes.passes)):
        rows = left.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
        left = searched(rows, passes, [k], shard_bytes, ("_row",)).where("n_hit = 0").select("_row.*")
        if k < len(passes.passes) - 1:
            left = saved(left, "uncontaminated")
            passes.close()
    return left
