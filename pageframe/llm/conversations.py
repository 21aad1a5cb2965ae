"""Repair of conversations: weighted CYK parsing of their role sequence, interval by interval.

The grammar is in Chomsky normal form.  A nonterminal N[p, q] takes the role sequence from state p to state q
(nothing yet, after system, after user, after assistant): N[p, q] -> N[p, r] N[r, q], or one row under one edit.
Insertions derive the empty span; their closure is part of every cell.  A cell holds, for each nonterminal, the
cheapest (cost, audit) of a span of rows, the audit being the initials of the edits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values ---------------------------------------------------------------------------------
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}     # role initial -> state before: state after
ACCEPTED = (0, 3)                                                # nothing, or an assistant spoke last
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3                  # costs; Keep is free
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
# --------------------------------------------------------------------------------------------------
BLOCK = 16   # rows of one chart
FAN = 4      # spans of one chart above the rows

PAIRS = [(p, q) for p in range(4) for q in range(4) if p == q or q in (2, 3) or (p, q) == (0, 1)]
BINARY = [(PAIRS.index((p, q)), PAIRS.index((p, r)), PAIRS.index((r, q)))
          for p, q in PAIRS for r in range(4) if (p, r) in PAIRS and (r, q) in PAIRS]


def joined(left: list, right: list) -> list:
    """The cell of a span from the cells of its two parts, by all binary rules."""
    best = [None] * len(PAIRS)
    for target, a, b in BINARY:
        x, y = left[a], right[b]
        if x is None or y is None:
            continue
        cost, old = x[0] + y[0], best[target]
        if old is None or cost < old[0] or (cost == old[0] and x[1] + y[1] < old[1]):
            best[target] = (cost, x[1] + y[1])
    return best


def lower(one: list, other: list) -> list:
    return [min((v for v in pair if v is not None), default=None) for pair in zip(one, other)]


def _insertions() -> list:
    """The cell of the empty span: closure of the insertions of user and assistant."""
    closed = [(0, "") if p == q else None for p, q in PAIRS]
    single = [(INSERT, "I") if any(STEPS[r].get(p) == q for r in "ua") else None for p, q in PAIRS]
    while True:
        more = lower(closed, joined(closed, single))
        if more == closed:
            return closed
        closed = more


EMPTY = _insertions()


@lru_cache(maxsize=4096)
def leaf(kind: str) -> tuple:
    """The cell of one row: its initial and `!` where it is truncated, or D and the number of rows to delete."""
    cell = [None] * len(PAIRS)
    for i, (p, q) in enumerate(PAIRS):
        if kind[0] == "D":
            ways = [(DELETE * int(kind[1:]), "D" * int(kind[1:]))] if p == q else []
        else:
            late = UNFINISHED if kind.endswith("!") else 0
            ways = [(DELETE, "D")] if p == q else []
            ways += [(late, "K")] if STEPS.get(kind[0], {}).get(p) == q else []
            ways += [(REROLE + late, "R")] if any(STEPS[r].get(p) == q for r in "ua") else []
        cell[i] = min(ways, default=None)
    return tuple(joined(joined(EMPTY, cell), EMPTY))


def chart(cells: list) -> list:
    """The cell of a whole span, bottom-up by span length over every split of every span within it."""
    n = len(cells)
    table = {(i, i + 1): cell for i, cell in enumerate(cells)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best = None
            for k in range(i + 1, i + length):
                found = joined(table[i, k], table[k, i + length])
                best = found if best is None else lower(best, found)
            table[i, i + length] = best
    return table[0, n]


@lru_cache(maxsize=1 << 15)
def block(kinds: tuple) -> tuple:
    return tuple(chart([leaf(k) for k in kinds]))


class Spans:
    """Cells of a growing sequence: full charts of BLOCK rows become leaves of charts of FAN spans, level by level.

    The binary rules are associative, so a span's cell does not depend on where the charts are cut (tested).
    Memory is one audit a nonterminal and a few open spans a level.
    """

    def __init__(self):
        self.rows, self.levels = [], []

    def add(self, kind: str) -> None:
        self.rows.append(kind)
        if len(self.rows) == BLOCK:
            self.put(block(tuple(self.rows)))
            self.rows = []

    def put(self, cell, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(cell)
        if len(self.levels[level]) == FAN:
            cells, self.levels[level] = self.levels[level], []
            self.put(chart(cells), level + 1)

    def cell(self) -> list:
        last = [block(tuple(self.rows))] if self.rows else []
        for cells in self.levels:
            if cells:
                last = [chart(cells + last)]
        return list(last[0]) if last else EMPTY


def best_edits(cell: list) -> tuple:
    return min(cell[PAIRS.index((0, q))] for q in ACCEPTED)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies (0 to 2): rows hit by the checksum of `conv_id:turn`, nulls read as one space.

    A dropped row stays with 0 copies and without text, so that its conversation is known.
    """
    def known(name, blank=" "):
        return F.coalesce(F.col(name).cast("string"), F.lit(blank))

    at = F.concat(known("conv_id"), F.lit(":"), known("turn"))
    hit = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), known("role").alias("role"), known("text").alias("text"),
                               (F.crc32(at.cast("binary")) % 20).alias("code"))
    code = F.col("code")
    return hit.select(
        "conv_id", "turn", F.when(code == 0, "").when(code == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(code.isin(0, 1), "").when(code == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text")).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("long").alias("copies"))


def row_digest(role: str = "role", text: str = "text") -> Column:
    """16 bytes naming role and text."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), F.col(role), F.col(text)).cast("binary")))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """One row per conv_id, turn and digest: copies, initial, blank, unfinished, and `known` where an earlier turn has the same."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    thin = rows.select("conv_id", "turn", row_digest().alias("digest"), F.substring("role", 1, 1).alias("initial"),
                       (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(*ENDS)).alias("unfinished"), "copies")
    thin = thin.groupBy("conv_id", "turn", "digest", "initial", "blank", "unfinished").agg(F.sum("copies").alias("copies"))
    first = F.min(F.struct("turn")).alias("first")
    again = thin.where("copies > 0").groupBy("conv_id", "digest").agg(first, F.count("*").alias("turns")).where("turns > 1")
    again = again.select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), F.col("first.turn").alias("_turn"), F.lit(True).alias("_again"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    known = F.coalesce(F.col("_again"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("_turn"))
    return thin.join(again, same, "left").select(*thin.columns, known.alias("known"))


_COUNTS = ("n_rows", "blank", "duplicate", "truncated", "illegal")
_SPAN = ("conv_id {conv}, turn long, digest binary, costs array<long>, audits array<string>, n_rows long, blank long, duplicate long, truncated long, "
         "illegal long, distinct long, low long, high long, first string, last string")
LEGAL = {"su", "ua", "au"}


def _batches(rows: list, schema):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(schema: str, conv):
    """Arrow schema of the span rows; conv is the Arrow type of conv_id."""
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string()), "{conv}": conv}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])


class _Tally:
    """What one span of a conversation adds up to."""

    def __init__(self, row):
        self.at = (row["turn"], row["digest"])
        self.spans, self.counts = Spans(), dict.fromkeys(_COUNTS, 0)
        self.distinct, self.low, self.high, self.first, self.last = 0, None, None, None, None

    def turns(self, low, high, distinct):
        if low is not None:
            self.distinct += distinct - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high

    def edge(self, first, last):
        if first is not None:
            self.counts["illegal"] += self.last is not None and self.last + first not in LEGAL
            self.first, self.last = first if self.first is None else self.first, last

    def add(self, row):
        copies, initial = row["copies"], row["initial"]
        if not copies:
            return
        self.turns(row["turn"], row["turn"], 1)
        self.edge(initial, initial)
        self.counts["illegal"] += (copies - 1) * (initial + initial not in LEGAL)
        self.counts["n_rows"] += copies
        gone = copies if row["blank"] or row["known"] else copies - 1
        self.counts["blank" if row["blank"] else "duplicate"] += gone
        if gone < copies:
            self.counts["truncated"] += row["unfinished"]
            self.spans.add((initial if initial in STEPS else "-") + "!" * row["unfinished"])
        if gone:
            self.spans.add(f"D{gone}")

    def merge(self, row):
        if row["n_rows"]:
            self.turns(row["low"], row["high"], row["distinct"])
            self.edge(row["first"], row["last"])
            for name in _COUNTS:
                self.counts[name] += row[name]
            self.spans.put([None if cost is None else (cost, audit) for cost, audit in zip(row["costs"], row["audits"])])

    def row(self, conv):
        cell = [v or (None, None) for v in self.spans.cell()]
        return {"conv_id": conv, "turn": self.at[0], "digest": self.at[1], "costs": [c for c, _ in cell], "audits": [a for _, a in cell],
                **self.counts, "distinct": self.distinct, "low": self.low, "high": self.high, "first": self.first, "last": self.last}


def spans(rows: DataFrame) -> DataFrame:
    """One row per conversation and range of rows: the cell and the counts of the range.

    Rows are dealt out by ranges of (conv_id, turn, digest), so a conversation of any length is parsed by many
    tasks; each reads its rows in order and keeps one chart.
    """
    order = ["conv_id", "turn", "digest"]
    schema = _SPAN.format(conv=rows.schema["conv_id"].dataType.simpleString())

    def run(batches: Iterator) -> Iterator:
        tally, conv, out, made = None, None, [], None
        for batch in batches:
            made = _arrow(_SPAN, batch.schema.field("conv_id").type)
            for row in batch.to_pylist():
                if tally is None or row["conv_id"] != conv:
                    if tally is not None:
                        out.append(tally.row(conv))
                    tally, conv = _Tally(row), row["conv_id"]
                tally.add(row)
            if len(out) >= 1000:
                yield _batches(out, made)
                out = []
        if tally is not None:
            yield _batches(out + [tally.row(conv)], made)

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def repaired(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, n_rows.

    `rows` are the rows to repair (conv_id, turn, role, text, copies), the damaged ones if not given.  They come by
    turn, nulls first; rows of one turn by the digest of role and text, so that equal rows are neighbours.  Nulls in
    role and text are read as one space; a null conv_id is a conversation of its own.  Rows that repeat are copies
    of one another.  A conversation without rows has zeros, an empty audit and the hash of the empty string; no
    conversations, no rows.  Other columns are not read.

    Texts are hashed as they stream by in the order of their conversation: a digest has to be taken in one task, and
    that task holds one batch of texts and the audits of the conversation.
    """
    rows = damaged(conversations) if rows is None else rows
    conv = rows.schema["conv_id"].dataType.simpleString()
    ranges = spans(distinct_rows(rows))
    parts = ranges.select("*", *[F.lit(None).cast("string").alias(c) for c in ("role", "text")], F.lit(0).cast("long").alias("copies"), F.lit(0).alias("kind"))
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in ranges.schema.fields if f.name not in ("conv_id", "turn", "digest")]
    texts = rows.where("copies > 0").select("conv_id", "turn", row_digest().alias("digest"), *blanks, "role", "text", "copies", F.lit(1).alias("kind"))

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        made, out, now = None, [], None

        class Repair:
            """Merges the spans of a conversation, then replays the edits over its rows."""

            def __init__(self, row):
                self.conv, self.tally, self.edits = row["conv_id"], _Tally(row), None
                self.sha, self.at, self.turns = hashlib.sha256(), 0, 0

            def say(self, role, text=""):
                self.sha.update(f"{chr(10) if self.turns else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                self.turns += 1

            def other(self):
                return "user" if (self.turns - self.odd) % 2 == 0 else "assistant"

            def start(self):
                self.cost, self.edits = best_edits(self.tally.spans.cell())
                self.odd = (len(self.edits) - self.edits.count("D")) % 2     # one system row before the pairs

            def insertions(self):
                while self.edits[self.at:self.at + 1] == "I":
                    self.say(self.other())
                    self.at += 1

            def add(self, row):
                if self.edits is None:
                    self.start()
                for _ in range(row["copies"]):
                    self.insertions()
                    edit = self.edits[self.at]
                    self.at += 1
                    if edit != "D":
                        self.say(row["role"] if edit == "K" else self.other(), row["text"])

            def row(self):
                if self.edits is None:
                    self.start()
                self.insertions()
                t = self.tally
                gaps = 0 if t.low is None else min(t.high - t.low + 1 - t.distinct, 2**63 - 1)
                return {"conv_id": self.conv, "gaps": gaps, **{c: t.counts[c] for c in _COUNTS[1:]}, "cost": self.cost, "audit": self.edits,
                        "repaired_sha256": self.sha.hexdigest(), "n_rows": t.counts["n_rows"]}

        for batch in batches:
            if made is None:
                longs = [(c, pa.int64()) for c in ("gaps", *_COUNTS[1:], "cost")]
                made = pa.schema([("conv_id", batch.schema.field("conv_id").type), *longs, ("audit", pa.string()),
                                  ("repaired_sha256", pa.string()), ("n_rows", pa.int64())])
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now.conv:
                    if now is not None:
                        out.append(now.row())
                    now = Repair(row)
                now.tally.merge(row) if row["kind"] == 0 else now.add(row)
            if len(out) >= 1000:
                yield _batches(out, made)
                out = []
        if now is not None:
            yield _batches(out + [now.row()], made)

    return (parts.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "digest")
            .mapInArrow(run, f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
                             "repaired_sha256 string, n_rows long"))
