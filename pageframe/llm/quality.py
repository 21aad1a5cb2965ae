"""Quality rules: clean line by line, then reject documents that lose too much of their text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from pageframe.llm.common import arrow_map

MAX_LOSS = 0.5          # share of a document's word characters that its failing lines may hold
MARKS_SHARE = 0.12      # share of a line's characters that may be marks other than sentence punctuation
CUT_WORDS = 15          # a line of so many words that holds a sentence end inside may lack one at its end
SEPARATORS = 2          # navigation: so many stand-alone separators in one line
# Sentence ends, stand-alone separators of menus, and phrases of page furniture.
SENTENCE_ENDS = (".", "!", "?", "…", ":", ";", '"', "'", ")", "]", "”", "’", "»", "。", "！", "？")
MENU_SEPARATORS = ("|", "›", "»", "·", "•", "/", ">", "::")
MARKS = "!?#*$%&|<>=^~@_{}\\"
MENU_WORDS = ("home", "about", "contact", "login", "register", "sitemap", "help", "menu", "next", "previous", "search")
BOILERPLATE = (
    "all rights reserved", "accept cookies", "use of cookies", "enable javascript", "terms of use", "terms of service",
    "privacy policy", "sign in to", "subscribe to our", "click here", "lorem ipsum", "powered by", "back to top",
    "share this", "follow us on", "skip to content")

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_lines long, n_lines_removed long, lost_share double")


def repeated_words(words: list) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    from collections import Counter
    often = Counter(windows)
    hit, until = 0, 0
    for at, window in enumerate(windows):
        if often[window] > 1:
            hit += at + 3 - max(at, until)
            until = at + 3
    return hit


def line_rule():
    """Function from a line (UTF-8 bytes) to the name of the rule it fails, or None."""
    ends = tuple(e.encode() for e in SENTENCE_ENDS)
    separators = {s.encode() for s in MENU_SEPARATORS}
    menu = {w.encode() for w in MENU_WORDS}
    phrases = [p.encode() for p in BOILERPLATE]
    marks = MARKS.encode()
    inner = re.compile(rb"[^\s.!?][.!?] ")

    def rule(line: bytes) -> str | None:
        bare = line.strip()
        if not bare.endswith(ends) and (len(bare.split()) < CUT_WORDS or not inner.search(bare)):
            return "punctuation"
        if len(bare) - len(bare.translate(None, marks)) > MARKS_SHARE * len(bare) + 1:
            return "punctuation"
        words = bare.lower().split()
        if sum(map(words.count, separators)) >= SEPARATORS:
            return "navigation"
        if len(words) <= 12 and 2 * sum(w.strip(b".,:;!") in menu for w in words) > len(words):
            return "navigation"
        lower = bare.lower()
        if any(p in lower for p in phrases):
            return "boilerplate"
        return None

    return rule


def examine(body: bytes, rule, max_loss: float) -> tuple:
    """Counts of a text, its verdict and its lines that pass."""
    spaces, symbols = b" \t\n\v\f\r", b"#*$%&|<>"
    words, seen, passed = body.split(), set(), []
    lines = gone = duplicates = total = lost = 0
    for line in body.split(b"\n"):
        size = len(line.translate(None, spaces))
        if not size:
            passed.append(line)
            continue
        lines += 1
        duplicates += line in seen
        seen.add(line)
        total += size
        if rule(line) is None:
            passed.append(line)
        else:
            gone += 1
            lost += size
    repeats = repeated_words(words)
    failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    n_symbols = len(body) - len(body.translate(None, symbols))
    return (len(words), n_symbols, duplicates, repeats, failed, not failed and lost <= max_loss * total,
            lines, gone, lost / total if total else 0.0, passed)


def clean(docs: DataFrame, *, with_text: bool = True, max_loss: float = MAX_LOSS) -> DataFrame:
    """One row per document: base counts, the verdict and, `with_text`, the text without its failing lines.

    Each line with a word is tested for sentence punctuation, navigation and boilerplate; lines that
    fail go.  A document is kept when it passes the base rules (50 words, at most half of them in
    repeated three-word windows) and its failing lines hold at most `max_loss` of its text, counted in
    bytes of words.  Whole texts are measured; no shuffle.  A null text has no words and fails; its
    clean text is null.  Repeated rows give one row each.  Other columns than doc_id and text are not read.
    """
    schema = SCHEMA + ", clean_text string" * with_text

    def judge(batch):
        import pyarrow as pa
        import pyarrow.compute as pc

        rule = line_rule()
        text = batch.column("text")
        points = pc.fill_null(pc.utf8_length(text), 0).to_pylist()
        raw = text.cast(pa.binary()).to_pylist()
        spaces = b" \t\n\v\f\r"
        found = [examine(r or b"", rule, max_loss) for r in raw]
        n_words, n_symbols, n_dup, n_repeat, failed, kept, lines, gone, share, passed = zip(*found)
        blank = [len(r) - len(r.translate(None, spaces)) if r else 0 for r in raw]
        columns = {
            "doc_id": batch.column("doc_id"), "n_words": n_words, "word_chars": [p - b for p, b in zip(points, blank)],
            "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat, "base_failed": failed,
            "kept": kept, "n_lines": lines, "n_lines_removed": gone, "lost_share": share}
        if with_text:
            columns["clean_text"] = [None if r is None else b"\n".join(p).decode() for r, p in zip(raw, passed)]
        return pa.RecordBatch.from_pydict({k: v if k == "doc_id" else list(v) for k, v in columns.items()})

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), judge, schema)


def keep_clean(docs: DataFrame, *, max_loss: float = MAX_LOSS) -> DataFrame:
    """The kept documents with all their columns: failing lines removed, n_chars (if present) brought up to date.

    One pass, row by row; a null text is rejected.  Rows that are kept keep their order and multiplicity.
    """

    @F.pandas_udf("string")
    def cleaned(texts):
        import pandas as pd
        rule = line_rule()

        def one(text):
            if text is None:
                return None
            found = examine(text.encode(), rule, max_loss)
            return b"\n".join(found[-1]).decode() if found[5] else None

        return pd.Series([one(t) for t in texts], dtype=object)

    # Marked nondeterministic so that the filter stays above it and it runs once per row.
    kept = docs.withColumn("text", cleaned.asNondeterministic()("text")).where(F.col("text").isNotNull())
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
