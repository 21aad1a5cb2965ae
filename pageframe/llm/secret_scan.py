"""Secret scan: fixed credential patterns, and two character Markov models compared by log-likelihood ratio."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, functions as F

# The base patterns.  Letters of the key word stand for either case.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"

SAMPLE_ROWS = 2000      # documents whose words and base secrets are the labelled samples
SAMPLE_WORDS = 20_000   # ordinary identifiers and random strings, each
FALSE_ALARMS = 0.0005   # share of the held-out identifiers that may pass the threshold


def base_spans(text: str) -> list[tuple]:
    """(start, end, kind number) of the base patterns, leftmost and non-overlapping per kind."""
    found = [(m.start(), m.end(), 0) for m in re.finditer(ASSIGN, text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in re.finditer(ACCESS, text)]
    return found + [(m.start(), m.end(), 2) for m in re.finditer(HEX, text)]


def random_strings(rng: random.Random, n: int) -> list[str]:
    """Strings as key generators make them: hexadecimal, base 32, base 62 and base 64, of 20 to 64 characters."""
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    alphabets = (digits + "abcdef", digits + "ABCDEF", upper + "234567", lower + digits, lower + upper + digits,
                 lower + upper + digits + "+/", lower + upper + digits + "-_")
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(20, 64))) for _ in range(n)]


def identifiers(rng: random.Random, words: list[str], n: int) -> list[str]:
    """Ordinary names as people make them of words: long words, snake, kebab and camel case, paths, numbers, repeats."""
    words = words or ["value", "name", "number", "result", "index", "table"]
    shapes = (lambda w: "_".join(w), lambda w: "-".join(w), lambda w: "".join(x.capitalize() for x in w),
              lambda w: "/".join(w), lambda w: "".join(w), lambda w: "_".join(w).upper(),
              lambda w: "-".join(w) + str(rng.randint(1, 2030)), lambda w: str(rng.randint(1, 99)) * rng.randint(10, 20),
              lambda w: rng.choice("=-_+/") * rng.randint(20, 60), lambda w: "".join(w).capitalize())
    out = []
    while len(out) < n:
        name = rng.choice(shapes)(rng.choices(words, k=rng.randint(2, 6)))
        if len(name) >= 20:
            out.append(name[:64])
    return out


class RandomnessModel:
    """First-order character chains of random strings and of identifiers; score: mean log-likelihood ratio."""

    def __init__(self, noise: list[str], names: list[str], false_alarms: float = FALSE_ALARMS):
        import math

        def chain(strings):
            counts: dict = {}
            for s in strings:
                for pair in zip("^" + s, s):
                    counts[pair] = counts.get(pair, 0) + 1
            totals: dict = {}
            for (a, _), c in counts.items():
                totals[a] = totals.get(a, 0) + c
            return {(a, b): math.log((counts.get((a, b), 0) + 0.5) / (totals.get(a, 0) + 0.5 * len(ALPHABET)))
                    for a in "^" + ALPHABET for b in ALPHABET}

        train_noise, train_names = noise[::2], names[::2]
        high, low = chain(train_noise), chain(train_names)
        self.ratio = {a: {b: high[a, b] - low[a, b] for b in ALPHABET} for a in "^" + ALPHABET}
        held_out = sorted(self.score(s) for s in names[1::2])
        self.threshold = max(0.0, held_out[int(len(held_out) * (1 - false_alarms))] if held_out else 0.0)

    def score(self, s: str) -> float:
        total, before = 0.0, self.ratio["^"]
        for c in s:
            total += before[c]
            before = self.ratio[c]
        return total / len(s) if s else 0.0

    def is_random(self, s: str) -> bool:
        return self.score(s) > self.threshold


def _samples(docs: DataFrame) -> DataFrame:
    """(label, string): the words and the base secrets of whole texts, each once a batch."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = set()
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                found |= {("value", text[a:b]) for a, b, k in spans if k and set(text[a:b]) <= set(ALPHABET)}
                pieces, at = [], 0
                for a, b, _ in sorted(spans):
                    pieces.append(text[at:a])
                    at = max(at, b)
                plain = " ".join([*pieces, text[at:]])
                found |= {("word", w) for w in re.findall(r"(?<![^\s])[A-Za-z]{3,14}(?![^\s.,;!?])", plain)}
            if found:
                labels, strings = zip(*sorted(found))
                yield pa.RecordBatch.from_arrays([pa.array(labels), pa.array(strings)], names=["label", "string"])

    return docs.select("text").mapInArrow(run, "label string, string string")


def train(docs: DataFrame, *, rows: int = SAMPLE_ROWS, size: int = SAMPLE_WORDS, seed: int = 7) -> RandomnessModel:
    """Models fitted on labelled samples: whole texts of at most `rows` documents, at most `size` strings of either label.

    Label random: strings drawn over the alphabets of key generators, and the values of base patterns in
    the sampled documents (`size` / 4 at most).  Label ordinary: names composed of the sampled documents' words.  The
    documents are those whose whole texts have the `rows` smallest distinct hashes, the strings those with the
    smallest hashes, so the models do not depend on order or partitions.  Half of each label is held out to
    set the threshold.
    """
    texts = docs.select("text").where("text IS NOT NULL").withColumn("mark", F.xxhash64("text"))
    smallest = texts.select("mark").distinct().orderBy("mark").limit(rows).agg(F.max("mark")).first()[0]
    found = {"word": [], "value": []}
    if smallest is not None:
        strings = _samples(texts.where(F.col("mark") <= smallest)).distinct()
        for label, most in (("word", size), ("value", size // 4)):
            some = strings.where(F.col("label") == label).orderBy(F.xxhash64("string"), "string").limit(most)
            found[label] = sorted(r["string"] for r in some.collect())
    rng = random.Random(seed)
    noise = random_strings(rng, size - len(found["value"])) + found["value"]
    rng.shuffle(noise)
    return RandomnessModel(noise, identifiers(rng, found["word"], size))


def spans_of(text: str, model: RandomnessModel) -> list[tuple]:
    """Base spans and, where they leave room, runs that look random; sorted by start, then kind."""
    base = sorted(base_spans(text), key=lambda s: (s[0], s[2]))
    more, at, reach = [], 0, 0          # base spans before `at` start before the run; `reach` is where they end
    for m in re.finditer(CANDIDATE, text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][1])
            at += 1
        if reach <= m.start() and model.is_random(m.group()):
            more.append((m.start(), m.end(), 3))
    return sorted(base + more, key=lambda s: (s[0], s[2])) if more else base


def scan(docs: DataFrame, model: RandomnessModel) -> DataFrame:
    """All columns of `docs` and `secrets`: array<struct<kind, start, end>> in code points, ends exclusive.

    Base patterns stay as they are; runs of 20 or more key characters that overlap none and are likelier
    under the random chain than under the identifier chain, by more than the threshold a character, are
    added as kind `markov`.  Whole texts, no shuffle.  Null and empty texts have none; repeated rows give
    one row each; a column named secrets is replaced.
    """

    @F.arrow_udf("array<struct<kind:string,start:long,end:long>>")
    def find(texts):
        import pyarrow as pa

        out = []
        for text in texts.to_pylist():
            spans = spans_of(text, model) if text else []
            out.append([{"kind": KINDS[k], "start": a, "end": b} for a, b, k in spans])
        return pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))

    return docs.withColumn("secrets", find("text"))


def redact(docs: DataFrame, model: RandomnessModel, mark: str = "[SECRET]") -> DataFrame:
    """The documents with each secret replaced by `mark`; overlapping spans are replaced as one.

    Every document stays, its other columns unchanged but for n_chars (if present), which follows the text.
    """

    @F.arrow_udf("string")
    def masked(texts):
        import pyarrow as pa

        out = []
        for text in texts.to_pylist():
            pieces, at = [], 0
            for a, b, _ in spans_of(text, model) if text else []:
                if a >= at:
                    pieces += [text[at:a], mark]
                at = max(at, b)
            out.append("".join(pieces) + text[at:] if pieces else text)
        return pa.array(out, pa.string())

    done = docs.withColumn("text", masked.asNondeterministic()("text"))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast("long"))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])
