"""Small tables with everything that may come: nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

import random

EXTRA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, shard int, n_words string, "
         "start int, secrets int, entities int, _key int, value int, component_id int, digest string, n_removed int")


def prose(rng, n, words=None):
    words = words or ["amber", "brook", "cedar", "dune", "ember", "fjord", "grove", "heath", "islet", "knoll", "larch", "moor",
                      "north", "oak", "pine", "quarry", "ridge", "stone", "tarn", "vale", "willow", "yew", "été", "straße"]
    out, sentence = [], []
    for _ in range(n):
        sentence.append(rng.choice(words) + rng.choice(["", "", "en", "ly", "s", "ing", "ed"]))
        if rng.random() < 0.12 and len(sentence) > 3:
            out.append(" ".join(sentence).capitalize() + rng.choice([". ", ".\n", "? "]))
            sentence = []
    if sentence:
        out.append(" ".join(sentence).capitalize() + ".")
    return "".join(out).strip()


def rows(seed=5):
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([3, 30, 80, 160])) for _ in range(40)]
    passage = prose(rng, 70)
    near = base[3].split(" ")
    texts = base + [base[3], base[3], base[3].upper(), " ".join(near[:10] + ["changed"] + near[11:]), base[5] + "\n" + passage,
                    passage + "\n" + base[6], base[7] + "\n" + passage + "\n" + base[8], "", None, " \n\t ", "word", "one two three four",
                    "Same line here.\n" * 30, "x" * 5000, prose(rng, 6000), "home | about | contact | login\n" + base[9],
                    'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" ' + base[10], "Mail anna.k@mail.example.com or ANNA.K@mail.example.com.",
                    "Released under the MIT License.", "\x00 odd \u2028 marks \U0001f600 ok ok ok ok ok"]
    out = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    out += [out[3], out[3], (None, base[3], None, None, None), (None, None, None, None, None), (-7, base[12], None, "src0", 0)]
    return out


def documents(spark, some=None):
    """The rows above, with columns that bear the names of results and helpers."""
    data = [(*r, True, 9, "w", 1, 2, 3, 4, 5, 6, "d", 7) for r in (rows() if some is None else some)]
    return spark.createDataFrame(data, EXTRA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], EXTRA)
