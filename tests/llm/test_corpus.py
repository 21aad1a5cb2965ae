"""Operators that bring rows of the corpus together: shuffle, surrogates, licences, spans, near-duplicates, pipeline."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import brute
import cases
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pageframe.llm import licenses, near_dup, pii, queries, sharding, spans
from pageframe.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n, shards, pieces", [(1000, 8, 1_000_000), (1003, 7, 20), (5, 8, 2), (1, 1, 1)])
def test_shuffle_deals_every_row_to_exact_shards(spark, n, shards, pieces):
    rows = spark.range(n).selectExpr("id AS doc_id", "id % 3 AS shard", "cast(null as string) AS text").repartition(5)
    got = sharding.shuffle(rows, shards, piece_rows=pieces).collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    sizes = [sum(r.shard == k for r in got) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for k in range(shards):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sizes[k]))


def test_shuffle_of_odd_rows(spark):
    docs = cases.documents(spark)
    got = sharding.shuffle(docs, 3)
    assert got.count() == docs.count() and got.columns[-2:] == ["shard", "slot"]
    assert Counter(r.text for r in got.collect()) == Counter(r.text for r in docs.collect())
    assert sharding.shuffle(cases.empty(spark), 3).count() == 0


def test_matrix_margins_are_exact(spark):
    counts = [0, 1, 7, 100, 5000, 3, 64]
    frame = spark.createDataFrame(list(enumerate(counts)), "block long, n long")
    for seed in range(5):
        matrix = {r.block: r.cells for r in sharding.communication_matrix(frame, 4, len(counts), seed).collect()}
        assert [sum(matrix[b]) for b in range(len(counts))] == counts
        shards = [sum(matrix[b][j] for b in matrix) for j in range(4)]
        assert sum(shards) == sum(counts) and max(shards) - min(shards) <= 1


@pytest.mark.parametrize("draws, good, total", [(30, 40, 100), (3, 2, 10), (500, 5000, 40000), (10, 10, 10), (0, 5, 10), (4, 0, 9)])
def test_hypergeometric_distribution(spark, draws, good, total):
    steps = 4000
    frame = spark.range(steps).selectExpr(f"{draws}L AS k", f"{good}L AS g", f"{total}L AS t", f"(id + 0.5D) / {steps} AS u")
    got = Counter(r.x for r in frame.select(F.expr(sharding.hypergeometric("k", "g", "t", "u")).alias("x")).collect())
    for x, n in got.items():
        p = math.comb(good, x) * math.comb(total - good, draws - x) / math.comb(total, draws)
        assert abs(n / steps - p) <= 1 / steps + 1e-9


def test_shuffle_is_uniform(spark):
    """Where a row lands does not depend on where it came from: shard and slot halves by block and place."""
    got = sharding.shuffle(spark.range(0, 40_000, 1, 4), 2, seed=3).collect()
    for block in range(4):
        part = [r for r in got if r.id // 10_000 == block]
        assert abs(sum(r.shard for r in part) - 5000) < 300
        assert abs(sum(r.slot < 10_000 for r in part) - 5000) < 300
    assert abs(sum(a.id < b.id for a, b in zip(got, got[1:])) - 20_000) < 600


def test_shuffle_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = queries.op1_hypergeometric_shuffle(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(docs[r.doc_id].encode()) + 1, brute.crc(docs[r.doc_id]), "rows", None)
    assert {r.slot for r in got if r.shard == 0} == set(range(25))


def family(rng, size, edits, words=160):
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 400)) for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"new{rng.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


def near_rows():
    rng = random.Random(11)
    texts = [r[1] for r in cases.rows() if r[0] is not None]
    for size, edits in ((60, 6), (80, 12), (20, 2), (5, 3)):
        texts += family(rng, size, edits)
    passage = cases.prose(rng, 90)
    texts += [passage + " " + " ".join(f"own{k}x{i}" for i in range(k % 30 + 1)) for k in range(80)]
    texts += [" ".join(f"t{i}" for i in range(n)) for n in range(1, 60)]        # sets around the sketch size
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(10 * order[i], t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("few", [near_dup.FEW, 0])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(near_dup, "FEW", few)
    rows = near_rows()
    want = brute.component_ids(rows)
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, component_id int, value int").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}
    assert len({c for _, c in want.values()}) < len(want) - 100


def test_near_duplicates_of_odd_rows(spark):
    docs = cases.documents(spark)
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id in (47, 48, 49)} == {(47, 47), (48, 48), (49, 49)}
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 40").count() == 0 and kept.where("doc_id = 3").count() == 1
    assert near_dup.near_duplicates(cases.empty(spark)).count() == 0


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    rng = random.Random(4)
    a, b, c = (cases.prose(rng, 80) for _ in range(3))
    near = " ".join(a.split(" ")[:-1] + ["end"])
    docs = spark.createDataFrame([(1, a), (5, near), (5, b), (5, near), (7, b.replace("a", "A")), (8, c), (2, c), (2, b), (2, None), (2, "")], "doc_id long, text string").repartition(4)
    kept = sorted(near_dup.keep_one(docs).collect(), key=str)
    assert kept == sorted([(1, a), (2, b), (2, c), (2, None), (2, "")], key=str)
    found = {(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()}
    assert found == {(1, 1, True), (5, 1, False), (5, 2, False), (7, 2, False), (8, 2, False), (2, 2, True)}


def test_near_duplicates_query(spark):
    want = brute.component_ids([tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op10_bottom_k(spark, SF).collect()} == want


def brute_spans(rows, least=spans.SENTENCES, words=spans.WORDS):
    """{(doc_id, text): the text without sentences of later spans}"""
    cut = re.compile(spans.CUT)
    docs = sorted({(d, t) for d, t in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    parts = {k: cut.split(k[1]) if k[1] else [] for k in docs}
    places = {}
    for key in docs:
        plain = [s.lower().split() for s in parts[key]]
        for i in range(len(plain)):
            for j in range(i + 1, len(plain) + 1):
                if j - i >= least and sum(map(len, plain[i:j])) >= words:
                    places.setdefault(tuple(map(tuple, plain[i:j])), []).append((key, i, j))
                    break
    gone = {k: set() for k in docs}
    for found in places.values():
        for key, i, j in found[1:]:
            gone[key] |= set(range(i, j))
    return {k: (k[1] if not gone[k] else "".join(s for i, s in enumerate(parts[k]) if i not in gone[k]), len(parts[k]), len(gone[k])) for k in docs}


def test_spans_equal_brute_force(spark):
    rows = [r[:2] for r in cases.rows()]
    want = brute_spans(rows)
    got = spans.cut_repeats(cases.documents(spark)).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        if r.doc_id is not None:
            assert (r.text, r.n_sentences, r.n_removed) == want[r.doc_id, text[r.doc_id]]
    by_id = {r.doc_id: r for r in got}
    assert by_id[44].text == text[44] and by_id[45].n_removed >= 3 and by_id[46].n_removed >= 3
    assert spans.cut_repeats(cases.empty(spark)).count() == 0


def test_spans_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    want = brute_spans(rows)
    assert {(r.doc_id, r.text, r.n_removed) for r in queries.op8_sentence_spans(spark, SF).collect()} == {(k[0], v[0], v[2]) for k, v in want.items()}


def test_spans_reach_the_end_of_a_passage_and_single_sentences(spark, tmp_path):
    def sentence(name, n):
        return " ".join(f"{name}{i}" for i in range(n)) + ". "
    passage = sentence("a", 25) + sentence("b", 25) + sentence("c", 5) + sentence("d", 5)
    long = sentence("l", 51)
    texts = [passage + sentence("e", 30), sentence("f", 4) + passage + sentence("g", 30), sentence("c", 5) + sentence("d", 5), sentence("h", 3), sentence("H", 3).lower(),
             long, sentence("i", 9) + long + sentence("j", 9), sentence("k", 50) + sentence("m", 3), sentence("n", 3) + sentence("k", 50), " \n ", " \n "]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in queries.op8_sentence_spans(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate([texts[0], sentence("f", 4) + sentence("g", 30), "", texts[3], "", long, sentence("i", 9) + sentence("j", 9), *texts[7:]]))


def test_licences(spark):
    mit = next(t for i, _, t in licenses.KNOWN if i == "MIT" and len(t) > 100)
    texts = ["Copyright (c) 2020 Someone\n\n" + mit.upper().replace("SUBLICENSE", "sub-license"), "© A. Uthor\n" + mit.replace("\n", " ") + "\n", mit + " more",
             "Some text.\n  RELEASED under the  MIT Licence!!\nMore text.", "This work is licensed under the GNU General Public License, version 3.",
             "a\nLicensed under CC-BY-NC 4.0\nb\nLicensed under CC BY-NC 4.0.", "", None, "Copyright 2020"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, digest string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [got[i].license_id for i in range(9)] == ["MIT", "MIT", None, None, "GPL-3.0-only", None, None, None, None]
    assert [got[i].notices for i in (2, 3, 4, 5)] == ["", "MIT", "GPL-3.0-only", "CC-BY-NC-4.0"]
    assert [got[i].n_notices for i in (3, 5)] == [1, 2]
    assert [i for i in range(9) if got[i].restricted] == [4, 5]
    assert sorted(r.doc_id for r in licenses.keep_unrestricted(docs).collect()) == [0, 1, 2, 3, 6, 7, 8]
    assert got[6].digest == got[7].digest == got[8].digest == brute.sha("")
    odd = licenses.scan(cases.documents(spark))
    assert odd.count() == len(cases.rows()) and licenses.scan(cases.empty(spark)).count() == 0
    given = licenses.scan(docs, licenses.known_digests(spark))
    assert {(r.doc_id, r.notices) for r in given.collect()} == {(i, r.notices) for i, r in got.items()}


PEOPLE = ["Write to Jo.Doe@mail.example.com, jo.doe@MAIL.example.com or bo@x.org.", "Call +1 (487) 555-7209 or 487-555-7209, not +44 20 7946 0958.",
          "Hosts 10.1.2.3, 10.1.2.3 and 192.168.10.200; version 1.2.3.4.5 stays, and 999.1.1.1.", "Card 4556 7375 8689 9855 or 4556737586899855.",
          "Mrs. Anna Berg met Herr Otto Klein-Haus. Mrs Anna Berg left.", "Г-жа Анна Петрова и Г-н Иван Сидоров.", "No entities here: 12 apples, 3.5 pears.", "", None,
          "jo.doe@mail.example.com again"]


def test_surrogates(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(PEOPLE)], "doc_id long, text string, entities int").repartition(3)
    got = {r.doc_id: r for r in pii.surrogates(docs, "k1").collect()}
    text = [got[i].text for i in range(len(PEOPLE))]
    assert text[6:9] == PEOPLE[6:9] and "1.2.3.4.5" in text[2] and "999.1.1.1" in text[2]
    mails = re.findall(r"[\w.]+@[\w.]*\w", text[0])
    assert mails[0] == mails[1] != mails[2] and text[9] == mails[0] + " again" and not set(mails) & set(re.findall(r"[\w.]+@[\w.]*\w", PEOPLE[0]))
    numbers = re.match(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4}), not (\+44 \d\d \d{4} \d{4})\.", text[1])
    assert numbers and re.sub(r"\D", "", numbers[1])[1:] == re.sub(r"\D", "", numbers[2]) != "4875557209" and numbers[3] != "+44 20 7946 0958"
    hosts = re.match(r"Hosts ([\d.]+), ([\d.]+) and ([\d.]+);", text[2])
    assert hosts[1] == hosts[2] != hosts[3] and hosts[1] != "10.1.2.3"
    cards = re.match(r"Card (\d{4} \d{4} \d{4} \d{4}) or (\d{16})\.", text[3])
    assert cards and cards[1].replace(" ", "") == cards[2] != "4556737586899855"
    names = re.match(r"Mrs\. (\w+ \w+) met Herr (\w+ \w+)\. Mrs (\w+ \w+) left\.", text[4])
    assert names and names[1] == names[3] and names[1].split()[0] in pii.GIVEN["latin", "f"] and names[2].split()[0] in pii.GIVEN["latin", "m"]
    cyrillic = re.match(r"Г-жа (\w+) (\w+) и Г-н (\w+) (\w+)\.", text[5])
    assert cyrillic and cyrillic[1] in pii.GIVEN["cyrillic", "f"] and cyrillic[3] in pii.GIVEN["cyrillic", "m"] and cyrillic[2] != "Петрова"
    counts = lambda r: {k: n for k, n in r.entities.asDict().items() if n}
    assert [counts(got[i]) for i in (0, 1, 4)] == [{"email": 3}, {"phone": 3}, {"name": 3}]
    again = {r.doc_id: r.text for r in pii.surrogates(docs, "k1").collect()}
    other = {r.doc_id: r.text for r in pii.surrogates(docs, "k2").collect()}
    assert again == {i: got[i].text for i in got} and other[0] != again[0]


def _luhn_fits(number):
    digits = [int(c) for c in reversed(number)]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def test_people_numbers_and_addresses_stay_what_they_are(spark):
    """One person under all forms of the name, one number under all its spellings, valid check digits, nobody's real name."""
    first = pii.surrogates(spark.createDataFrame([(1, "Mrs. Anna Berg")], "doc_id long, text string"), "k").first().text
    texts = ["Mrs. Anna Berg met Dr. Otto Klein. Anna Berg left; Anna Bergman and Berg stayed. Frau Berg called Prof. Anna Berg and Otto Klein.",
             first, "+44 20 7946 0958, 44 20 7946 0958 or 44-20-7946-0958 and +1 487 555 7209, 487-555-7209",
             "GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765432; 2001:DB8:0:0:8:800:200C:417A or fe80::1:2.", "4556737586899855 4556-7375-8689-9855",
             "a@one.com b@one.com c@two.net"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in pii.surrogates(docs, "k").collect()}
    people = re.fullmatch(r"Mrs\. (\S+) (\S+) met Dr\. (\S+) (\S+)\. (\S+) (\S+) left; Anna Bergman and Berg stayed\. Frau (\S+) called Prof\. (\S+) (\S+) and (\S+) (\S+)\.",
                          got[0].text)
    anna, berg, otto, klein = people.group(1, 2, 3, 4)
    assert people.group(5, 6, 7, 8, 9, 10, 11) == (anna, berg, berg, anna, berg, otto, klein) and len({anna, berg, otto, klein}) == 4
    assert first.split()[2] != berg != got[1].text.split()[2] and got[1].text != first        # a real family name of the corpus is nobody's stand-in
    uk, plain, odd, us, local = re.fullmatch(r"(\+44 \d\d \d{4} \d{4}), (44 \d\d \d{4} \d{4}) or (44-\d\d-\d{4}-\d{4}) and (\+1 \d{3} \d{3} \d{4}), (\d{3}-\d{3}-\d{4})", got[2].text).groups()
    digits = [re.sub(r"\D", "", x) for x in (uk, plain, odd, us, local)]
    assert digits[0] == digits[1] == digits[2] != "442079460958" and digits[3] == "1" + digits[4] != "14875557209"
    iban = re.match(r"(GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d) and (GB\d\d[A-Z]{4}\d{14}); (2001:db8:[0-9a-f:]+) or (2001:db8:[0-9a-f:]+)\.", got[3].text)
    account = iban[2]
    assert iban[1].replace(" ", "") == account and int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1 and iban[3] != iban[4]
    cards = got[4].text.split()
    assert cards[1].replace("-", "") == cards[0] != "4556737586899855" and _luhn_fits(cards[0])
    mails = got[5].text.split()
    assert len(set(mails)) == 3 and mails[0].endswith(".com") and mails[2].endswith(".net")


def test_names_stay_apart(spark):
    """More people than given names, and people named like likely stand-ins: as many names after as before, none of them real."""
    given, family = list(pii.GIVEN["latin", "f"]), ["Berg", "Klein", "Stone", "Badenfoker"]
    people = [f"Mrs. {a} {b}" for a in given + [g + "ina" for g in given] for b in family] + [f"Mr. {g} Berg" for g in ("Adam", "Anna", "Zeno")]
    docs = spark.createDataFrame([(i, f"{p} wrote.") for i, p in enumerate(people)], "doc_id long, text string").repartition(3)
    got = [r.text.removesuffix(" wrote.") for r in pii.surrogates(docs, "k").orderBy("doc_id").collect()]
    bare = [g.split(" ", 1)[1] for g in got]
    assert len(set(got)) == len(set(people)) and not {b.lower() for b in bare} & {p.split(" ", 1)[1].lower() for p in people}
    families = {}
    for p, g in zip(people, got):
        families.setdefault(p.rsplit(" ", 1)[1], set()).add(g.rsplit(" ", 1)[1])
    assert all(len(f) == 1 for f in families.values()) and len(set.union(*families.values())) == 4


def test_surrogates_stay_distinct_when_proposals_collide(spark):
    ones = spark.range(120).selectExpr("'phone' AS kind", "cast(10 + id % 60 as string) AS entity").distinct()
    got = pii.surrogate_table(ones.where("entity < '50'"), "k").collect()
    assert len(got) == 40 and len({r.surrogate for r in got}) == 40
    assert not {r.surrogate for r in got} & {r.entity for r in got}


def test_surrogates_of_odd_rows_and_a_table(spark):
    docs = cases.documents(spark)
    assert pii.surrogates(docs, "k").count() == docs.count() and pii.surrogates(cases.empty(spark), "k").count() == 0
    got = queries.op2_surrogates(spark, SF).collect()
    before = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    kinds = {k: re.compile(re.sub(r"\\p\{Lu\}", "[A-Z]", p).replace(r"\p{Ll}", "[a-z]").replace(r"\p{L}", "[A-Za-z]")) for k, p in pii.PATTERNS.items()}
    for r in got:
        found = {m.group() for k in ("email", "ip", "card", "phone") for m in kinds[k].finditer(before[r.doc_id])}
        assert not [m for m in found if m in r.text], (r.doc_id, found)
        assert r.text == before[r.doc_id] if not found else len(r.text.split("\n")) == len(before[r.doc_id].split("\n"))


def test_pipeline_equals_brute_force(spark):
    from pageframe.llm import packing, quality, secret_scan
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scans", "packing"]
    docs = table(spark, SF, "documents")
    columns, rule = docs.columns, quality.line_rule()
    want = {}
    for r in docs.collect():
        found = quality.examine(r.text.encode(), rule, quality.MAX_LOSS)
        if found[5]:
            want[r.doc_id] = b"\n".join(found[-1]).decode()
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, out, SF).collect(), docs.schema)
        assert out.columns == columns
        got = {r.doc_id: r.text for r in out.collect()}
        if name == "near_duplicates":
            same = brute.component_ids(list(want.items()))
            want = {d: t for d, t in want.items() if same[d][1] == d}
        if name == "benchmark_decontamination":
            items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
            want = {d: t for d, t in want.items() if not brute.contamination([(d, t)], items)[d][1]}
        if name == "secret_scans":
            assert got.keys() == want.keys()
            for d, t in want.items():
                assert bool(brute.base_secrets(t)) <= (got[d] != t) and not brute.base_secrets(got[d].replace("[SECRET]", "\n"))
            want = got
        assert got == want
    pieces = corpus_pipeline.STAGES[-1][1](spark, out, SF).collect()
    encode = packing.tokenizer(packing.VOCABULARY).encode_ordinary
    for d, t in want.items():
        ids = [x for p in sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.start) for x in p["ids"]]
        assert ids == encode(t) + [1]
    assert {p.doc_id for p in pieces} == set(want)
    run = corpus_pipeline.run(spark, SF)
    key = lambda p: (p.doc_id, p.start, p.length, p.ids_crc32)
    assert sorted(map(key, run.collect())) == sorted(map(key, pieces))


def test_pipeline_stages_on_odd_rows(spark):
    docs = cases.documents(spark)
    empty = cases.empty(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == empty.columns and docs.count() > 0 and stage(spark, empty, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
