"""Licence scan by canonical digests: whole texts and whole lines against the digests of known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pageframe.llm.common import row_key, saved, without

# Equivalent spellings, applied in this order to canonical text.
SPELLINGS = (("licence", "license"), ("sub license", "sublicense"), ("sub licence", "sublicense"), ("favour", "favor"),
             ("organisation", "organization"), ("acknowledgement", "acknowledgment"), ("per cent", "percent"),
             ("copyright holder", "copyright owner"), ("non commercial", "noncommercial"), ("whilst", "while"),
             ("merchantibility", "merchantability"), ("centre", "center"))

# Notices and licences by SPDX identifier, and whether they restrict use in training.
KNOWN = (
    ("GPL-3.0-only", True, "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", True, "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", False, "Licensed under CC BY 4.0."),
    ("MIT", False, "Released under the MIT License."),
    ("MIT", False, "Licensed under the MIT License."),
    ("Apache-2.0", False, "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", False, "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", True, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", False, "This work is dedicated to the public domain under CC0 1.0."),
    ("MIT", False, """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", False, """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
)

_COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright[ \t]*(?:\(c\)|©|by|:|[0-9])|\(c\)[ \t]|©|all rights reserved)[^\n]*$"
_MARKS = r"[^\p{L}\p{N}\n]+"


def plain(text: Column) -> Column:
    """Lower case, copyright lines gone, punctuation and blanks one space; line breaks stay."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), _COPYRIGHT_LINE, ""), _MARKS, " ")


def spelled(words: Column) -> Column:
    """Equivalent spellings made one."""
    for old, new in SPELLINGS:
        words = F.replace(words, F.lit(old), F.lit(new))
    return words


def whole_of(plain_text: Column) -> Column:
    """The canonical text on one line."""
    return spelled(F.trim(F.regexp_replace(plain_text, r"\s+", " ")))


def lines_of(plain_text: Column) -> Column:
    """The canonical lines that have a word, trimmed."""
    return F.filter(F.transform(F.split(spelled(plain_text), "\n"), lambda line: F.trim(line)), lambda line: line != "")


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license_id, restricted): one row per known text; its size is that of the fixed list."""
    rows = spark.createDataFrame([(i, r, t) for i, r, t in known], "license_id string, restricted boolean, text string")
    digest = F.sha2(whole_of(plain(F.col("text"))), 256)
    return rows.select(digest.alias("digest"), "license_id", "restricted").dropDuplicates(["digest"])


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id and per document: digest, license_id, notices, n_notices and restricted.

    digest is the SHA-256 of the whole canonical text, license_id the known licence whose text it is (else
    null); notices are the ascending ids of licences whose whole canonical text is a line of the document,
    n_notices their lines; restricted tells whether any of them restricts use.  Texts are read
    once and stay where they are: their digests are written, and meet the known ones in a hash join whose small
    side is the fixed list (`known`, if given, is broadcast only under Spark's own size limit).

    A null or empty text, or one of copyright lines alone, has the digest of the empty text and no licence.
    Repeated rows give one row each.  Other columns than doc_id and text are not read.
    """
    fixed = known is None
    known = known_digests(docs.sparkSession) if fixed else known
    lookup = F.broadcast(known) if fixed else known
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("_key"),
                       plain(F.coalesce("text", F.lit(""))).alias("_plain"))
    digests = saved(read.select("doc_id", "_key", F.sha2(whole_of(F.col("_plain")), 256).alias("digest"),
                                F.transform(lines_of(F.col("_plain")), lambda line: F.unhex(F.sha2(line, 256))).alias("_digests")), "digests")
    matched = (digests.select("_key", F.posexplode("_digests").alias("_line", "_digest"))
               .join(lookup.withColumn("_digest", F.unhex("digest")).drop("digest"), "_digest")
               .dropDuplicates(["_key", "_line"]).groupBy("_key")
               .agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"),
                    F.count("*").alias("n_notices"), F.max("restricted").alias("_by_line")))
    whole = lookup.select("digest", "license_id", F.col("restricted").alias("_whole"))
    return (digests.drop("_digests").join(whole, "digest", "left").join(matched, "_key", "left")
            .select("doc_id", "digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices"),
                    F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
                    F.coalesce(F.greatest("_by_line", "_whole"), F.lit(False)).alias("restricted")))


def keep_unrestricted(docs: DataFrame) -> DataFrame:
    """The documents without a restricting licence, with all their columns; rows are named by id and text."""
    bad = scan_keys(docs)
    base = without(docs, "_key").withColumn("_key", row_key())
    return base.join(bad, "_key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns if c != "_key"])


def scan_keys(docs: DataFrame) -> DataFrame:
    """Keys of the documents that a restricting licence covers, as a whole or by a line."""
    read = docs.select(row_key().alias("_key"), plain(F.col("text")).alias("_plain"))
    lines = lines_of(F.col("_plain"))
    restricted = F.broadcast(known_digests(docs.sparkSession).where("restricted"))
    every = F.concat(F.array(F.sha2(whole_of(F.col("_plain")), 256)), F.transform(lines, lambda line: F.sha2(line, 256)))
    return read.select("_key", F.explode(every).alias("digest")).join(restricted, "digest").select("_key").distinct()
