"""Packing by power-of-two decomposition: pieces of binary lengths, one sequence each, no padding."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pageframe.llm.common import arrow_map

END_ID = 1
MAX_LENGTH = 2048
VOCABULARY = "byte_bpe_50k.tiktoken"   # the ranks of byte_bpe_50k.json: equal ids, a third of the time
ADDED = "byte_bpe_50k.json"     # its added tokens, which the rank file does not have
BLANKS = 100_000                       # white space in a row beyond which a text is encoded by the JSON tokenizer


def tokenizer(vocabulary: str):
    """Encoder of a public vocabulary, built once per worker process."""
    import base64

    import public_tokenizers
    import tiktoken
    from tiktoken import registry

    name = f"pageframe:{vocabulary}"
    if name not in registry.ENCODINGS:
        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        registry.ENCODINGS[name] = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return registry.ENCODINGS[name]


def added_tokens(vocabulary: str) -> dict:
    """{string: id} of the tokens that a tokenizer file adds to its vocabulary."""
    import json

    import public_tokenizers

    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    odd = [t["content"] for t in found if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if odd:
        raise ValueError(f"added tokens that are more than their string: {odd}")
    return {t["content"]: t["id"] for t in found}


def json_tokenizer(vocabulary: str):
    """The slower encoder of the same vocabulary, built once per worker process; added tokens are ordinary text."""
    import public_tokenizers
    from tokenizers import Tokenizer

    if vocabulary not in _JSON:
        _JSON[vocabulary] = Tokenizer.from_file(str(public_tokenizers.path(vocabulary)))
        _JSON[vocabulary].encode_special_tokens = True
    return _JSON[vocabulary]


_JSON: dict = {}


def encoder(vocabulary: str, added: dict):
    """Text to ids: the strings of `added` are one id each, what lies between them is encoded by itself.

    The fast encoder's splitting pattern backtracks over white space and ends the worker where a run of it is very
    long: texts with more than BLANKS in a row go through the JSON tokenizer, whose ids are the same.
    """
    import re

    fast, long_blank = tokenizer(vocabulary).encode_ordinary, re.compile(rf"\s{{{BLANKS}}}").search

    def encode(text):
        if len(text) >= BLANKS and long_blank(text):
            return json_tokenizer(vocabulary.removesuffix(".tiktoken") + ".json").encode(text, add_special_tokens=False).ids
        return fast(text)

    if not added:
        return encode
    split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split

    def ids_of(text):
        parts = split(text)
        if len(parts) == 1:
            return encode(text)
        return [i for k, part in enumerate(parts) for i in ([added[part]] if k % 2 else encode(part))]

    return ids_of


def lengths(n: int, limit: int = MAX_LENGTH) -> list[int]:
    """n as full pieces of `limit` (a power of two), then the binary digits of the rest, largest first."""
    rest = n % limit
    return [limit] * (n // limit) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, *, with_ids: bool = True, limit: int = MAX_LENGTH, end_id: int = END_ID,
         vocabulary: str = VOCABULARY, added: str | None = None) -> DataFrame:
    """One row per piece of every document: a training sequence whose length is a power of two.

    A document's ids are those of its whole text and `end_id`.  They are cut at the binary digits of
    their number, so each piece fills its sequence exactly, no sequence holds two documents and none
    is padded.  `length` is the bucket: batches of one bucket need no padding either
    (`write_buckets`).  No shuffle: pieces stay where the document was read.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (0: a piece starts its
    sequence) and, `with_ids`, the ids.  A null or empty text is `end_id` alone; repeated rows are
    packed once per row; other columns of `docs` are not read.  With `added` (a tokenizer file, such
    as ADDED) the strings of its added tokens are those tokens, as its own encoder has it; without, they
    are ordinary text.
    """
    tokens = added_tokens(added) if added else {}
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def cut(batch):
        import zlib

        import numpy as np
        import pyarrow as pa

        encode = encoder(vocabulary, tokens)
        rows, pieces, crcs, ids_of = [], [], [], []
        for text in batch.column("text").to_pylist():
            ids = encode(text) if text else []
            ids.append(end_id)
            sizes = lengths(len(ids), limit)
            raw = memoryview(np.array(ids, dtype="<u4").tobytes())
            rows.append(len(ids))
            pieces.append(sizes)
            at = 0
            for size in sizes:
                crcs.append(zlib.crc32(raw[4 * at:4 * (at + size)]))
                at += size
            if with_ids:
                ids_of.append(np.frombuffer(raw, dtype="<i4"))
        count = np.array([len(p) for p in pieces])
        length = np.concatenate([np.array(p, dtype=np.int64) for p in pieces])
        total = np.repeat(np.array(rows, dtype=np.int64), count)
        ends = np.cumsum(length)
        first = np.repeat(np.cumsum(rows) - rows, count)
        columns = {
            "doc_id": batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(rows)), count))),
            "start": ends - length - first, "length": length, "ids_crc32": np.array(crcs, dtype=np.int64),
            "doc_tokens": total}
        if with_ids:
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids_of)))
        return pa.RecordBatch.from_pydict(columns)

    pieces = arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut, schema)
    return (pieces.withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the sequences by bucket; every task writes its own files, so no bucket meets in one task."""
    pieces.write.partitionBy("length").parquet(path)
