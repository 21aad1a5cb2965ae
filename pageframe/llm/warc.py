"""WARC archives as a PySpark data source: `warc` reads and writes WARC/1.1, plain or gzipped record by record.

Reading plans one partition for each stretch of an archive, parses the headers of a record first, tests the
predicates that Spark pushed down on them, and passes over the block of a record that is not wanted: by a seek in a
plain archive, and in a gzipped one whose members tell their length (`sl` extra field, as this writer gives it).
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import datasource as S

# --- fixed values ---------------------------------------------------------------------------------
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
           "refers_to_uri": "WARC-Refers-To-Target-URI"}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --------------------------------------------------------------------------------------------------
SCHEMA = ("file string, position long, " + ", ".join(f"{c} string" for c in HEADERS) +
          ", block_bytes long, http_status int, payload_bytes long, headers map<string,string>, payload binary")
FILE_BYTES = 256 << 20    # an archive is closed at this size
SPLIT_BYTES = 32 << 20    # stretches of an archive that one task reads
BATCH_BYTES = 8 << 20
_CHUNK = 1 << 16
_LONGEST_HEAD = 1 << 20


def place(path: str):
    """File system and path of a folder that driver and executors share, by its scheme."""
    from pyarrow import fs

    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


class _Stream:
    """The bytes of an archive from a position on, inflated where it is gzipped."""

    def __init__(self, file, at: int, gzipped: bool):
        self.file, self.gzipped, self.left = file, gzipped, b""
        self.inflater, self.start, self.end = None, at, None
        file.seek(at)

    def position(self) -> int:
        """Where the next record starts: its byte in a plain archive, its member in a gzipped one."""
        if not self.gzipped:
            return self.file.tell() - len(self.left)
        return self.start if self.left else self.file.tell()

    def member(self) -> bool:
        """Open the next gzip member; its length is known if it has an `sl` field."""
        self.start, self.end = self.file.tell(), None
        head = self.file.read(10)
        if len(head) < 10:
            return False
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {self.start}")
        flags = head[3]
        if flags & 4:
            extra = self.file.read(struct.unpack("<H", self.file.read(2))[0])
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    self.end = self.start + struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size:]
        for bit in (8, 16):
            while flags & bit and self.file.read(1) not in (b"\0", b""):
                pass
        if flags & 2:
            self.file.read(2)
        self.inflater = zlib.decompressobj(-15)
        return True

    def more(self) -> bytes:
        """The next bytes, none at the end of the archive."""
        if not self.gzipped:
            return self.file.read(_CHUNK)
        while True:
            if self.inflater is None and not self.member():
                return b""
            packed = self.file.read(_CHUNK if self.end is None else min(_CHUNK, max(0, self.end - 8 - self.file.tell())))
            out = self.inflater.decompress(packed)
            if self.inflater.eof:
                self.file.seek(8 - len(self.inflater.unused_data), 1)
                self.inflater = None
            elif not packed:
                raise ValueError(f"the gzip member at byte {self.start} ends early")
            if out:
                return out

    def head(self) -> bytes:
        """Bytes up to an empty line, without it."""
        while b"\r\n\r\n" not in self.left:
            if len(self.left) > _LONGEST_HEAD:
                raise ValueError("headers without an end")
            got = self.more()
            if not got:
                raise ValueError("the archive ends within headers")
            self.left += got
        found, self.left = self.left.split(b"\r\n\r\n", 1)
        return found

    def ended(self) -> bool:
        """Whether no record follows; passes over the line ends between records."""
        while True:
            self.left = self.left.lstrip(b"\r\n")
            if self.left:
                return False
            self.left = self.more()
            if not self.left:
                return True

    def take(self, n: int) -> bytes:
        parts, have = [self.left], len(self.left)
        while have < n:
            got = self.more()
            if not got:
                raise ValueError("the archive ends within a block")
            parts.append(got)
            have += len(got)
        whole = b"".join(parts)
        self.left = whole[n:]
        return whole[:n]

    def drop(self, n: int) -> None:
        """Pass over the rest of a record's block without reading it where that can be done."""
        if self.gzipped and self.end is not None:
            self.file.seek(self.end)
            self.inflater, self.left = None, b""
        elif not self.gzipped and n > len(self.left):
            self.file.seek(n - len(self.left), 1)
            self.left = b""
        else:
            while n > len(self.left):
                n -= len(self.left)
                self.left = self.more()
                if not self.left:
                    raise ValueError("the archive ends within a block")
            self.left = self.left[n:]


def _fields(lines: bytes) -> dict:
    """Header fields; a folded line goes on with the field before, a repeated field keeps its first value."""
    out, last = {}, None
    for line in lines.split(b"\r\n"):
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and last:
            out[last] += " " + text.strip()
        elif ":" in text:
            name, value = text.split(":", 1)
            last = name.strip().lower() if name.strip().lower() not in out else None
            if last:
                out[last] = value.strip()
    return out


def _row(file: str, at: int, fields: dict) -> dict:
    row = {"file": file, "position": at, **{c: fields.get(h.lower()) for c, h in HEADERS.items()},
           "block_bytes": int(fields.get("content-length", 0)), "headers": list(fields.items())}
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
    return row


def fits(test, row: dict) -> bool:
    """Whether a row passes a filter that Spark pushed down; null passes IsNull and null-safe equality only."""
    if isinstance(test, S.Not):
        inner = test.child
        return (isinstance(inner, (S.IsNull, S.EqualNullSafe)) or row[inner.attribute[0]] is not None) and not fits(inner, row)
    value = row[test.attribute[0]]
    if isinstance(test, S.IsNull):
        return value is None
    if isinstance(test, S.EqualNullSafe):
        return value == test.value
    if isinstance(test, S.IsNotNull) or value is None:
        return value is not None
    if isinstance(test, S.In):
        return value in [v for v in test.value if v is not None]
    if isinstance(test, (S.StringStartsWith, S.StringEndsWith, S.StringContains)):
        return {S.StringStartsWith: value.startswith, S.StringEndsWith: value.endswith, S.StringContains: value.__contains__}[type(test)](test.value)
    if test.value is None:
        return False
    return {S.EqualTo: value == test.value, S.GreaterThan: value > test.value, S.GreaterThanOrEqual: value >= test.value,
            S.LessThan: value < test.value, S.LessThanOrEqual: value <= test.value}[type(test)]


_TESTS = (S.EqualTo, S.EqualNullSafe, S.GreaterThan, S.GreaterThanOrEqual, S.LessThan, S.LessThanOrEqual, S.IsNull, S.IsNotNull,
          S.StringStartsWith, S.StringEndsWith, S.StringContains)
_TESTED = {*HEADERS, "file", "position", "block_bytes"}


def _known(test) -> bool:
    if isinstance(test, S.Not):
        return not isinstance(test.child, (S.Not, S.In)) and _known(test.child)
    return isinstance(test, (*_TESTS, S.In)) and len(test.attribute) == 1 and test.attribute[0] in _TESTED


class Stretch(S.InputPartition):
    def __init__(self, file: str, start: int, end: int | None):
        self.file, self.start, self.end = file, start, end


class WarcReader(S.DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload, self.tests = options["path"], options.get("payload", "true").lower() == "true", []

    def pushFilters(self, filters):
        for test in filters:
            if _known(test):
                self.tests.append(test)
            else:
                yield test

    def partitions(self):
        """Archives listed by the writer's commits in their stretches; without a commit, each archive as a whole."""
        from pyarrow import fs

        store, root = place(self.path)
        infos = [i for i in store.get_file_info(fs.FileSelector(root)) if i.is_file]
        listed = [f for i in infos if re.fullmatch(r"_files-.*\.json", i.base_name) for f in _listing(store, i.path)]
        if any(i.base_name.startswith("_files-") for i in infos):
            return [Stretch(f"{root}/{f['name']}", a, b) for f in listed for a, b in zip(f["starts"], [*f["starts"][1:], None])]
        return [Stretch(i.path, 0, None) for i in infos if re.search(r"\.warc(\.gz)?$", i.base_name)]

    def read(self, partition) -> Iterator:
        import pyarrow as pa

        if partition is None:
            return
        kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "map<string,string>": pa.map_(pa.string(), pa.string())}
        schema = pa.schema([(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in SCHEMA.split(", ")])
        store, _ = place(self.path)
        rows, size = [], 0
        with store.open_input_file(partition.file) as raw:
            for row in self.records(io.BufferedReader(raw, _CHUNK), partition):
                rows.append(row)
                size += 1000 + len(row["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def records(self, file, part: Stretch) -> Iterator[dict]:
        gzipped = file.read(2) == b"\x1f\x8b" if part.start == 0 else part.file.endswith(".gz")
        stream, name = _Stream(file, part.start, gzipped), part.file.rsplit("/", 1)[-1]
        while True:
            if stream.ended():
                return
            at = stream.position()
            if part.end is not None and at >= part.end:
                return
            try:
                version, _, lines = stream.head().partition(b"\r\n")
                if not version.startswith(b"WARC/"):
                    raise ValueError("no WARC record")
                row = _row(name, at, _fields(lines))
                wanted = all(fits(t, row) for t in self.tests)
                left = row["block_bytes"]
                if wanted:
                    left -= self.block(stream, row)
                    yield row
                stream.drop(left)
            except ValueError as e:
                raise ValueError(f"{part.file} at byte {at}: {e}") from e

    def block(self, stream: _Stream, row: dict) -> int:
        """Fill in what the block of a wanted record holds; the bytes of it that were read."""
        size, row["http_status"], row["payload_bytes"], row["payload"] = row["block_bytes"], None, row["block_bytes"], None
        used = 0
        if (row["content_type"] or "").startswith("application/http") and size:
            lines = stream.head()
            used = len(lines) + 4
            status, _, rest = lines.partition(b"\r\n")
            code = re.match(rb"HTTP/\S+ (\d{3})", status)
            row["http_status"] = int(code.group(1)) if code else None
            row["payload_bytes"] = size - used
            if row["record_type"] == "revisit":      # its payload is elsewhere, its length in the HTTP header
                length = _fields(rest).get("content-length", "")
                row["payload_bytes"] = int(length) if length.isdigit() else None
        if self.payload and row["record_type"] != "revisit":
            row["payload"] = stream.take(size - used)
            used = size
        return used


def _listing(store, path: str) -> list:
    with store.open_input_stream(path) as f:
        return json.loads(f.read())["files"]


class Written(S.WriterCommitMessage):
    def __init__(self, files: list):
        self.files = files


class WarcWriter(S.DataSourceArrowWriter):
    """A task writes archives under names of its own; the commit lists those of the tasks that count."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.gzipped = options.get("compression", "gzip") == "gzip"
        self.file_bytes, self.split_bytes = int(options.get("file_bytes", FILE_BYTES)), int(options.get("split_bytes", SPLIT_BYTES))

    def write(self, iterator):
        store, root = place(self.path)
        store.create_dir(root, recursive=True)
        files, out, at = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    files.append({"name": f"part-{uuid.uuid4().hex}.warc{'.gz' * self.gzipped}", "starts": [0], "records": 0})
                    out, at = store.open_output_stream(f"{root}/{files[-1]['name']}", compression=None), 0
                raw = record(row)
                raw = member(raw) if self.gzipped else raw
                if at - files[-1]["starts"][-1] >= self.split_bytes:
                    files[-1]["starts"].append(at)
                out.write(raw)
                at += len(raw)
                files[-1]["records"] += 1
                if at >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        from pyarrow import fs

        store, root = place(self.path)
        store.create_dir(root, recursive=True)
        old = [i.path for i in store.get_file_info(fs.FileSelector(root)) if i.base_name.startswith("_files-")] if self.overwrite else []
        gone = [f"{root}/{f['name']}" for path in old for f in _listing(store, path)]
        with store.open_output_stream(f"{root}/_files-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps({"files": [x for m in messages if m for x in m.files]}).encode())
        for path in old + gone:
            store.delete_file(path)

    def abort(self, messages):
        store, root = place(self.path)
        for name in [x["name"] for m in messages if m for x in m.files]:
            store.delete_file(f"{root}/{name}")


class WarcSource(S.DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options), overwrite)


def _line(value) -> str:
    """A header value on one line: controls as percent escapes."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda c: f"%{ord(c.group()):02X}", str(value))


def record(row: dict) -> bytes:
    """One WARC record with an HTTP block; a revisit has the HTTP header only, with the length of its payload."""
    import base64
    import hashlib

    payload = row.get("payload")
    payload = payload.encode("utf-8", "surrogatepass") if isinstance(payload, str) else payload or b""
    revisit = row["record_type"] == "revisit"
    size = row["payload_bytes"] if revisit else len(payload)
    digest = row.get("payload_digest") or base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (b"" if revisit else payload)
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row.get("date") or "1970-01-01T00:00:00Z"),
              ("WARC-Target-URI", row.get("target_uri")), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("WARC-Profile", REVISIT if revisit else None), ("WARC-Refers-To", row.get("refers_to")),
              ("WARC-Refers-To-Target-URI", row.get("refers_to_uri")), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{name}: {_line(value)}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 6) -> bytes:
    """A gzip member whose `sl` extra field tells its length."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(raw) + squeeze.flush()
    size = 10 + 2 + 12 + len(body) + 8
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, size, len(raw) & 0xFFFFFFFF) + body
            + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF))


def register(spark: SparkSession) -> None:
    """Make `spark.read.format("warc")` known, with predicates pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives in a folder; `payload=False` leaves every payload undecoded and null.

    Predicates on the columns of HEADERS, file, position and block_bytes are tested before a record's block is read.
    A broken archive ends the job with its name and byte; records without a field have null there.
    """
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def write(records: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Write rows (record_type, record_id, payload; target_uri, date, payload_bytes, payload_digest, refers_to, refers_to_uri
    where known) as archives in a folder; other columns are not written.  Options: compression, file_bytes, split_bytes."""
    register(records.sparkSession)
    wanted = ["record_type", "record_id", "payload", "payload_bytes", "payload_digest", "target_uri", "date", "refers_to", "refers_to_uri"]
    writer = records.select(*[c for c in wanted if c in records.columns]).write.format("warc").mode(mode)
    writer.options(**{k: str(v) for k, v in options.items()}).save(path)


def base32(sha1: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hexadecimal."""
    fives = [F.conv(F.substring(sha1, at, 10), 16, 10).cast("long") for at in (1, 11, 21, 31)]
    return F.concat(*[F.lit(BASE32).substr((F.shiftright(v, s).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for v in fives for s in range(35, -1, -5)])


def page_name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("-")), F.lit(">"))


def page_number(record_id: Column) -> Column:
    return F.regexp_extract(record_id, "^<urn:x-page:(.*)>$", 1).try_cast("long")


def page_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """A record for each page (page_id, url, html).

    Of pages with equal payloads of at least `least` bytes, that with the smallest page_id is a response and the
    others are revisits of it; smaller ones are all responses.  A null html is an empty payload.  A null page_id is
    never referred to: such a page revisits an equal one with a page_id, or is a response.  Rows that repeat the
    smallest page_id are all responses.  A null url leaves the header out; controls in it are percent-escaped.
    Only payloads that come more than once are named in the join, by their digest.
    """
    raw = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("raw"))
    raw = raw.withColumn("digest", F.unhex(F.sha1("raw")))
    again = (raw.where(F.octet_length("raw") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where("n > 1 AND first IS NOT NULL").select("digest", "first"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return raw.join(again, "digest", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), page_name(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"), F.octet_length("raw").cast("long").alias("payload_bytes"), base32(F.hex("digest")).alias("payload_digest"),
        F.when(revisit, page_name(F.col("first"))).alias("refers_to"), F.when(~revisit, F.col("raw")).alias("payload"))


def page_report(records: DataFrame, heads: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of archived pages: responses by their decoded
    payloads, revisits by their headers alone."""
    whole = records.where("record_type = 'response'").select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.sha1("payload")).alias("payload_digest"), "record_type", "refers_to")
    others = heads.where("record_type = 'revisit'").select("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return whole.union(others).select(page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                      page_number(F.col("refers_to")).alias("refers_to"))
