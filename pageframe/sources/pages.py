"""Reading page corpora and exchanging pages and node tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.serialize import to_html
from ..schema import NODE_COLUMNS

FORMATS = ("parquet", "orc", "json", "csv", "csv_lines", "text", "binaryFile")


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet", encoding: str = "UTF-8", check: bool = False) -> DataFrame:
    """pages(page_id, url, html).  ``text`` and ``binaryFile`` read one page per file and key it by a hash of its path.

    ``csv`` may hold line breaks in fields, which makes a file one task; ``csv_lines`` has one record a line, so that
    files split: line breaks and backslashes in fields are escaped, as :func:`write_pages` does.  ``check`` adds
    ``error``, see :func:`checked`."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown page format: {fmt}")
    if fmt == "text":
        files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("html"))
        out = files.select(F.xxhash64("url").alias("page_id"), "url", "html")
    elif fmt == "binaryFile":
        files = spark.read.format("binaryFile").load(path)
        out = files.select(F.xxhash64("path").alias("page_id"), F.col("path").alias("url"),
                           F.decode("content", encoding).alias("html"))
    else:
        reader = spark.read.format(fmt.removesuffix("_lines"))
        if fmt in ("json", "csv", "csv_lines"):
            reader = reader.schema("page_id long, url string, html string")
        if fmt == "csv":
            reader = reader.options(header=True, multiLine=True, escape='"')
        if fmt == "csv_lines":
            reader = reader.options(**CSV)
        out = reader.load(path).select("page_id", "url", "html")
        if fmt == "csv_lines":
            out = out.select("page_id", unescaped("url").alias("url"), unescaped("html").alias("html"))
    return checked(out) if check else out


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table as a stream, whether it is one file or a folder of files.

    A stream of a plain path must name a folder, and its filter of names meets the files inside; a pattern that only
    this path matches takes both."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def checked(pages: DataFrame) -> DataFrame:
    """Pages with ``error``: a row whose page_id is null, or is that of another row too, has its reason there and no html.

    Page-keyed operators take a page_id for one page; with this, rows that break the rule (paths with equal hashes, a
    page given twice) are reported by every operator instead of being mixed.  Only page_ids are counted and only those
    that repeat are joined back."""
    again = pages.groupBy("page_id").agg(F.count("*").alias("_n")).where("_n > 1 AND page_id IS NOT NULL")
    rows = pages.join(again, "page_id", "left")
    error = F.when(F.col("page_id").isNull(), "page_id is null").when(F.col("_n").isNotNull(), "page_id repeats")
    return rows.withColumn("error", error).withColumn("html", F.when(F.col("error").isNull(), F.col("html"))).select(*pages.columns, "error")


# Settings of csv_lines, for writing and reading.
CSV = {"header": True, "escape": '"', "quote": '"', "nullValue": "\\N"}


def escaped(name: str) -> Column:
    """A field on one line: backslash, line feed and carriage return as two characters each."""
    out = F.replace(F.col(name), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescaped(name: str) -> Column:
    pieces = F.split(F.col(name), r"\\\\", -1)
    line = lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.array_join(F.transform(pieces, line), "\\")


def write_pages(nodes: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                pages: DataFrame | None = None) -> None:
    """Serialise each page's tree and write (page_id, html, error).

    A page that could not be shredded is written with null html and the reason, never as an empty page.
    ``csv_lines`` has one line a page (page_id, url, html, error).  With ``pages``, the table the nodes come from, a page whose nodes are all gone is written as ''."""
    out, options = to_html(nodes, pages, errors=True), {}
    if fmt == "csv_lines":
        fmt = "csv"
        out, options = out.select("page_id", F.lit(None).cast("string").alias("url"), escaped("html").alias("html"), "error"), CSV
    out.write.format(fmt).options(**options).mode(mode).save(path)


def write_nodes(nodes: DataFrame, table: str, buckets: int, path: str | None = None, mode: str = "errorifexists") -> None:
    """Store nodes bucketed by page and sorted in document order: later page-keyed operators read
    the table without any shuffle.  Pre-clustering keeps one file per bucket."""
    writer = (nodes.select("page_id", *NODE_COLUMNS).repartition(buckets, "page_id")
              .write.bucketBy(buckets, "page_id").sortBy("page_id", "pre").mode(mode))
    (writer.option("path", path) if path else writer).saveAsTable(table)


def read_nodes(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
