"""Table layouts shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

ATTRS = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
]))

# Fields emitted by the tree kernel, one struct per node.
#
# ``pre`` / ``last`` / ``depth`` number the whole page, template contents included, so that a
# subtree is the interval [pre, last] and its markup is a contiguous slice of the page.
# ``tree_id`` separates template contents (> 0) from the page proper (0).
KERNEL_NODE = T.StructType([
    T.StructField("tree_id", T.IntegerType()),
    T.StructField("node_id", T.IntegerType()),
    T.StructField("parent_id", T.IntegerType()),
    T.StructField("owner_id", T.IntegerType()),
    T.StructField("pre", T.IntegerType()),
    T.StructField("last", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("sib_idx", T.IntegerType()),
    T.StructField("elem_idx", T.IntegerType()),
    T.StructField("elem_cnt", T.IntegerType()),
    T.StructField("type_idx", T.IntegerType()),
    T.StructField("type_cnt", T.IntegerType()),
    T.StructField("node_type", T.StringType()),
    T.StructField("ns", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("attrs", ATTRS),
    T.StructField("in_svg", T.BooleanType()),
    T.StructField("preserve_ws", T.BooleanType()),
    T.StructField("in_body", T.BooleanType()),
    T.StructField("raw_text", T.BooleanType()),
])

NODE_COLUMNS = [f.name for f in KERNEL_NODE.fields] + ["id", "classes"]

PAGE = "page_id"
TREE = ["page_id", "tree_id"]
NODE_KEY = ["page_id", "tree_id", "node_id"]

CHUNKS = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("chunk", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])
