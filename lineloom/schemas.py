"""Every fixed schema, and the limits that act as operator parameters."""

from __future__ import annotations

from pyspark.sql import types as T

MAX_TOKENS = 8192
MAX_CHUNK_LINES = 80
CONTEXT_LINES = 10
VECTOR_DIM = 1536
TOP_K = 10

ERROR = T.StructType(
    [T.StructField("source", T.StringType()), T.StructField("error", T.StringType())]
)
ERRORS = T.ArrayType(ERROR)

SOURCE_FILE = T.StructType(
    [
        T.StructField("file_path", T.StringType(), False),
        T.StructField("ext", T.StringType(), False),
        T.StructField("content", T.StringType(), False),
    ]
)

CHUNK = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("chunk_no", T.IntegerType()),
        T.StructField("start_line", T.IntegerType()),
        T.StructField("end_line", T.IntegerType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("errors", ERRORS),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

LINE = T.StructType(
    [
        T.StructField("line_id", T.StringType()),
        T.StructField("parent_type", T.StringType()),
        T.StructField("parent_method", T.StringType()),
        T.StructField("file_line_no", T.IntegerType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

STORED_LINE = T.StructType(LINE.fields + [T.StructField("created_at", T.TimestampType())])

FRAME = T.StructType(
    [
        T.StructField("class", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("line", T.IntegerType()),
        T.StructField("is_user_code", T.BooleanType()),
    ]
)

PAYLOAD = ["type", "name", "chunk_no", "start_line", "end_line", "file_path", "source"]

GRAPH_NODE = T.StructType(
    [
        T.StructField("node_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("line_number", T.IntegerType()),
        T.StructField("line_end", T.IntegerType()),
    ]
)

GRAPH_EDGE = T.StructType(
    [
        T.StructField("src", T.StringType()),
        T.StructField("dst", T.StringType()),
        T.StructField("kind", T.StringType()),
    ]
)
