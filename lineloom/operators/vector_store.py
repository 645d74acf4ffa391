"""The vector collection: checks, upserts and exact cosine search."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineloom.functions import vectors as V
from lineloom.operators.quality import is_clean
from lineloom.schemas import PAYLOAD, TOP_K
from lineloom.session import staged

# Rows of a block of points and of a block of queries; a task holds one of each and their
# scores (at 1536 dimensions some 36 MB), whatever the numbers of both.
POINT_ROWS, QUERY_ROWS = 2048, 512
# Query blocks that a block of points meets in one join key.
MEETING = 8
ROUNDED = 6


def points(chunks: DataFrame) -> DataFrame:
    """Error-free chunks with a vector, as ``chunk_id, embedding`` and payload."""
    ready = chunks.where(is_clean() & F.col("embedding").isNotNull())
    return ready.select("chunk_id", F.col("embedding").cast("array<float>").alias("embedding"), *PAYLOAD)


def check_dim(points_df: DataFrame, dim: int) -> DataFrame:
    """Add ``error``: null where the vector has ``dim`` values."""
    size = F.coalesce(F.size("embedding"), F.lit(0))
    wrong = F.concat(F.lit(f"expected {dim} values, got "), size)
    return points_df.withColumn("error", F.when(size != dim, wrong))


def upsert(current: DataFrame, incoming: DataFrame, key: str = "chunk_id", version: str | None = None) -> DataFrame:
    """The collection after the upsert: an incoming point replaces one of the same id.

    Among incoming points of one id the highest ``version`` wins. The latest point
    is an aggregate, so copies of one id are folded before the shuffle.
    """
    columns = [c for c in current.columns if c != version]

    def ranked(df: DataFrame, source: int) -> DataFrame:
        v = F.col(version) if version and version in df.columns else F.lit(0)
        return df.select(F.struct(F.lit(source).alias("s"), v.cast("bigint").alias("v")).alias("rank"), *columns)

    both = ranked(current, 0).unionByName(ranked(incoming, 1))
    row = F.struct(*[c for c in columns if c != key])
    latest = both.groupBy(key).agg(F.max_by(row, F.col("rank")).alias("row"))
    return latest.select(key, "row.*").select(*columns)


def search(points_df: DataFrame, query: Sequence[float], k: int = TOP_K, key: str = "chunk_id") -> DataFrame:
    """The ``k`` points nearest to one query vector, best first, ties by id.

    One scan; every task keeps its own best ``k``.
    """
    length = float(np.sqrt(np.dot(query, query)))
    if length == 0:
        raise ValueError("the query vector has no direction")
    vector, own = V.literal(query), V.as_double(F.col("embedding"))
    size = F.sqrt(V.dot(own, own)) * F.lit(length)
    scored = points_df.withColumn("score", F.when(size > 0, F.round(V.dot(own, vector) / size, ROUNDED)))
    return scored.where(F.col("score").isNotNull()).drop("embedding").orderBy(F.desc("score"), F.asc(key)).limit(k)


def _packed(df: DataFrame, key: str, rows: int, name: str) -> DataFrame:
    """Unit vectors in blocks: ``dim``, the keys as a list, the matrix as bytes. Vectors that
    are null or have no length are left out."""
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField(f"{name}_keys", T.ArrayType(kind)), T.StructField(f"{name}_rows", T.BinaryType())])
    vectors = df.select(key, V.as_double(F.col("embedding")).alias("v")).where(F.col("v").isNotNull() & F.exists("v", lambda x: x != 0))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list[tuple]] = {}

        def block(dim: int) -> pd.DataFrame:
            keys, matrix = zip(*held.pop(dim))
            unit = np.stack(matrix)
            unit = unit / np.sqrt((unit * unit).sum(axis=1))[:, None]
            return pd.DataFrame({"dim": [dim], f"{name}_keys": [list(keys)], f"{name}_rows": [unit.tobytes()]})

        for frame in frames:
            for one, vector in zip(frame[key], frame["v"]):
                held.setdefault(len(vector), []).append((one, np.asarray(vector, dtype=np.float64)))
                if len(held[len(vector)]) == rows:
                    yield block(len(vector))
        for dim in list(held):
            yield block(dim)

    return vectors.mapInPandas(pack, schema)


def search_batch(
    points_df: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    *,
    key: str = "chunk_id",
    query_key: str = "query_id",
    point_rows: int = POINT_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The ``k`` nearest points of every query: ``query_id, rank, key, score``.

    Points and queries are packed into blocks. Blocks meet by an equi-join, so a task
    holds one pair of blocks and keeps ``k`` per query; nothing grows with both numbers,
    and nothing passes the driver but the number of query blocks. Ties go to the smaller
    key. Query ids are unique; vectors of other lengths than the query's are no candidates.
    """
    asked = staged(_packed(queries, query_key, query_rows, "query"))
    buckets = -(-asked.count() // MEETING) or 1
    asked = asked.withColumn("bucket", F.pmod(F.xxhash64("query_rows"), F.lit(buckets)).cast("int"))
    held = _packed(points_df, key, point_rows, "point").withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    schema = T.StructType([queries.schema[query_key], points_df.schema[key], T.StructField("score", T.DoubleType())])

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                keys = np.asarray(row.point_keys)
                scores = np.round(np.frombuffer(row.query_rows).reshape(-1, row.dim) @ np.frombuffer(row.point_rows).reshape(-1, row.dim).T, ROUNDED)
                taken = min(k, len(keys))
                least = np.partition(scores, len(keys) - taken, axis=1)[:, len(keys) - taken]
                found = []
                for number, query_id in enumerate(row.query_keys):
                    near = np.flatnonzero(scores[number] >= least[number])
                    near = near[np.lexsort((keys[near], -scores[number, near]))][:taken]
                    found.append(pd.DataFrame({query_key: query_id, key: keys[near], "score": scores[number, near]}))
                yield pd.concat(found)

    found = held.join(asked, ["bucket", "dim"]).drop("bucket").mapInPandas(best, schema)
    order = Window.partitionBy(query_key).orderBy(F.desc("score"), F.asc(key))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(query_key, "rank", key, "score")
