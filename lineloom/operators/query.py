"""SQL over the tables, documented look-ups, result views and retrieval by text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.functions import vectors as V
from lineloom.operators import vector_store
from lineloom.schemas import PAYLOAD, TOP_K

# What stands for no context, and between snippets.
NO_CONTEXT = "No initial context found."
CONTEXT_SEPARATOR = "\n---\n"
CONTEXT_SNIPPETS = 5


def sql_query(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run one query over the named tables; anything but a query is refused.

    The text must also stand as a subquery, which no statement that writes can.
    """
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    statement = sql.strip().rstrip(";")
    spark.sql(f"SELECT * FROM (\n{statement}\n)")
    return spark.sql(statement)


def stored_lines(context: DataFrame) -> DataFrame:
    """Lines with context in the layout of the ``lines`` table, ids included."""
    line_id = F.sha2(F.concat_ws("|", F.lit("line"), "file_path", F.col("line_no").cast("string"), "source"), 256)
    return context.select(
        line_id.alias("line_id"),
        "parent_type",
        "parent_method",
        F.col("line_no").alias("file_line_no"),
        "file_path",
        "source",
    )


def lines_of_file(lines: DataFrame, file_path: str) -> DataFrame:
    return lines.where(F.col("file_path") == file_path).orderBy("file_line_no")


def lines_of_method(lines: DataFrame, method: str) -> DataFrame:
    return lines.where(F.col("parent_method") == method).orderBy("file_path", "file_line_no")


def lines_like(lines: DataFrame, pattern: str) -> DataFrame:
    """LIKE without regard to case, as the documented look-up expects."""
    return lines.where(F.col("source").ilike(pattern))


def dash(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("-"))


def line_view(lines: DataFrame) -> DataFrame:
    return lines.select(
        dash(F.col("file_path")).alias("file_path"),
        "file_line_no",
        dash(F.col("parent_type")).alias("parent_type"),
        dash(F.col("parent_method")).alias("parent_method"),
        dash(F.col("source")).alias("source"),
    )


def chunk_view(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        dash(F.col("file_path")).alias("file_path"),
        "chunk_no",
        F.concat_ws(" - ", F.col("start_line").cast("string"), F.col("end_line").cast("string")).alias("lines"),
        dash(F.col("type")).alias("type"),
        dash(F.col("name")).alias("name"),
        dash(F.col("source")).alias("source"),
    )


def payloads(hits: DataFrame) -> DataFrame:
    return hits.select(*PAYLOAD)


def semantic_search(
    points: DataFrame, text: str, dim: int, k: int = TOP_K, key: str = "chunk_id"
) -> DataFrame:
    """Search hashed vectors by the hashed text of a query."""
    one_row = points.sparkSession.range(1).select(V.hashed_text(F.lit(text), dim).alias("v"))
    return vector_store.search(points, one_row.first()["v"], k, key)


def retrieval_context(
    questions: DataFrame,
    points: DataFrame,
    sources: DataFrame,
    *,
    key: str = "chunk_id",
    query_key: str = "query_id",
    k: int = CONTEXT_SNIPPETS,
) -> DataFrame:
    """Per question the ``k`` best snippets, best first, joined to one ``context`` text.

    ``questions``: ``query_id, embedding``; ``sources``: ``chunk_id, source``.
    """
    hits = vector_store.search_batch(points, questions, k, key=key, query_key=query_key)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "source")))
    snippets = (
        hits.join(sources.select(key, "source"), key)
        .groupBy(query_key)
        .agg(F.array_join(F.transform(ordered, lambda r: r["source"]), CONTEXT_SEPARATOR).alias("found"))
    )
    return questions.select(query_key).join(snippets, query_key, "left").select(
        query_key, F.coalesce("found", F.lit(NO_CONTEXT)).alias("context")
    )
