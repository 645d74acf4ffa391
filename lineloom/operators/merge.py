"""Fold small chunks into the chunk before them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineloom.functions import text
from lineloom.plans.scan import BLOCK, with_running


def merge_groups(
    chunks: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    kind: str = "content_class",
    block: int = BLOCK,
) -> DataFrame:
    """Number the merged chunks: adds ``merged_no`` and drops what vanishes.

    Empty and comment chunks vanish. A normal chunk starts a merged chunk; tiny and
    brace chunks join the one before. With nothing before it, a tiny chunk starts
    one and a brace vanishes. So the number of normal chunks so far names the
    merged chunk.
    """
    left = chunks.where(~F.col(kind).isin("empty", "trivial_comment"))
    normal = (F.col(kind) == "normal").cast("int")
    counted = with_running(
        left,
        keys,
        order,
        sums={"normals": normal},
        lasts={"met": F.when(F.col(kind) != "brace", F.lit(True))},
        block=block,
    )
    return (
        counted.where((F.col(kind) != "brace") | F.col("met"))
        .withColumn("merged_no", F.col("normals") + normal)
        .drop("normals", "met")
    )


def merge_small(
    chunks: DataFrame,
    keys: Sequence[str] = ("file_path",),
    order: Sequence[str] = ("span_start", "place", "start_line"),
    block: int = BLOCK,
) -> DataFrame:
    """Merged chunks with type, name, number and start of their first part.

    Texts are joined by one newline, all but the last right-stripped; the end line
    never moves backwards though spans may nest.
    """
    classed = chunks.withColumn("content_class", text.content_class(F.col("source"))["class"])
    grouped = merge_groups(classed, keys, order, block=block)
    # First the text of each run of pieces within one block of lines of a span, in tasks by
    # block, then the runs of a merged chunk; so one class that fills a huge file is many tasks' work.
    *spans, piece = order
    run = F.floor(F.col(piece) / F.lit(block or BLOCK)).alias("_run")
    rank = F.struct(*order)
    runs = grouped.groupBy(*keys, "merged_no", *spans, run).agg(
        F.min(rank).alias("_rank"),
        F.min_by(F.struct("type", "name", "chunk_no", "start_line"), rank).alias("first"),
        F.max("end_line").alias("end_line"),
        joined_parts(rank, F.col("source")).alias("source"),
    )
    return (
        runs.groupBy(*keys, "merged_no")
        .agg(
            F.min_by("first", "_rank").alias("first"),
            F.max("end_line").alias("end_line"),
            joined_parts(F.col("_rank"), F.col("source")).alias("source"),
        )
        .select(*keys, "first.*", "end_line", "source")
    )


def joined_parts(rank: Column, source: Column) -> Column:
    """Texts of a group in order, all but the last right-stripped. None of them is blank, so
    texts put together so far can be put together again."""
    parts = F.array_sort(F.collect_list(F.struct(rank.alias("o"), source.alias("s"))))
    last = F.size(parts) - 1
    return F.array_join(F.transform(parts, lambda p, i: F.when(i < last, text.rstrip(p["s"])).otherwise(p["s"])), "\n")
