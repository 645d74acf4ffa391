"""Markup pages cut at tags and at double blank lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.functions import text
from lineloom.operators.lines import ends_open, numbered_lines
from lineloom.operators.segment import joined_lines
from lineloom.plans.scan import BLOCK, block_for, with_running

# Fixed value: openings that begin a new chunk.
TAG = r"(?i)^\s*<(%|jsp:|custom:|script|!--)"


def chunks(files: DataFrame, *, tag_boundaries: bool = True, block: int | None = None) -> DataFrame:
    """Chunks of type ``jsp``; line terminators stay in the text.

    A chunk begins at a line that opens one of the tags, or at the second of two
    blank lines. ``tag_boundaries=False`` keeps the second rule only.
    """
    if "parts" in files.columns:
        rows = _terminated(files.where("parts = 1")).unionByName(_cut_terminated(files.where("parts > 1"), block or BLOCK))
        block = block or BLOCK
    else:
        block = block_for(files, text.newline_count(F.col("content")) + 1, block)
        rows = _terminated(files)
    line, before = F.col("source"), F.col("before")
    boundary = text.is_blank(line) & text.is_blank(before)
    if tag_boundaries:
        boundary = boundary | line.rlike(TAG)
    marked = rows.select(
        "file_path",
        "n_lines",
        "line_no",
        "source",
        (before.isNotNull() & boundary).cast("int").alias("boundary"),
    )
    numbered = with_running(
        marked,
        ["file_path"],
        ["line_no"],
        sums={"earlier": F.col("boundary")},
        block=block,
        spans_blocks=F.col("n_lines") >= block,
    ).withColumn("chunk_no", (F.col("earlier") + F.col("boundary") + 1).cast("int"))
    return numbered.groupBy("file_path", "chunk_no").agg(
        F.lit("jsp").alias("type"),
        F.lit(None).cast("string").alias("name"),
        F.min("line_no").alias("start_line"),
        F.max("line_no").alias("end_line"),
        joined_lines(separator="").alias("source"),
    )


def _terminated(files: DataFrame) -> DataFrame:
    """Lines with their line ends, and the line ``before`` each, inside the file's row."""
    body = files.select(
        "file_path", text.unify_newlines(F.col("content")).alias("content")
    )
    return body.select(
        "file_path",
        F.regexp_extract_all(F.col("content"), F.lit(r"[^\n]*\n|[^\n]+"), F.lit(0)).alias("lines"),
    ).select(
        "file_path",
        F.size("lines").alias("n_lines"),
        F.posexplode(
            F.arrays_zip(
                F.col("lines").alias("line"),
                F.concat(F.array(F.lit(None).cast("string")), F.slice("lines", 1, F.size("lines") - 1)).alias("before"),
            )
        ).alias("i", "l"),
    ).select("file_path", "n_lines", (F.col("i") + 1).alias("line_no"), F.col("l.line").alias("source"), F.col("l.before").alias("before"))


def _cut_terminated(files: DataFrame, block: int) -> DataFrame:
    """The same of files in parts (``sources.tree``): the line before may be in another part."""
    lines = numbered_lines(files).join(ends_open(files).withColumn("open", F.lit(True)), "file_path", "left")
    last = (F.col("line_no") == F.col("n_lines")) & F.col("open").isNotNull()
    ended = lines.select(
        "file_path", "n_lines", "line_no", F.when(last, F.col("source")).otherwise(F.concat("source", F.lit("\n"))).alias("source")
    )
    return with_running(
        ended, ["file_path"], ["line_no"], lasts={"before": F.col("source")}, block=block, spans_blocks=F.lit(True)
    )
