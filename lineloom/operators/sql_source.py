"""SQL scripts cut into statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.functions import text
from lineloom.operators.lines import ends_open, numbered_lines
from lineloom.operators.segment import joined_lines, segment_lines
from lineloom.plans.scan import BLOCK, block_for, with_running
from lineloom.schemas import MAX_CHUNK_LINES

_STATEMENT = r"(?s).+?(?:;\s*\n|\z)"
_END = r";\s*\n\z"


def statements(files: DataFrame, *, split_statements: bool = True, block: int | None = None) -> DataFrame:
    """``file_path, n_lines, start_line, end_line, source`` per statement.

    A statement ends at a semicolon that white space and a line end follow. With
    ``split_statements=False`` a file is one statement. Files in parts (``sources.tree``)
    give the statements of their whole texts.
    """
    if "parts" in files.columns:
        whole = statements(_as_whole(files), split_statements=split_statements, block=block)
        return whole.unionByName(_cut_statements(files.where("parts > 1"), split_statements, block))
    block = block_for(files, text.newline_count(F.col("content")) + 1, block)
    body = files.select(
        "file_path", text.unify_newlines(F.col("content")).alias("content")
    )
    parts = (
        F.regexp_extract_all(F.col("content"), F.lit(_STATEMENT), F.lit(0))
        if split_statements
        else F.array("content")
    )
    pieces = body.select(
        "file_path",
        (text.newline_count(F.col("content")) + 1).alias("n_lines"),
        F.posexplode(parts).alias("position", "part"),
    )
    placed = with_running(
        pieces,
        ["file_path"],
        ["position"],
        sums={"lines_before": text.newline_count(F.col("part"))},
        block=block,
        spans_blocks=F.col("n_lines") >= block,
    )
    cut = F.regexp_replace("part", _END, "") if split_statements else F.col("part")
    lead = text.newline_count(F.col("part")) - text.newline_count(F.ltrim("part", F.lit(text.WHITE_SPACE)))
    return (
        placed.withColumn("source", text.strip(cut))
        .where(F.col("source") != "")
        .withColumn("start_line", (F.col("lines_before") + lead + 1).cast("int"))
        .select(
            "file_path",
            "n_lines",
            "start_line",
            (F.col("start_line") + text.newline_count(F.col("source"))).alias("end_line"),
            "source",
        )
    )


def _as_whole(files: DataFrame) -> DataFrame:
    return files.where("parts = 1").drop("part", "parts")


def _cut_statements(files: DataFrame, split_statements: bool, block: int | None) -> DataFrame:
    """Statements of files in parts, from their lines: a line that ends with a semicolon ends
    its statement, unless the file ends there without a line end."""
    lines = numbered_lines(files)
    ends = F.col("source").rlike(r";\s*\z") if split_statements else F.lit(False)
    counted = with_running(
        lines, ["file_path"], ["line_no"], sums={"number": ends.cast("int")}, block=block or BLOCK, spans_blocks=F.lit(True)
    )
    blank = text.is_blank(F.col("source"))
    found = counted.groupBy("file_path", "n_lines", "number").agg(
        F.min(F.when(~blank, F.col("line_no"))).alias("start_line"),
        F.max("line_no").alias("last_line"),
        joined_lines().alias("source"),
    )
    open_end = ends_open(files).select("file_path", F.lit(True).alias("open"))
    kept = (F.col("last_line") == F.col("n_lines")) & F.coalesce("open", F.lit(False)) if split_statements else F.lit(True)
    cut = F.when(kept, F.col("source")).otherwise(F.regexp_replace("source", r";\s*\z", ""))
    return (
        found.join(open_end, "file_path", "left")
        .withColumn("source", text.strip(cut))
        .where(F.col("source") != "")
        .select(
            "file_path",
            (F.col("n_lines") + F.col("open").isNull().cast("int")).alias("n_lines"),
            "start_line",
            (F.col("start_line") + text.newline_count(F.col("source"))).alias("end_line"),
            "source",
        )
    )


def chunks(
    files: DataFrame,
    *,
    limit: int = MAX_CHUNK_LINES,
    split_statements: bool = True,
    block: int | None = None,
) -> DataFrame:
    """A chunk per statement, in numbered pieces where it is long."""
    if "parts" in files.columns:
        block = block or BLOCK
    block = block_for(files, text.newline_count(F.col("content")) + 1, block)
    found = statements(files, split_statements=split_statements, block=block)
    is_long = F.col("end_line") - F.col("start_line") >= limit
    short = found.where(~is_long).withColumn("chunk_no", F.lit(1))
    long_lines = found.where(is_long).select(
        "file_path",
        "n_lines",
        F.col("start_line").alias("span_start"),
        F.posexplode(F.split("source", "\n")).alias("i", "source"),
    ).select(
        "file_path", "n_lines", "span_start", (F.col("span_start") + F.col("i")).alias("line_no"), "source"
    )
    pieces = segment_lines(
        long_lines, ["file_path", "span_start"], text.COMMENT_MARKS["sql"], limit=limit, block=block
    ).select(
        "file_path",
        "n_lines",
        F.col("piece_start").alias("start_line"),
        F.col("piece_end").alias("end_line"),
        "source",
        "chunk_no",
    )
    return short.unionByName(pieces).select(
        "file_path",
        F.lit("sql_statement").alias("type"),
        F.concat(F.lit("statement_part_"), F.col("chunk_no")).alias("name"),
        "chunk_no",
        "start_line",
        "end_line",
        "source",
    )
