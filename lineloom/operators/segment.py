"""Cut spans of lines into bounded pieces and join their text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineloom.functions import text
from lineloom.plans.ranges import join_covering
from lineloom.plans.scan import WHOLE, block_for, by_length, with_running
from lineloom.schemas import MAX_CHUNK_LINES


def joined_lines(order: str = "line_no", source: str = "source", separator: str = "\n") -> Column:
    """The sources of one group in line order. Groups are bounded by the caller."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(source).alias("s"))))
    return F.array_join(F.transform(rows, lambda r: r["s"]), separator)


def closes_piece(source: Column, mark: str) -> Column:
    return text.is_blank(source) | text.starts_with_mark(source, mark)


def piece_start(first: Column, last_break: Column, line_no: Column, limit: int) -> Column:
    """First line of the piece that holds ``line_no`` in a span that starts at ``first``.

    A piece ends at a closing line or at ``limit`` lines. So pieces begin right
    after the last closing line, or at the span's start, and then every
    ``limit`` lines: no fold along the span is needed.
    """
    base = F.greatest(first, F.coalesce(last_break + 1, first))
    return base + F.floor((line_no - base) / F.lit(limit)) * F.lit(limit)


def _pieces(rows: DataFrame, span: Sequence[str], drop_blank: bool, block: int, in_place: bool = False) -> DataFrame:
    """Group lines to pieces and number the pieces of a span from 1."""
    group = [*span, "n_lines", "piece_start"]
    at = F.lit(0) if block == WHOLE else F.floor(F.col("piece_start") / F.lit(block))
    placed = rows.withColumn("_block", at)
    if not in_place:
        # One shuffle serves the grouping and the numbering: both keep to spans and blocks.
        placed = placed.repartition(*span, *([] if block == WHOLE else ["_block"]))
    grouped = placed.groupBy(*group, "_block").agg(F.max("line_no").alias("piece_end"), joined_lines().alias("source"))
    if drop_blank:
        grouped = grouped.where(~text.is_blank(F.col("source")))
    numbered = with_running(
        grouped,
        span,
        ["piece_start"],
        sums={"_before": F.lit(1)},
        block=block,
        spans_blocks=F.col("n_lines") >= block,
    )
    return numbered.withColumn("chunk_no", (F.col("_before") + 1).cast("int")).drop("_before")


def span_pieces(
    lines: DataFrame,
    spans: DataFrame,
    mark: str,
    *,
    limit: int = MAX_CHUNK_LINES,
    drop_blank: bool = False,
    block: int | None = None,
) -> DataFrame:
    """Text of every span; spans longer than ``limit`` lines come in pieces.

    ``spans`` has ``file_path, span_start, span_end`` plus columns that tell spans
    apart, all kept. Spans may nest; a line then counts for each span around it. Where
    ``spans`` has ``n_lines``, too, and no block is given, the lines of short files stay where
    they lie by file.
    """
    if "n_lines" not in spans.columns:
        block = block_for(lines, block=block)
    return by_length(lines, spans, block, lambda *of: _span_pieces(*of, mark, limit, drop_blank))


def _span_pieces(lines: DataFrame, spans: DataFrame, block: int, short: bool, mark: str, limit: int, drop_blank: bool) -> DataFrame:
    spans = spans.drop("n_lines")
    broken = with_running(
        lines.select("file_path", "n_lines", "line_no", "source"),
        ["file_path"],
        ["line_no"],
        lasts={"_break": F.when(closes_piece(F.col("source"), mark), F.col("line_no"))},
        block=block,
        spans_blocks=F.col("n_lines") >= block,
    )
    width = {"width": None} if short else {}
    inside = join_covering(broken, spans, ["file_path"], "line_no", "span_start", "span_end", **width)
    is_short = F.col("span_end") - F.col("span_start") < limit
    start = F.when(is_short, F.col("span_start")).otherwise(
        piece_start(F.col("span_start"), F.col("_break"), F.col("line_no"), limit)
    )
    rows = inside.withColumn("piece_start", start.cast("int"))
    return _pieces(rows, spans.columns, drop_blank, block, in_place=short)


def segment_lines(
    lines: DataFrame,
    keys: Sequence[str],
    mark: str,
    *,
    limit: int = MAX_CHUNK_LINES,
    drop_blank: bool = False,
    block: int | None = None,
) -> DataFrame:
    """Pieces of lines that are a span by themselves: one span per ``keys``.

    ``lines`` has the keys, ``n_lines, span_start, line_no, source``.
    """
    block = block_for(lines, block=block)
    broken = with_running(
        lines,
        keys,
        ["line_no"],
        lasts={"_break": F.when(closes_piece(F.col("source"), mark), F.col("line_no"))},
        block=block,
        spans_blocks=F.col("n_lines") >= block,
    )
    start = piece_start(F.col("span_start"), F.col("_break"), F.col("line_no"), limit)
    rows = broken.withColumn("piece_start", start.cast("int"))
    return _pieces(rows, [*keys, "span_start"], drop_blank, block)
