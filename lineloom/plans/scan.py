"""Running values along ordered groups, without one task per group.

A plain window over ``partitionBy(file)`` puts a whole file into one task. That is
fine where every file is known to be short, and ``block_for`` checks it. Beyond
that a group is cut into blocks of consecutive positions: the window runs inside a
block, and each block receives what the blocks before it add up to. The second
part reads only the groups longer than one block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


# Block size that stands for "no blocks": every group is known to be short.
WHOLE = 0


# Files of fewer lines are short: what they declare may be one array.
SHORT = 1_024


def by_length(lines: DataFrame, spans: DataFrame, block: int | None, work: Callable[..., DataFrame]) -> DataFrame:
    """``work(lines, spans, block, short)`` over the short files and, where there are any, over the
    others, so that a long file does not change how short ones are worked on. Files do not
    meet in ``work``. A given block is that of all files."""
    if block is not None:
        return work(lines, spans, block, False)
    longest = lines.agg(F.max("n_lines")).first()[0] or 0
    if longest < SHORT:
        return work(lines, spans, WHOLE, True)
    few, many = F.col("n_lines") < SHORT, F.col("n_lines") >= SHORT
    short = work(lines.where(few), spans.where(few), WHOLE, True)
    return short.unionByName(work(lines.where(many), spans.where(many), BLOCK if longest >= BLOCK else WHOLE, False))


def block_for(rows: DataFrame, lines: Column | None = None, block: int | None = None) -> int:
    """``WHOLE`` where no file has ``BLOCK`` lines, else ``BLOCK``; a given block stays.

    ``lines`` is the line count of a row's file, by default the column ``n_lines``.
    """
    if block is not None:
        return block
    longest = rows.agg(F.max(F.col("n_lines") if lines is None else lines)).first()[0]
    return BLOCK if (longest or 0) >= BLOCK else WHOLE


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    reverse: bool = False,
    block: int = BLOCK,
    spans_blocks: Column | None = None,
) -> DataFrame:
    """Add, per row, values over the rows before it in its group.

    ``order[0]`` is an integer position; it also decides the block. ``sums`` are
    running sums and ``lasts`` the latest non-null values, both *without* the
    current row. With ``reverse`` the walk goes from the end to the start, so a
    "last" value is the next one in text order. ``spans_blocks`` must hold for
    every row of a group that reaches beyond one block. A ``_block`` column that
    ``df`` already has, and may be partitioned by, is used and dropped.
    """
    sums, lasts = sums or {}, lasts or {}
    ordering = [F.desc(c) if reverse else F.asc(c) for c in order]
    if block == WHOLE:
        window = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
        return df.select(
            *[c for c in df.columns if c != "_block"],
            *[F.coalesce(F.sum(e).over(window), F.lit(0)).alias(n) for n, e in sums.items()],
            *[F.last(e, ignorenulls=True).over(window).alias(n) for n, e in lasts.items()],
        )

    blocked = df
    if "_block" not in df.columns:
        blocked = df.withColumn("_block", F.floor(F.col(order[0]) / F.lit(block)))
    window = (
        Window.partitionBy(*keys, "_block")
        .orderBy(*ordering)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = blocked.select(
        "*",
        *[F.sum(e).over(window).alias(f"_sum_{n}") for n, e in sums.items()],
        *[F.last(e, ignorenulls=True).over(window).alias(f"_last_{n}") for n, e in lasts.items()],
    )

    # What each block contributes, then what all earlier blocks contribute.
    long_groups = blocked if spans_blocks is None else blocked.where(spans_blocks)
    place = F.struct(*order)
    pick = F.min_by if reverse else F.max_by
    totals = long_groups.groupBy(*keys, "_block").agg(
        F.lit(1).alias("_one"),
        *[F.sum(e).alias(f"_sum_{n}") for n, e in sums.items()],
        *[pick(e, F.when(e.isNotNull(), place)).alias(f"_last_{n}") for n, e in lasts.items()],
    )
    across = (
        Window.partitionBy(*keys)
        .orderBy(F.desc("_block") if reverse else F.asc("_block"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        *keys,
        "_block",
        F.sum("_one").over(across).alias("_earlier"),
        *[F.sum(f"_sum_{n}").over(across).alias(f"_carry_sum_{n}") for n in sums],
        *[
            F.last(f"_last_{n}", ignorenulls=True).over(across).alias(f"_carry_last_{n}")
            for n in lasts
        ],
    ).where(F.col("_earlier") > 0)

    def total(n: str) -> Column:
        zero = F.lit(0)
        return F.coalesce(F.col(f"_sum_{n}"), zero) + F.coalesce(F.col(f"_carry_sum_{n}"), zero)

    return local.join(carried, [*keys, "_block"], "left").select(
        *[local[c] for c in df.columns if c != "_block"],
        *[total(n).alias(n) for n in sums],
        *[F.coalesce(F.col(f"_last_{n}"), F.col(f"_carry_last_{n}")).alias(n) for n in lasts],
    )
