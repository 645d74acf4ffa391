"""Range joins as equi-joins on small position blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 64


def join_covering(
    points: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str],
    position: str,
    start: str,
    end: str,
    how: str = "inner",
    width: int | None = WIDTH,
) -> DataFrame:
    """Join points with the ranges ``[start, end]`` that cover them.

    Both sides meet on the keys and on the block of ``width`` positions, so a hot
    key spreads over many join partitions and a pair is only tried where the two
    are near each other. Columns of ``ranges`` must differ from those of
    ``points``, the keys aside. The block stays in the result as ``_at``: grouping by
    keys, ``_at`` and position needs no further shuffle. Without a ``width`` they meet on the
    keys alone, for rows that lie by these and have few positions to a key.
    """
    if width is None:
        right = ranges.withColumnsRenamed({k: f"_r_{k}" for k in keys})
        on = (F.col(position) >= F.col(start)) & (F.col(position) <= F.col(end))
        for k in keys:
            on = on & (F.col(k) == F.col(f"_r_{k}"))
        return points.join(right.hint("merge"), on, how).drop(*[f"_r_{k}" for k in keys]).withColumn("_at", F.lit(0))
    left = points.withColumn("_at", F.floor(F.col(position) / F.lit(width)))
    right = ranges.withColumn(
        "_at",
        F.explode(
            F.sequence(F.floor(F.col(start) / F.lit(width)), F.floor(F.col(end) / F.lit(width)))
        ),
    )
    for k in [*keys, "_at"]:
        right = right.withColumnRenamed(k, f"_r_{k}")
    on = (F.col(position) >= F.col(start)) & (F.col(position) <= F.col(end))
    for k in [*keys, "_at"]:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(right, on, how).drop("_r__at", *[f"_r_{k}" for k in keys])


def join_innermost(
    points: DataFrame,
    ranges: DataFrame,
    key: str,
    position: str,
    start: str,
    end: str,
    told: Callable[[Column], dict[str, Column]],
    how: str = "inner",
    then: dict[str, Column] | None = None,
) -> DataFrame:
    """Join points with what ``told`` makes of the array of all ranges (structs of their
    columns but the key) that cover them.

    The ranges of a key are cut at every start and end into pieces that do not overlap, so
    ``told`` is worked out once a piece and a point meets one piece. So is what ``then`` makes of
    these columns, which take the place of them. All ranges of a key are one array: for short files only.
    """
    others = [c for c in ranges.columns if c != key]
    whole = ranges.groupBy(key).agg(F.collect_list(F.struct(*others)).alias("_all"))
    cuts = F.concat(F.transform("_all", lambda r: r[start]), F.transform("_all", lambda r: r[end] + 1))
    cut = whole.withColumn("_cuts", F.array_sort(F.array_distinct(cuts))).select(
        key, "_all", "_cuts", F.posexplode("_cuts").alias("_no", "_from")
    )
    covering = F.filter("_all", lambda r: (r[start] <= F.col("_from")) & (r[end] >= F.col("_from")))
    met = cut.select(key, "_from", (F.get("_cuts", F.col("_no") + 1) - 1).alias("_to"), covering.alias("_on")).where(F.size("_on") > 0)
    values = told(F.col("_on"))
    pieces = met.select(F.col(key).alias("_key"), "_from", "_to", *[v.alias(n) for n, v in values.items()])
    if then is not None:
        pieces = pieces.select("_key", "_from", "_to", *[v.alias(n) for n, v in then.items()])
    on = (F.col(key) == F.col("_key")) & F.col(position).between(F.col("_from"), F.col("_to"))
    return points.join(pieces.hint("merge"), on, how).drop("_key", "_from", "_to")
