"""Pair what opens a span with what closes it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.plans.scan import BLOCK, with_running


def match_closes(events: DataFrame, block: int = BLOCK) -> DataFrame:
    """Give each open event the ``close`` of the next close event at its level.

    ``events``: ``file_path, n_lines, level, line_no, place, opened, closed_at``. An
    open has a non-null ``opened`` struct, a close a non-null ``closed_at``. ``place``
    orders events of one line. Opens and closes of one level alternate, so the
    next close is the matching one.
    """
    matched = with_running(
        events,
        ["file_path", "level"],
        ["line_no", "place"],
        lasts={"close": F.col("closed_at")},
        reverse=True,
        block=block,
        spans_blocks=F.col("n_lines") >= block,
    )
    return matched.where(F.col("opened").isNotNull()).select(
        "file_path", "n_lines", "opened.*", "close"
    )
