"""Connected components of a table of links, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.llm.stage import Stage


def _stars(edges: DataFrame, tasks: int) -> bool:
    """Whether every ``u`` hangs under one ``v``, and no ``v`` under another."""
    hung = edges.groupBy("u").agg(F.count("*").alias("n")).coalesce(tasks)
    return hung.filter("n > 1").select("u").union(hung.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi").coalesce(tasks)).isEmpty()


#: Links of one task.
TASK_LINKS = 200_000


def components(links: DataFrame, stage: Stage, name: str) -> DataFrame:
    """``id`` and ``root`` (the least id reachable) for every id in ``links`` (``a``, ``b``).

    Each round hangs every id under the least neighbour it knows, first the larger ones
    (large star), then the smaller ones (small star). Rounds grow with the logarithm of
    the longest chain. Only minima are aggregated, so a node with very many links is
    combined before it is shuffled and never gathered. Every round is a written table.
    """
    edges = stage.keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), f"{name}-0")
    # every round has as many edges at most: no more tasks than they need
    tasks = -(-edges.count() // TASK_LINKS) or 1
    turn = 0
    while not _stars(edges, tasks):
        turn += 1
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = stage.keep(small.filter("u <> v").coalesce(tasks).distinct().coalesce(tasks), f"{name}-{turn}")
        stage.drop(f"{name}-{turn - 1}")
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("id"), "root")
    return stage.keep(roots.union(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()), name)
