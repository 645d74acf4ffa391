"""Bounded samples of labelled texts for fitting, and the fold of a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Values of the hash that orders rows.
TURNS = 1 << 40


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def sampled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, each: int) -> tuple[DataFrame, float]:
    """At most ``each`` training rows of either label, as ``text, label`` in a fixed order, and
    the share of label 1 among all labelled training rows.

    Rows are taken in the order of a hash of their id and text, so the sample does not
    depend on how the input is dealt out. Ids are chosen first; only the texts of the chosen
    are read. Labels that are null, or differ between rows of one id, are left out.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other")).filter("label = other")
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(TURNS))
    known = known.filter(fold(F.col("doc_id"), folds) != held).select("doc_id", "label", turn.alias("turn"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # the first rows by turn lie below this bound: half as many more than are asked for are
    # expected there, so what is ranked is small whatever the number of rows
    for number, n in counts.items():
        known = known.filter((F.col("label") != number) | (F.col("turn") < int(TURNS * min(1.0, 1.5 * (each + 100) / n))))
    order = Window.partitionBy("label").orderBy("turn", "doc_id")
    chosen = known.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= each).select("doc_id", "label")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    taken = rows.withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id", "text"))))
    taken = taken.filter(F.col("place") <= each).orderBy("label", F.xxhash64("doc_id", "text")).select("text", "label")
    total = sum(counts.values())
    return taken, (counts.get(1, 0) / total if total else 0.5)


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, each: int) -> tuple[list[tuple[str, int]], float]:
    """The rows of ``sampled``, as (text, label), and its share."""
    taken, share = sampled(docs, labels, label, folds, held, each)
    return [(r["text"] or "", r["label"]) for r in taken.collect()], share
