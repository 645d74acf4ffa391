"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions alone.

Sources in code-point order, null last, weigh ``WEIGHTS``, repeating, and share ``PERCENT`` of
all words. A source gives at most ``EPOCHS`` times its words; what it cannot give is shared
anew by weight among the others: sorted by the level at which each would be full, running sums
tell which are.

Each source is then taken whole as often as its target holds it, and the rest comes from a
weighted sample without replacement: a document's key is an exponential variable divided by
its quality weight, documents are taken from the least key on until the prefix sum of their words
reaches the rest, the last of them only with its first words, so that a source is taken to the
word. The exponential variable comes from a hash of the id: reruns agree.

A source may hold most of all rows, so it is never sorted as a whole. Keys are cut, in their
order, into ``ceil(documents / BUCKET)`` buckets a source; words are summed by bucket and
prefix-summed over buckets. Only the bucket in which the rest ends has to be sorted: buckets before
it are taken, buckets behind it are not. Texts are read once, for sizes and weights; all
later steps read a narrow table.

Defined results: null and empty texts have 0 words and take 0; rows without id share one key,
ties go by size, and rows that are equal in both are exchangeable; repeated rows are
documents of their own. An empty table, or one without words, gives targets of 0. Sources are
one row each in the table of targets, which is sorted as one. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineloom.llm.stage import Stage

WEIGHTS = (5, 2, 1)
#: Words of the mix in percent of all words; how often a source is taken at most.
PERCENT, EPOCHS = 150, 2
#: Documents of a bucket of keys, on average.
BUCKET = 8192
WORD = r"[^\x20\x09-\x0D]+"
#: Least weight of a document; letters, as a share, that make up text of full weight.
LEAST_WEIGHT, FULL_LETTERS = 0.1, 0.75


def quality_weight(text: Column) -> Column:
    """From ``LEAST_WEIGHT`` to 1: the share of letters in the text, up to ``FULL_LETTERS``."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    share = F.coalesce(letters / F.nullif(F.length(text), F.lit(0)), F.lit(0.0))
    return F.greatest(F.lit(LEAST_WEIGHT), F.least(F.lit(1.0), share / FULL_LETTERS))


def _uniform(doc_id: Column) -> Column:
    """A number above 0 and below 1 from the first 52 bits of a hash of the id."""
    told = F.sha2(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return (F.conv(F.substring(told, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """``source``, ``docs``, ``source_size``, ``mean_key`` and ``target`` from rows of ``source``, ``size`` and ``key``."""
    sources = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"), F.avg("key").alias("mean_key"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    most = F.lit(epochs) * F.col("source_size")
    sources = sources.withColumn("weight", weight.cast("long")).withColumn("most", most)

    level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    # in hundredths of words: what is left once all before are full, and who is left to share it
    left = F.lit(percent) * F.sum("source_size").over(whole) - 100 * F.coalesce(F.sum("most").over(before), F.lit(0))
    sharing = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    sources = sources.withColumns({"left": left, "sharing": sharing, "turn": F.row_number().over(level)})
    full = F.lit(100.0) * F.col("most") * F.col("sharing") <= F.col("weight") * F.col("left")
    # the sources that are not full share what is left at the first of them
    sources = sources.withColumn("full", full)
    sources = sources.withColumn("open", F.min(F.when(~F.col("full"), F.struct("turn", "left", "sharing"))).over(whole))
    shared = F.col("weight") * F.col("open.left") / (100 * F.col("open.sharing"))
    target = F.when(F.col("full") | F.col("open").isNull(), F.col("most").cast("double")).otherwise(shared)
    return sources.select("source", "docs", "source_size", "mean_key", target.alias("target"))


def mixed(docs: DataFrame, weight: Column | None = None) -> DataFrame:
    """For each row its ``size``, its source's ``source_size`` and ``target``, the complete
    ``copies`` and the words ``taken`` with repeats. ``weight`` is the quality weight of a row of
    ``docs``, above 0; by default that of its text."""
    stage = Stage(docs.sparkSession, "source-mix")
    weight = quality_weight(F.col("text")) if weight is None else weight
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = -F.ln(_uniform(F.col("doc_id"))) / weight
    rows = stage.keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("source"), size.alias("size"), key.alias("key")), "sizes")

    sources = targets(rows).withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    sources = sources.withColumn("rest", F.floor(F.col("target") - F.col("copies") * F.col("source_size")).cast("long"))
    sources = stage.keep(sources.withColumn("buckets", F.ceil(F.col("docs") / BUCKET)), "targets")

    named = sources.withColumnRenamed("source", "of")
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # buckets grow with keys, and fill evenly where weights are equal
    rows = rows.withColumn("bucket", F.floor((1 - F.exp(-F.col("key") / F.col("mean_key"))) * F.col("buckets")))

    # summed by bucket: the rest ends in the first whose running sum reaches it
    sums = rows.filter("rest > 0").groupBy("source", "bucket", "rest").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("words").over(running)).filter("upto >= rest")
    ends = sums.groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("at"))
    ends = stage.keep(ends.select(F.col("source").alias("of"), F.col("at.bucket").alias("last"), F.col("at.before").alias("before")), "ends")

    rows = rows.join(ends, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    sorted_ = rows.filter("bucket = last")
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - earlier))
    whole = rows.filter("last IS NULL OR bucket <> last").withColumn("part", F.when(F.col("bucket") < F.col("last"), F.col("size")).otherwise(0))
    both = whole.unionByName(sorted_.withColumn("part", part))
    return both.select(
        "doc_id", "source", "size", "source_size", "target",
        F.col("copies").cast("long").alias("copies"),
        (F.col("copies") * F.col("size") + F.col("part")).cast("long").alias("taken"),
    )
