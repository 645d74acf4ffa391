"""Load spooled line files as they come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lineloom.schemas import LINE, STORED_LINE
from lineloom.sources.stores import new_lines, stamped

BUCKETS = 64
TIER = 8


def ingest_lines(
    spark: SparkSession,
    spool: str,
    table: str,
    checkpoint: str,
    buckets: int = BUCKETS,
    tier: int = TIER,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append the lines of new spool files to ``table``, once per ``line_id``.

    The table is laid out by ``bucket``, a hash of the id, and ``batch``. A batch compares
    its ids with those of its own buckets only and writes its own ``batch`` folders,
    replacing them when it is replayed. Before batch ``n`` the last ``tier`` to the power ``j``
    batches become one, for the largest power that divides ``n``: a bucket holds fewer
    than ``tier`` folders of each power, and a line is rewritten once a power. While that
    step runs a reader may meet a line in its old and its new folder; replayed, it gives
    the same. A table keeps the number of ``buckets`` it was made with; a table of another
    layout is refused. Runs over what is there and stops.
    """
    reader = spark.readStream.schema(LINE).option("multiLine", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        placed = batch.dropDuplicates(["line_id"]).withColumn("bucket", bucket_of("line_id", buckets))
        incoming = placed.drop("bucket")
        if _exists(session, table):
            _compact(session, table, batch_id, tier)
            # at most as many numbers as there are buckets
            own = [r.bucket for r in placed.select("bucket").distinct().collect()]
            others = stored(session, table).where(F.col("bucket").isin(own) & (F.col("batch") != batch_id))
            incoming = new_lines(others, incoming)
        lines = stamped(incoming).select(*STORED_LINE.fieldNames(), bucket_of("line_id", buckets).alias("bucket"))
        _write(lines.withColumn("batch", F.lit(batch_id).cast("bigint")), table)

    return (
        reader.json(spool)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def bucket_of(column: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def stored(spark: SparkSession, table: str) -> DataFrame:
    """The lines of an ingested table with their ``bucket`` and ``batch``."""
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STORED_LINE.fields)
    return spark.read.schema(f"{layout}, bucket int, batch bigint").parquet(table)


def _compact(spark: SparkSession, table: str, batch_id: int, tier: int) -> None:
    """Make one folder a bucket of the batches that end before ``batch_id``."""
    span = 1
    while batch_id and batch_id % (span * tier) == 0:
        span *= tier
    if span == 1:
        return
    first, last = batch_id - span, batch_id - 1
    merged = stored(spark, table).where(F.col("batch").between(first, last)).dropDuplicates(["bucket", "line_id"])
    _write(merged.withColumn("batch", F.lit(last).cast("bigint")), table)
    for folder in _folders(spark, f"{table}/bucket=*/batch=*"):
        if first <= int(folder.getName().split("=")[1]) < last:
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _write(lines: DataFrame, table: str) -> None:
    # one file a bucket; buckets without a row keep the folders they have
    (
        lines.repartition("bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket", "batch")
        .parquet(table)
    )


def _folders(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [s.getPath() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []]


def _exists(spark: SparkSession, table: str) -> bool:
    if _folders(spark, f"{table}/batch=*"):
        raise ValueError(f"{table} is laid out by batch alone; load its lines into a new table")
    return bool(_folders(spark, f"{table}/bucket=*"))
