"""Stored chunks, lines and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineloom.schemas import CHUNK, LINE, STORED_LINE


def write_chunks(chunks: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    columns = [c for c in CHUNK.fieldNames() if c in chunks.columns]
    chunks.select(*columns).write.mode(mode).format(fmt).save(path)


def read_chunks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Chunks under the full schema; absent ``errors`` read as an empty list."""
    reader = spark.read.schema(CHUNK)
    if fmt == "json":
        reader = reader.option("multiLine", "true")
    df = reader.format(fmt).load(path)
    return df.withColumn("errors", F.coalesce("errors", F.array().cast(CHUNK["errors"].dataType)))


def write_lines(lines: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Lines sorted within tasks for look-ups: type and method filters then skip row groups."""
    columns = [c for c in STORED_LINE.fieldNames() if c in lines.columns]
    laid_out = lines.select(*columns)
    if fmt == "parquet":
        laid_out = laid_out.repartitionByRange("parent_type", "parent_method", "file_line_no").sortWithinPartitions(
            "parent_type", "parent_method", "file_line_no"
        )
    laid_out.write.mode(mode).format(fmt).save(path)


def read_lines(spark: SparkSession, path: str, fmt: str = "parquet", stored: bool = True) -> DataFrame:
    reader = spark.read.schema(STORED_LINE if stored else LINE)
    if fmt == "json":
        reader = reader.option("multiLine", "true")
    return reader.format(fmt).load(path)


def _with_stored(incoming: DataFrame, current: DataFrame, within: str) -> DataFrame:
    """Incoming rows and, marked ``_stored``, rows of the ids that are stored; ``_new`` marks one
    incoming row of each id that is not. Sorted by id inside ``within``, stored rows first."""
    known = current.where(F.col("line_id").isNotNull()).select(*[c for c in incoming.columns if c in current.columns])
    both = incoming.withColumn("_stored", F.lit(False)).unionByName(known.withColumn("_stored", F.lit(True)), allowMissingColumns=True)
    order = Window.partitionBy(within).orderBy("line_id", F.desc("_stored"))
    first = (F.row_number().over(order) == 1) | ~F.col("line_id").eqNullSafe(F.lag("line_id").over(order))
    return both.withColumn("_new", first & ~F.col("_stored"))


def new_lines(current: DataFrame, incoming: DataFrame, within: str | None = None) -> DataFrame:
    """Incoming lines whose ``line_id`` is not stored, one per id. ``within`` names a column that
    rows of one id share, as the file is, from which ids are made: rows move once at most, and a value of it is sorted in one task."""
    if within is not None:
        return _with_stored(incoming, current, within).where("_new").select(*incoming.columns)
    return incoming.dropDuplicates(["line_id"]).join(current.select("line_id"), "line_id", "left_anti")


def stamped(lines: DataFrame) -> DataFrame:
    return lines.withColumn("created_at", F.current_timestamp())


def load_report(current: DataFrame, incoming: DataFrame, unit: str | Column = "file_path", within: str | None = None) -> DataFrame:
    """Per file: lines offered, lines new, and whether any was rejected.

    Repeats inside the load and ids already stored both count as rejected. ``within``, as for
    ``new_lines``, is the unit itself.
    """
    if within is not None:
        if not isinstance(unit, str) or within != unit:
            raise ValueError("within must be the unit")
        ids = _with_stored(incoming.select(within, "line_id"), current, within).groupBy(within).agg(
            F.count_if(~F.col("_stored")).alias("offered"), F.count_if("_new").alias("loaded")
        )
        return ids.where("offered > 0").withColumn("rejected", F.col("offered") - F.col("loaded"))
    offered = incoming.groupBy(unit, "line_id").agg(F.count("*").alias("copies"))
    known = current.select("line_id", F.lit(True).alias("known")).distinct()
    return (
        offered.join(known, "line_id", "left")
        .groupBy(unit)
        .agg(
            F.sum("copies").alias("offered"),
            F.count_if(F.col("known").isNull()).alias("loaded"),
        )
        .withColumn("rejected", F.col("offered") - F.col("loaded"))
    )


def ensure_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The stored table, created empty where there is none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)
