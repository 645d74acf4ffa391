"""Session settings the operators rely on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, shared: str | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own. ``shared`` is the
    folder for staged tables; without it the one the machine's defaults name is used."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lineloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LINELOOM_DRIVER_MEMORY", "8g"))
    )
    if shared is not None:
        builder = builder.config("spark.checkpoint.dir", shared)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application in that of ``spark.checkpoint.dir``, or of the context's
    checkpoints. A session of one machine that has neither is given one there; a
    cluster must name a folder that all its machines share."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lineloom-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/{context.applicationId}"


# Tables of the catalogue that name staged folders.
_NAMED: dict[str, list[str]] = {}


def staged(df: DataFrame, by: str | None = None, buckets: int = 0) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used where several later branches read one costly result: they then scan a
    columnar table, with only their columns, instead of repeating the work, and a
    lost executor costs one file read. ``unstage`` deletes the tables. With ``by`` rows lie
    in ``buckets`` of that column, and what groups or joins on it shuffles nothing; rows that
    come dealt by it to as many partitions are not moved.
    """
    spark = df.sparkSession
    name = f"stage_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    if by is not None:
        df.write.format("parquet").bucketBy(buckets, by).option("path", path).saveAsTable(name)
        _NAMED.setdefault(spark.sparkContext.applicationId, []).append(name)
        return spark.table(name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, by: str, buckets: int) -> DataFrame:
    """``df`` dealt by a column and staged in buckets of it."""
    return staged(df.repartition(buckets, by), by, buckets)


def unstage(spark: SparkSession) -> None:
    """Delete what this application has staged; frames that read it cannot be used any more."""
    for name in _NAMED.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores where the input comes in fewer splits than there are cores.

    Text work costs far more than reading its rows; a table in one small file
    would otherwise run in one task. Inputs of many splits stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
