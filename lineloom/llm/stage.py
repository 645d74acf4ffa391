"""Results that several later steps read, as tables in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

from lineloom.session import shared_folder

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames made inside have Spark delete what they shuffled as soon as their action ends."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


class Stage:
    """Tables of one operator call under one folder of ``spark.checkpoint.dir``.

    ``keep`` writes a frame as Parquet and reads it back with its own schema, so that a
    lost executor costs a file read and not the lineage; ``drop`` deletes what no later
    step reads. What the returned result still reads stays until the folder is cleared.
    ``free_shuffles`` has Spark delete what a kept frame has shuffled as soon as it is written;
    without it that stays on the executors' disks until the driver collects garbage.
    """

    def __init__(self, spark: SparkSession, name: str, free_shuffles: bool = False):
        self.spark = spark
        self.free_shuffles = free_shuffles
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        with freed_shuffles(self.spark) if self.free_shuffles else nullcontext():
            # a frame takes the setting of the time it is made
            df.select("*").write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.folder}/{name}")

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def put_bytes(self, name: str, data: bytes) -> str:
        """Write one small file into the folder; returns its path."""
        path = f"{self.folder}/{name}"
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        out = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(where, True)
        try:
            for at in range(0, len(data), 1 << 20):
                out.write(bytearray(data[at : at + (1 << 20)]))
        finally:
            out.close()
        return path
