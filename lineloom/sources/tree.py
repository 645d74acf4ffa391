"""Read a source tree: a path lister that keeps hidden files, then file contents.

Spark's file sources skip names that begin with ``_`` or ``.``; a source tree has
``__init__.py``. So names come from a Python data source, and contents are read by
tasks that each get an even share of the files. A root is a path that every machine
mounts, or an address of a store that Arrow reads (``s3://``, ``gs://``, ``hdfs://``, ``file://``).
What cannot be listed or read becomes a row with the reason.

A file larger than ``PART_BYTES`` is read in parts: byte ranges, each moved to the next line
end, so that a part holds whole lines and every line is in one part. Parts are rows of their
own, in tasks of their own; ``lines.numbered_lines`` and the chunkers put them together.
"""

from __future__ import annotations

import os
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lineloom.functions.text import unify_newlines
from lineloom.operators.files import extension, relative_to, wanted_extensions
from lineloom.session import staged

# Bytes of a file beyond which it is read in parts.
PART_BYTES = 16 * 1024 * 1024
# Bytes beyond which one line, or one trace, cannot be a value of a row.
VALUE_BYTES = 1_900_000_000
FILES_PER_BATCH = 64
BATCH_BYTES = 64 * 1024 * 1024


def _pruned(name: str, excluded: Collection[str]) -> bool:
    return name.startswith(".") or name.lower() in excluded


def _opened(path: str) -> tuple[fs.FileSystem | None, str, str]:
    """The store of an address, the part before the store's own paths, and its path there."""
    if "://" not in path:
        return None, "", path
    store, inner = fs.FileSystem.from_uri(path)
    return store, path[: len(path) - len(inner)] if path.endswith(inner) else "", inner


def _entries(directory: str) -> tuple[list[str], list[tuple[str, int]]]:
    """Directories and files (with sizes) of a directory; links to directories are not followed."""
    store, before, inner = _opened(directory)
    if store is None:
        with os.scandir(directory) as entries:
            found = list(entries)
        below = [e.path for e in found if e.is_dir(follow_symlinks=False)]
        return below, sorted((e.path, e.stat().st_size) for e in found if e.is_file())
    listed = store.get_file_info(fs.FileSelector(inner))
    below = [before + i.path for i in listed if i.type == fs.FileType.Directory]
    return below, sorted((before + i.path, i.size) for i in listed if i.type == fs.FileType.File)


class _Share(InputPartition):
    def __init__(self, shallow: list[str], deep: list[str]):
        self.shallow = shallow
        self.deep = deep


class _TreeReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"].rstrip("/") or "/"
        self.excluded = {d.lower() for d in options.get("exclude", "").split("\n") if d}
        self.wanted = int(options.get("partitions", "64"))

    def _below(self, directories: list[str]) -> list[str]:
        return [d for d in directories if not _pruned(d.rstrip("/").rsplit("/", 1)[-1], self.excluded)]

    def partitions(self):
        """Open directories level by level until there are enough subtrees to share out, then
        deal them to ``partitions`` tasks.

        The driver lists only these upper levels; tasks walk what is below. A directory that
        cannot be opened here is reported by its task.
        """
        shallow, open_dirs = [], [self.root]
        while open_dirs and len(open_dirs) < self.wanted:
            below = []
            for directory in open_dirs:
                shallow.append(directory)
                try:
                    below += self._below(_entries(directory)[0])
                except OSError:
                    pass
            open_dirs = below
        open_dirs.sort()
        shares = [_Share(shallow[i :: self.wanted], open_dirs[i :: self.wanted]) for i in range(self.wanted)]
        return [s for s in shares if s.shallow or s.deep]

    def read(self, partition: _Share) -> Iterator[tuple]:
        waiting = [(d, False) for d in partition.shallow] + [(d, True) for d in partition.deep]
        while waiting:
            directory, deep = waiting.pop()
            try:
                below, found = _entries(directory)
            except OSError as failure:
                yield (directory, None, str(failure))
                continue
            if deep:
                waiting += [(d, True) for d in self._below(below)]
            for path, size in found:
                yield (path, size, None)


class SourceTree(DataSource):
    """``spark.read.format("sourcetree").option("path", root)``: ``file_path, size``, and
    ``problem`` for a directory that cannot be listed."""

    @classmethod
    def name(cls) -> str:
        return "sourcetree"

    def schema(self) -> str:
        return "file_path string, size bigint, problem string"

    def reader(self, schema) -> DataSourceReader:
        return _TreeReader(self.options)


def list_files(
    spark: SparkSession, root: str, extensions: Collection[str], exclude_dirs: Collection[str] = ()
) -> DataFrame:
    """``file_path, size`` of the files below ``root`` with one of the extensions, and
    ``file_path, problem`` of the directories that cannot be listed."""
    wanted = wanted_extensions(extensions)
    return _listed(spark, root, exclude_dirs).where(F.col("problem").isNotNull() | extension(F.col("file_path")).isin(wanted))


def _listed(spark: SparkSession, root: str, exclude_dirs: Collection[str] = ()) -> DataFrame:
    spark.dataSource.register(SourceTree)
    return spark.read.format("sourcetree").option("path", root).option("exclude", "\n".join(exclude_dirs)).load()


def _after_line_end(f, at: int, size: int) -> int:
    """The offset behind the first line end at or after ``at``; ``size`` where there is none."""
    f.seek(at)
    while piece := f.read(1 << 20):
        found = piece.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(piece)
    return size


def _part(f, start: int, end: int | None) -> bytes:
    """The lines of an open file that begin from ``start`` on and before ``end`` (None: its end)."""
    f.seek(0, 2)
    size = f.tell()
    first = _after_line_end(f, start - 1, size) if start else 0
    last = size if end is None else _after_line_end(f, end - 1, size)
    if last - first > VALUE_BYTES:
        raise OSError(f"lines of {last - first} bytes are too long for one row")
    f.seek(first)
    return f.read(last - first)


def read_contents(paths: DataFrame, partitions: int | None = None, part_bytes: int | None = None) -> DataFrame:
    """Add ``data`` (bytes) and ``problem`` to rows of ``file_path, size``, one row for each of
    the ``parts`` of a file, numbered by ``part`` from 0.

    Parts are spread first, so neither one directory with many files nor one large file is
    one task. A row that has a ``problem`` already keeps it.
    """
    part_bytes = part_bytes or PART_BYTES
    known = F.col("problem") if "problem" in paths.columns else F.lit(None).cast("string").alias("problem")
    parts = F.greatest(F.lit(1), F.ceil(F.coalesce("size", F.lit(0)) / F.lit(part_bytes))).cast("int")
    cut = paths.select("file_path", known, parts.alias("parts"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    spread = cut.repartition(partitions, "file_path", "part") if partitions else cut.repartition("file_path", "part")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("file_path", pa.string()), ("data", pa.binary()), ("problem", pa.string()), ("part", pa.int32()), ("parts", pa.int32())]
        )
        rows, held = [], 0

        def flush():
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            for path, problem, parts, part in zip(*(c.to_pylist() for c in batch.columns)):
                data = None
                if problem is None:
                    try:
                        store, _, inner = _opened(path)
                        with open(path, "rb") if store is None else store.open_input_file(inner) as f:
                            # the last part has what was added since the file was listed
                            data = _part(f, part * part_bytes, (part + 1) * part_bytes if part < parts - 1 else None)
                    except OSError as failure:
                        problem = str(failure)
                rows.append({"file_path": path, "data": data, "problem": problem, "part": part, "parts": parts})
                held += len(data or b"")
                if len(rows) >= FILES_PER_BATCH or held >= BATCH_BYTES:
                    yield flush()
                    rows, held = [], 0
        if rows:
            yield flush()

    return spread.mapInArrow(load, "file_path string, data binary, problem string, part int, parts int")


def decode(contents: DataFrame, project_root: str = "/") -> tuple[DataFrame, DataFrame]:
    """``(files, quarantined)``: strict UTF-8 texts, and the other files with a reason. A file
    with one bad part is left out whole."""
    text = F.col("data").cast("string")
    checked = contents.withColumn("problem", F.coalesce("problem", F.when(~F.is_valid_utf8(text), F.lit("not valid UTF-8"))))
    path = relative_to(F.col("file_path"), project_root)
    bad = checked.where(F.col("problem").isNotNull())
    fine = checked.where(F.col("problem").isNull())
    # only files of several parts can have good rows and bad ones
    cut = fine.where("parts > 1").join(bad.where("parts > 1").select("file_path").distinct(), "file_path", "left_anti")
    good = fine.where("parts = 1").unionByName(cut).select(
        path.alias("file_path"),
        extension(F.col("file_path")).alias("ext"),
        unify_newlines(F.decode(F.col("data"), "UTF-8")).alias("content"),
        "part",
        "parts",
    )
    return good, bad.groupBy(path.alias("file_path")).agg(F.min("problem").alias("reason"))


def read_tree(
    spark: SparkSession,
    root: str,
    extensions: Collection[str],
    exclude_dirs: Collection[str] = (),
    project_root: str = "/",
    partitions: int | None = None,
    part_bytes: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(files, quarantined)`` of a tree. The tree is read once, into a staged table: what
    numbers lines, what chunks and what reports all read that."""
    listed = list_files(spark, root, extensions, exclude_dirs)
    return decode(staged(read_contents(listed, partitions, part_bytes)), project_root)


def read_traces(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(traces, quarantined)`` of the stack-trace files below ``path``, hidden ones too: one
    row per file with ``trace_id`` (path) and ``trace``, and ``file_path, reason`` of the files
    and directories that cannot be read as UTF-8. A trace is one value, so never cut."""
    listed = _listed(spark, path)
    large = F.when(F.col("size") > VALUE_BYTES, F.concat(F.col("size").cast("string"), F.lit(" bytes are too many for one trace")))
    listed = listed.withColumn("problem", F.coalesce("problem", large))
    contents = staged(read_contents(listed, part_bytes=VALUE_BYTES))
    text = F.col("data").cast("string")
    reason = F.coalesce("problem", F.when(~F.is_valid_utf8(text), F.lit("not valid UTF-8")))
    traces = contents.where(reason.isNull()).select(F.col("file_path").alias("trace_id"), F.decode(F.col("data"), "UTF-8").alias("trace"))
    return traces, contents.where(reason.isNotNull()).select("file_path", reason.alias("reason"))
