"""Chunks of files of every language, through a registry of chunkers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.operators import files as paths
from lineloom.operators import java, markup, merge, python_source, sql_source
from lineloom.operators.lines import numbered_lines
from lineloom.plans.scan import by_length
from lineloom.session import staged

Chunker = Callable[[DataFrame], DataFrame]

COLUMNS = ["type", "name", "chunk_no", "start_line", "end_line", "file_path", "source"]

# Files whose lines lie in one bucket.
FILES_A_BUCKET = 4_096


def java_chunks(files: DataFrame) -> DataFrame:
    """Java chunks with the small ones folded in."""

    def merged(lines: DataFrame, spans: DataFrame, block: int, short: bool) -> DataFrame:
        small = java.chunks(lines, spans=spans, block=None if short else block)
        return merge.merge_small(small, block=block).select(*COLUMNS)

    return _from_lines(files, "java", lambda lines: by_length(lines, java.declarations(lines), None, merged))


def python_chunks(files: DataFrame) -> DataFrame:
    return python_source.docstrings(files).unionByName(_from_lines(files, "python", python_source.chunks))


def _from_lines(files: DataFrame, language: str, chunked: Chunker) -> DataFrame:
    """``chunked`` of the files' lines. A text is moved once, to the bucket of its file, and the lines
    made of it stay there. Lines of files in parts (``sources.tree``) lie as they come."""
    if "parts" in files.columns:
        whole, cut = files.where("parts = 1").drop("part", "parts"), files.where("parts > 1")
        return _from_lines(whole, language, chunked).unionByName(chunked(staged(numbered_lines(cut, language))))
    n = max(files.sparkSession.sparkContext.defaultParallelism, -(-files.count() // FILES_A_BUCKET))
    # in order in their buckets, so that later sorts of their lines find them sorted
    dealt = files.repartition(n, "file_path").sortWithinPartitions("file_path")
    return chunked(staged(numbered_lines(dealt, language), "file_path", n))


CHUNKERS: dict[str, Chunker] = {
    "python": python_chunks,
    "java": java_chunks,
    "sql": sql_source.chunks,
    "jsp": markup.chunks,
}


def register_chunker(language: str, chunker: Chunker) -> None:
    CHUNKERS[language] = chunker


def chunk_files(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(chunks, refused)``: chunks of all handled files, and the others with a reason."""
    dispatched = paths.dispatch(files)
    parts = [
        chunker(dispatched.where(F.col("chunker") == language)).select(*COLUMNS)
        for language, chunker in CHUNKERS.items()
    ]
    chunks = parts[0]
    for part in parts[1:]:
        chunks = chunks.unionByName(part)
    return chunks, dispatched.where(F.col("reason").isNotNull()).select("file_path", "reason")
