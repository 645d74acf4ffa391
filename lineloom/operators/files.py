"""Choose files by path, and the language that handles them."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Extension to language.
LANGUAGES = {
    ".py": "python",
    ".java": "java",
    ".sql": "sql",
    ".tsql": "sql",
    ".psql": "sql",
    ".jsp": "jsp",
}
LINE_LANGUAGES = ("java",)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-case suffix with its dot; a name that only starts with a dot has none."""
    return F.lower(F.regexp_extract(file_name(path), r"[^.]\.*(\.[^.]+)$", 1))


def wanted_extensions(extensions: Collection[str]) -> list[str]:
    """Extensions as ``extension`` gives them; the dot may be left out."""
    given = {e.lower() for e in extensions}
    if not given:
        raise ValueError("no file extension is given")
    return sorted(e if e.startswith(".") else f".{e}" for e in given)


def is_scanned(path: Column, extensions: Collection[str], exclude_dirs: Collection[str] = ()) -> Column:
    """Whether a scan below the root keeps ``path`` (relative, ``/`` between parts)."""
    excluded = sorted({d.lower() for d in exclude_dirs})
    parts = F.split(path, "/")
    directories = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def pruned(d: Column) -> Column:
        hidden = d.startswith(".")
        return hidden | F.lower(d).isin(excluded) if excluded else hidden

    return extension(path).isin(wanted_extensions(extensions)) & ~F.exists(directories, pruned)


def relative_to(path: Column, root: str) -> Column:
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, len(base) + 1, 2**31 - 1)).otherwise(path)


def scan_paths(
    paths: DataFrame, extensions: Collection[str], exclude_dirs: Collection[str] = (), root: str = ""
) -> DataFrame:
    """Rows of ``paths`` a scan of ``root`` keeps, with path relative to it and ``ext``."""
    relative = relative_to(F.col("file_path"), root) if root else F.col("file_path")
    return (
        paths.withColumn("file_path", relative)
        .where(is_scanned(F.col("file_path"), extensions, exclude_dirs))
        .withColumn("ext", extension(F.col("file_path")))
    )


def dispatch(files: DataFrame) -> DataFrame:
    """Add ``chunker`` and ``line_extractor`` languages, null where none exists, and
    ``reason``, the text of the refusal for files no chunker takes."""
    ext = extension(F.col("file_path"))
    language = F.lit(None).cast("string")
    for suffix, name in LANGUAGES.items():
        language = F.when(ext == suffix, F.lit(name)).otherwise(language)
    return files.select(
        "*",
        language.alias("chunker"),
        F.when(language.isin(*LINE_LANGUAGES), language).alias("line_extractor"),
        F.when(
            language.isNull(), F.concat(F.lit("nothing chunks files of type "), ext)
        ).alias("reason"),
    )
