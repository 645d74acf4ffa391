"""File text to numbered lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineloom.functions import lexing, text


def numbered_lines(files: DataFrame, language: str | None = None) -> DataFrame:
    """One row per line: ``file_path, n_lines, line_no, source`` and, for a language,
    ``code`` (literals and comments blanked) and, for Java, ``marks``.

    All of it is worked out inside the file's own row; nothing is shuffled.
    ``n_lines`` lets later steps recognise the few very long files. Where ``files`` has
    ``part`` and ``parts``, a row is a part of a file (``sources.tree``), and the lines of
    files of several parts are numbered, and lexed, as if each were one text.
    """
    if "parts" not in files.columns:
        return _whole(files, language)
    return _whole(files.where("parts = 1"), language).unionByName(_cut(files.where("parts > 1"), language))


def ends_open(files: DataFrame) -> DataFrame:
    """``file_path`` of the files in parts whose last line has no line end."""
    ends = F.max_by(F.col("content").endswith("\n"), F.col("part"))
    return files.where("content != ''").groupBy("file_path").agg(ends.alias("ended")).where("NOT ended").select("file_path")


def _whole(files: DataFrame, language: str | None) -> DataFrame:
    content = F.regexp_replace(text.unify_newlines(F.col("content")), r"\n\z", "")
    body = files.select("file_path", content.alias("content"))
    body = _with_tokens(body.withColumn("n_lines", text.newline_count(F.col("content")) + 1), language)
    # An empty text gives no lines. A filter here would be pushed below the text's making
    # and would make it twice.
    empty = F.array().cast("array<string>")
    arrays = [
        F.when(F.col("content") == "", empty).otherwise(F.split(c, "\n")).alias(n)
        for n, c in _columns(F.col("content"), language).items()
    ]
    return _exploded(body, ["n_lines"], F.lit(0), arrays)


def _with_tokens(body: DataFrame, language: str | None) -> DataFrame:
    """Texts are cut into tokens once, in a column of their own, for all that is made of them."""
    return body.withColumn("_tokens", lexing.java_tokens(F.col("content"))) if language == "java" else body


def _columns(content: Column, language: str | None) -> dict[str, Column]:
    columns = {"source": content}
    if language == "java":
        columns |= {"code": lexing.java_code(F.col("_tokens")), "marks": lexing.java_marks(F.col("_tokens"))}
    elif language == "python":
        columns |= {"code": lexing.python_code(content)}
    return columns


def _exploded(body: DataFrame, kept: Sequence[str], before: Column, arrays: Sequence[Column]) -> DataFrame:
    names = ["source", "code", "marks"][: len(arrays)]
    placed = body.select("file_path", *kept, before.alias("_before"), F.posexplode(F.arrays_zip(*arrays)).alias("_pos", "_line"))
    return placed.select(
        "file_path",
        *kept,
        (F.col("_before") + F.col("_pos") + 1).cast("int").alias("line_no"),
        *[F.col("_line")[n].alias(n) for n in names],
    )


def _cut(files: DataFrame, language: str | None) -> DataFrame:
    """Lines of files in parts. A part tells, in one short row, how many lines it has and
    what it leaves open (a comment, a long literal) for all it may begin in; walking over
    these rows gives each part its first line and what it begins in."""
    openers = lexing.OPEN.get(language, ("",))
    # every part but the last ends with its last line's end
    body = files.select("file_path", "part", text.unify_newlines(F.col("content")).alias("content"))
    n = F.when(F.col("content") == "", 0).otherwise(text.newline_count(F.regexp_replace("content", r"\n\z", "")) + 1)
    after = [lexing.open_after(F.col("content"), language, s) if len(openers) > 1 else F.lit(0) for s in range(len(openers))]
    told = body.select("file_path", "part", n.cast("long").alias("n"), F.array(*after).alias("after"))
    walked = told.groupBy("file_path").agg(F.array_sort(F.collect_list(F.struct("part", "n", "after"))).alias("told"))

    def step(states: Column, part: Column) -> Column:
        return F.concat(states, F.get(part["after"], F.substring(states, -1, 1).cast("int")).cast("string"))

    # one digit a part: the state it begins in
    walked = walked.withColumn("states", F.aggregate("told", F.lit("0"), step))
    earlier = Window.partitionBy("file_path").orderBy("part")
    starts = walked.select("file_path", "states", F.posexplode("told").alias("at", "t")).select(
        "file_path", F.col("t.part").alias("part"), F.col("t.n").alias("n"), F.expr("substring(states, at + 1, 1)").cast("int").alias("state")
    ).select(
        "file_path", "part", "state",
        (F.sum("n").over(earlier) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("file_path")).cast("int").alias("n_lines"),
    )
    joined = body.join(starts, ["file_path", "part"]).where("content != ''")
    # what is open goes before the text as a line of its own, which is dropped again
    opened = F.get(F.array(*(F.lit(o + "\n" if o else "") for o in openers)), F.col("state"))
    held = _with_tokens(joined.withColumn("content", F.concat(opened, F.regexp_replace("content", r"\n\z", ""))), language)
    first = F.when(F.col("state") > 0, 2).otherwise(1)
    arrays = [
        F.slice(F.split(c, "\n"), first, F.length("content") + 1).alias(name) for name, c in _columns(F.col("content"), language).items()
    ]
    return _exploded(held, ["n_lines"], F.col("before"), arrays)
