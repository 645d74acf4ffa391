"""Python docstrings, declarations and chunks from numbered lines.

A declaration ends at the last code line before the next logical line that is
indented no deeper. Lines inside brackets, after a backslash or inside a
multi-line string are no logical lines.

Limit: a tab counts as eight columns whatever its position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineloom.functions import lexing, text
from lineloom.operators.lines import numbered_lines
from lineloom.operators.segment import joined_lines, span_pieces
from lineloom.operators.spans import match_closes
from lineloom.plans.scan import block_for, with_running
from lineloom.schemas import MAX_CHUNK_LINES

_DECLARATION = r"(?U)^\s*(async\s+def|def|class)\s+([^\W\d]\w*)"
_EMPTY_STRING = r'''^[uUrR]?("""\s*"""|\'\'\'\s*\'\'\'|"\s*"|\'\s*\')\s*;?\s*\z'''


def docstrings(files: DataFrame) -> DataFrame:
    """The module docstring of each file that has a non-empty one, as a chunk.

    Worked out inside the file's row: the first code line must be a string, and
    the lines that continue it are marked by the lexer. For files in parts
    (``sources.tree``) the same is worked out from their lines.
    """
    if "parts" in files.columns:
        return docstrings(files.where("parts = 1").drop("part", "parts")).unionByName(_cut_docstrings(files.where("parts > 1")))
    content = F.regexp_replace(text.unify_newlines(F.col("content")), r"\n\z", "")
    parsed = F.struct(
        F.split("content", "\n").alias("lines"),
        F.split(lexing.python_code(F.col("content")), "\n").alias("code"),
    )
    rows = (
        files.select("file_path", content.alias("content"))
        # Exploding the one result keeps later filters from parsing the text again.
        .select("file_path", F.explode(F.array(parsed)).alias("p"))
        .select("file_path", "p.*")
        .withColumn(
            "first",
            F.array_position(F.transform("code", lambda c: ~text.is_blank(c)), F.lit(True)).cast("int"),
        )
        .where("first > 0")
    )
    rest = F.slice("code", F.col("first") + 1, F.size("code"))
    stays = F.array_position(
        F.transform(rest, lambda c: c.startswith(lexing.INSIDE)), F.lit(False)
    ).cast("int")
    rows = rows.withColumn("more", F.when(stays == 0, F.size(rest)).otherwise(stays - 1))
    head = F.get("code", F.col("first") - 1)
    tail = F.get("code", F.col("first") + F.col("more") - 1)
    source = F.array_join(F.slice("lines", F.col("first"), F.col("more") + 1), "\n")
    end = F.col("first") + F.col("more")
    return _docstring_rows(rows.where(_alone(F.col("more") == 0, head, tail)), F.col("first"), end, source)


def _alone(one_line: Column, head: Column, tail: Column) -> Column:
    """Whether a string that begins the code ``head`` and ends the code ``tail`` is a statement."""
    return F.when(one_line, head.rlike(r"^[uUrR]?_\s*(;|\z)")).otherwise(
        head.rlike(r"^[uUrR]?_\s*\z") & tail.rlike("^" + lexing.INSIDE + r"_?\s*(;|\z)")
    )


def _docstring_rows(rows: DataFrame, start: Column, end: Column, source: Column) -> DataFrame:
    found = rows.select(
        "file_path",
        F.lit("docstring").alias("type"),
        F.lit(None).cast("string").alias("name"),
        F.lit(1).alias("chunk_no"),
        start.alias("start_line"),
        end.alias("end_line"),
        source.alias("source"),
    )
    return found.where(~F.col("source").rlike(_EMPTY_STRING))


def _cut_docstrings(files: DataFrame) -> DataFrame:
    lines = numbered_lines(files, "python").select("file_path", "n_lines", "line_no", "source", "code")
    first = F.min(F.when(~text.is_blank(F.col("code")), F.col("line_no")))
    heads = lines.groupBy("file_path").agg(first.alias("first"), F.max("n_lines").alias("n")).where("first IS NOT NULL")
    below = lines.join(heads, "file_path").where("line_no > first")
    stops = below.where(~F.col("code").startswith(lexing.INSIDE)).groupBy("file_path").agg(F.min("line_no").alias("stop"))
    spans = heads.join(stops, "file_path", "left").select("file_path", "first", (F.coalesce("stop", F.col("n") + 1) - 1).alias("end"))
    inside = lines.join(spans, "file_path").where("line_no BETWEEN first AND end")
    found = inside.groupBy("file_path", "first", "end").agg(
        F.min_by("code", "line_no").alias("head"), F.max_by("code", "line_no").alias("tail"), joined_lines().alias("source")
    )
    whole = found.where(_alone(F.col("first") == F.col("end"), F.col("head"), F.col("tail")))
    return _docstring_rows(whole, F.col("first"), F.col("end"), F.col("source"))


def declarations(lines: DataFrame, block: int | None = None) -> DataFrame:
    """``def``, ``async def`` and ``class`` at any depth: ``file_path, n_lines, type,
    name, span_start, span_end``. Decorators are outside the span."""
    block = block_for(lines, block=block)
    code = F.col("code")
    is_code = code != ""
    step = text.count_chars(code, "([{") - text.count_chars(code, ")]}")
    trimmed = lines.select("file_path", "n_lines", "line_no", text.rstrip(code).alias("code"))
    physical = with_running(
        trimmed,
        ["file_path"],
        ["line_no"],
        sums={"depth": step},
        lasts={
            "code_line": F.when(is_code, F.col("line_no")),
            "joined": F.when(is_code, code.endswith("\\")),
        },
        block=block,
        spans_blocks=F.col("n_lines") >= block,
    )
    # One more row past the end closes what is still open there.
    end_row = F.struct(
        (F.col("line_no") + 1).alias("line_no"),
        F.lit("$").alias("code"),
        F.when(is_code, F.col("line_no")).otherwise(F.col("code_line")).alias("code_line"),
        F.lit(True).alias("logical"),
    )
    begins = is_code & ~code.startswith(lexing.INSIDE) & (F.col("depth") == 0) & ~F.coalesce("joined", F.lit(False))
    row = F.struct("line_no", "code", "code_line", begins.alias("logical"))
    logical = (
        physical.select(
            "file_path",
            "n_lines",
            F.explode(
                F.when(F.col("line_no") == F.col("n_lines"), F.array(row, end_row)).otherwise(F.array(row))
            ).alias("row"),
        )
        .select("file_path", "n_lines", "row.*")
        .where("logical")
        .withColumn(
            "indent",
            F.length("code") - F.length(F.ltrim("code", F.lit(" \t"))) + 7 * text.count_chars(F.regexp_extract("code", r"^[ \t]*", 0), "\t"),
        )
    )
    seen = with_running(
        logical,
        ["file_path"],
        ["line_no"],
        lasts={"indent_before": F.col("indent")},
        block=block,
        spans_blocks=F.col("n_lines") >= block,
    )
    may_declare = code.contains("def") | code.contains("class")
    kind = F.when(may_declare, F.regexp_extract(code, _DECLARATION, 1)).otherwise("")
    name = F.regexp_extract(code, _DECLARATION, 2)
    opened = F.struct(
        F.when(kind == "class", "class").when(kind == "def", "function").otherwise("unknown").alias("type"),
        name.alias("name"),
        F.col("line_no").alias("span_start"),
    )
    nothing = F.lit(None).cast("struct<type:string,name:string,span_start:int>")
    opens = F.when(
        kind != "",
        F.array(
            F.struct(
                F.col("indent").alias("level"),
                F.lit(1).alias("place"),
                opened.alias("opened"),
                F.lit(None).cast("int").alias("closed_at"),
            )
        ),
    ).otherwise(F.array())
    # A line closes the levels from its own indent up to that of the line before:
    # anything deeper was closed there already.
    levels = F.when(
        F.col("indent") <= F.col("indent_before"), F.sequence("indent", "indent_before")
    ).otherwise(F.array().cast("array<int>"))
    closes = F.transform(
        levels,
        lambda v: F.struct(
            v.alias("level"),
            F.lit(0).alias("place"),
            nothing.alias("opened"),
            F.col("code_line").alias("closed_at"),
        ),
    )
    events = seen.select("file_path", "n_lines", "line_no", F.explode(F.concat(opens, closes)).alias("e")).select(
        "file_path", "n_lines", "line_no", "e.*"
    )
    return match_closes(events, block).withColumnRenamed("close", "span_end")


def chunks(
    lines: DataFrame,
    *,
    limit: int = MAX_CHUNK_LINES,
    spans: DataFrame | None = None,
    block: int | None = None,
) -> DataFrame:
    """A chunk per declaration, in pieces where it is long. Lines of short files that lie by file stay there."""
    spans = declarations(lines, block) if spans is None else spans
    return span_pieces(
        lines, spans, text.COMMENT_MARKS["python"], limit=limit, block=block
    ).select(
        "file_path",
        "type",
        "name",
        "chunk_no",
        F.col("piece_start").alias("start_line"),
        F.col("piece_end").alias("end_line"),
        "source",
    )
