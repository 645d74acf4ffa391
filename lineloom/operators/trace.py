"""Stack traces: frames, root frame, code around it, explanation prompt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineloom.functions import text
from lineloom.schemas import CONTEXT_LINES
from lineloom.session import staged

# Lines of a method in one row where traces meet them.
BODY_LINES = 256

# Fixed value: one frame of a printed trace.
FRAME = r"(?U)\s*at ([\w.$]+)\.(\w+)\(([\w.$]+):(\d+)\)"

# Fixed texts of the prompt.
_INTRODUCTION = (
    "You're a senior software engineer helping to diagnose Java stacktraces.\n\n"
    "Below is a Java exception stacktrace, along with the relevant source code from the application. "
    "Please explain what most likely caused the exception in plain language. "
    "If possible, also suggest how a developer should begin debugging it.\n\n---\n\nStacktrace:\n"
)
_QUESTIONS = (
    "\n\n---\n\nExplain:\n"
    "1. What is most likely happening at this line?\n"
    "2. Why might it cause an error?\n"
    "3. What should the developer check or do next?"
)


def parsed_frames(trace: Column, user_prefixes: Sequence[str]) -> Column:
    """``array<frame>`` of a trace text, in text order."""

    def frame(hit: Column) -> Column:
        part = [F.regexp_extract(hit, FRAME, i) for i in range(1, 5)]
        user = F.lit(False)
        for prefix in user_prefixes:
            user = user | part[0].startswith(prefix)
        return F.struct(
            part[0].alias("class"),
            part[1].alias("method"),
            part[2].alias("file"),
            part[3].cast("int").alias("line"),
            user.alias("is_user_code"),
        )

    return F.transform(F.regexp_extract_all(trace, F.lit(FRAME), F.lit(0)), frame)


def frames(traces: DataFrame, user_prefixes: Sequence[str], trace: str = "trace") -> DataFrame:
    """One row per frame, numbered from 1; traces without frames give none."""
    rest = [c for c in traces.columns if c != trace]
    return traces.select(*rest, F.posexplode(parsed_frames(F.col(trace), user_prefixes)).alias("i", "f")).select(
        *rest, (F.col("i") + 1).alias("frame_no"), "f.*"
    )


def root_frame(found: Column) -> Column:
    """The first user frame, else the first frame, else null: read off the array."""
    # Passing the frames through a one-element array parses the text once for both uses.
    first = F.transform(
        F.array(found),
        lambda fs: F.coalesce(F.get(F.filter(fs, lambda f: f["is_user_code"]), 0), F.get(fs, 0)),
    )
    return F.get(first, 0)


def with_root(traces: DataFrame, user_prefixes: Sequence[str], trace: str = "trace") -> DataFrame:
    """Traces with their ``root`` frame, null where a trace has no frames."""
    return traces.withColumn("root", root_frame(parsed_frames(F.col(trace), user_prefixes)))


def method_context(
    lookups: DataFrame, lines: DataFrame, context_lines: int = CONTEXT_LINES, nested_dots: bool = True
) -> DataFrame:
    """Code around ``class, method, line``, one row per distinct lookup that has code.

    ``lines`` is the stored line table. Only lines of the same method within
    ``context_lines`` count. Lookups repeat a lot, so they are made distinct first,
    and both sides meet on type, method and a line block as wide as the context: a
    hot method neither fills one task nor pairs all its lines with all its lookups.
    ``nested_dots`` reads ``Outer$Inner`` as ``Outer.Inner``.
    """
    width = 2 * context_lines + 1
    wanted = lookups.select("class", "method", "line").where(F.col("class").isNotNull()).distinct()
    owner = F.replace(F.col("class"), F.lit("$"), F.lit(".")) if nested_dots else F.col("class")
    block = lambda c: F.floor(c / F.lit(width))
    probes = wanted.select(
        "*",
        owner.alias("parent_type"),
        F.col("method").alias("parent_method"),
        F.explode(
            F.sequence(block(F.col("line") - context_lines), block(F.col("line") + context_lines))
        ).alias("at"),
    )
    code = lines.where(F.col("parent_type").isNotNull() & F.col("parent_method").isNotNull()).select(
        "parent_type", "parent_method", "file_path", "file_line_no", "source", block(F.col("file_line_no")).alias("at")
    )
    near = F.col("file_line_no").between(F.col("line") - context_lines, F.col("line") + context_lines)
    met = probes.join(code, ["parent_type", "parent_method", "at"]).where(near)
    # Files that hold the same line are counted before lines are put together, in tasks by
    # line and text, so a method that very many files declare is not one task's work.
    owner_keys = ["class", "method", "line", "parent_type", "parent_method"]
    each = met.groupBy(*owner_keys, F.col("file_line_no").alias("line_no"), "source").agg(
        F.min("file_path").alias("file_path"), F.count("*").cast("int").alias("copies")
    )
    around = F.array_sort(F.collect_list(F.struct("line_no", "source", "file_path", "copies")))
    shown = F.transform(
        "found", lambda r: F.array_repeat(F.struct(r["line_no"].alias("line_no"), r["source"].alias("source")), r["copies"])
    )
    return (
        each.groupBy(*owner_keys)
        .agg(around.alias("found"))
        .select(
            "class",
            "method",
            "line",
            F.struct(
                F.get("found", 0)["file_path"].alias("file_path"),
                "parent_method",
                "parent_type",
                F.flatten(shown).alias("lines"),
            ).alias("context"),
        )
    )


def _with_own_context(rooted: DataFrame, lines: DataFrame, context_lines: int, nested_dots: bool) -> DataFrame:
    """``with_context`` for methods that one file declares.

    Lines come together by method and block where they lie, each block with the lines
    that a frame in it may show from the blocks beside it. A trace meets one such row and
    takes its lines from it, so traces and the lines of methods move once and no context does.
    """
    block = lambda c: F.floor(c / F.lit(BODY_LINES))
    line = F.col("file_line_no")
    code = lines.where(F.col("parent_type").isNotNull() & F.col("parent_method").isNotNull()).select(
        F.col("file_path").alias("_file"),
        F.col("parent_type").alias("_type"),
        F.col("parent_method").alias("_method"),
        F.explode(F.sequence(block(line - context_lines), block(line + context_lines))).alias("_at"),
        F.struct(line.alias("line_no"), "source").alias("_line"),
    )
    bodies = code.groupBy("_file", "_type", "_method", "_at").agg(F.array_sort(F.collect_list("_line")).alias("_body"))
    owner = F.replace("root.class", F.lit("$"), F.lit(".")) if nested_dots else F.col("root.class")
    # Traces without a frame match nothing; dealt out by a hash they fill no one task.
    others = [c for c in rooted.columns if c != "root"]
    dealt = F.concat(F.lit("?"), F.pmod(F.xxhash64(*others), F.lit(4096)))
    keyed = rooted.withColumn("_owner", F.when(F.col("root").isNull(), dealt).otherwise(owner))
    same = (
        (F.col("_owner") == F.col("_type"))
        & (F.coalesce("root.method", F.lit("")) == F.col("_method"))
        & (F.coalesce(block(F.col("root.line")), F.lit(-1)) == F.col("_at"))
    )
    first, last = F.col("root.line") - context_lines, F.col("root.line") + context_lines
    near = F.filter("_body", lambda r: r["line_no"].between(first, last))
    found = F.struct(F.col("_file").alias("file_path"), F.col("_method").alias("parent_method"), F.col("_type").alias("parent_type"), F.col("_near").alias("lines"))
    met = keyed.join(bodies.hint("merge"), same, "left").withColumn("_near", near)
    return met.select(*rooted.columns, F.when(F.size("_near") > 0, found).alias("context"))


def _with_shared_context(rooted: DataFrame, lines: DataFrame, context_lines: int, nested_dots: bool) -> DataFrame:
    """``with_context`` for methods that any number of files declare."""
    lookups = rooted.select("root.class", "root.method", "root.line")
    contexts = method_context(lookups, lines, context_lines, nested_dots).select(
        F.col("class").alias("_c"), F.col("method").alias("_m"), F.col("line").alias("_l"), "context"
    )
    same = (
        (F.col("root.class") == F.col("_c"))
        & (F.col("root.method") == F.col("_m"))
        & (F.col("root.line") == F.col("_l"))
    )
    return rooted.join(contexts, same, "left").drop("_c", "_m", "_l")


def with_context(
    rooted: DataFrame, lines: DataFrame, context_lines: int = CONTEXT_LINES, nested_dots: bool = True
) -> DataFrame:
    """Rooted traces with ``context``, null where the root frame has no code.

    Methods that several files declare, by type and name, are told first; their traces and
    lines go a way of their own.
    """
    declared = lines.where(F.col("parent_type").isNotNull() & F.col("parent_method").isNotNull())
    files = declared.groupBy("parent_type", "parent_method", "file_path").agg(F.lit(1))
    shared = staged(
        files.groupBy(F.col("parent_type").alias("_s"), F.col("parent_method").alias("_n"))
        .agg(F.count("*").alias("_files"))
        .where(F.col("_files") > 1)
        .select("_s", "_n")
    )
    if shared.isEmpty():
        return _with_own_context(rooted, lines, context_lines, nested_dots)
    owner = F.replace("root.class", F.lit("$"), F.lit(".")) if nested_dots else F.col("root.class")
    of_trace = (owner == F.col("_s")) & (F.col("root.method") == F.col("_n"))
    of_line = (F.col("parent_type") == F.col("_s")) & (F.col("parent_method") == F.col("_n"))
    own, several = (
        way(rooted.join(shared, of_trace, how), declared.join(shared, of_line, how), context_lines, nested_dots)
        for way, how in ((_with_own_context, "left_anti"), (_with_shared_context, "left_semi"))
    )
    return own.unionByName(several)


def numbered_code(lines: Column) -> Column:
    shown = F.transform(lines, lambda r: F.format_string("%4d: %s", r["line_no"], r["source"]))
    return F.array_join(shown, "\n")


def prompt(trace: Column, root: Column, context: Column) -> Column:
    """The explanation request for one trace."""
    return F.concat(
        F.lit(_INTRODUCTION),
        text.strip(trace),
        F.lit("\n\nFailing Frame:\n- Class: "),
        root["class"],
        F.lit("\n- Method: "),
        root["method"],
        F.lit("\n- File: "),
        root["file"],
        F.lit("\n- Line: "),
        root["line"].cast("string"),
        F.lit("\n\nCode Around Line "),
        root["line"].cast("string"),
        F.lit(":\n"),
        numbered_code(context["lines"]),
        F.lit(_QUESTIONS),
    )


def explain(
    traces: DataFrame,
    lines: DataFrame,
    user_prefixes: Sequence[str],
    context_lines: int = CONTEXT_LINES,
    trace: str = "trace",
) -> DataFrame:
    """Every trace with ``root``, ``status`` and, where code was found, ``prompt``."""
    found = with_context(with_root(traces, user_prefixes, trace), lines, context_lines)
    status = (
        F.when(F.col("root").isNull(), "no_frames").when(F.col("context").isNull(), "no_context").otherwise("ok")
    )
    return found.select(
        "*",
        status.alias("status"),
        F.when(F.col("context").isNotNull(), prompt(F.col(trace), F.col("root"), F.col("context"))).alias("prompt"),
    ).drop("context")
