"""Text expressions: stripping, lines, comment marks, tokens, content classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that make a chunk a lone brace.
BRACES = ("}", "};", "{", "{;")
# Comment mark that closes a piece of a long span, by language.
COMMENT_MARKS = {"python": "#", "java": "//", "sql": "--"}
# Content classes in report order.
CONTENT_CLASSES = ("empty", "brace", "trivial_comment", "tiny", "normal")

TOKEN = r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]"
# Fixed value: colour codes of a terminal.
ANSI_CODE = r"\x1b\[[0-9;]*m"


# Fixed value: all characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Drop white space, of any kind, at both ends (plain ``trim`` drops spaces only)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITE_SPACE))


def is_blank(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITE_SPACE)) == ""


def starts_with_mark(c: Column, mark: str) -> Column:
    return F.ltrim(c, F.lit(WHITE_SPACE)).startswith(mark)


def count_chars(c: Column, chars: str) -> Column:
    """How many of a text's characters are among ``chars``."""
    rest = c
    for one in chars:
        rest = F.replace(rest, F.lit(one), F.lit(""))
    return F.length(c) - F.length(rest)


def unify_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\R", "\n")


def split_lines(c: Column) -> Column:
    """Lines without terminators; a final terminator opens no further line."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(c, r"\R\z", ""), r"\R")
    )


def newline_count(c: Column) -> Column:
    return count_chars(c, "\n")


def token_count(c: Column) -> Column:
    """Approximate token count: words and single marks."""
    return F.regexp_count(c, F.lit(TOKEN))


def strip_ansi(c: Column) -> Column:
    return F.regexp_replace(c, ANSI_CODE, "")


def full_match(c: Column, pattern: str) -> Column:
    return c.rlike(f"(?s)^(?:{pattern})\\z")


def content_class(source: Column) -> Column:
    """``struct<class, count>``: what a chunk holds and how many lines of it count."""

    def out(name: str, count: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), count.cast("int").alias("count"))

    def classed(lines: Column) -> Column:
        all_comment = F.forall(lines, lambda x: x.startswith("//") | x.startswith("/*"))
        real = F.size(F.filter(lines, lambda x: ~x.startswith("//")))
        lone_brace = (F.size(lines) == 1) & F.get(lines, 0).isin(*BRACES)
        return (
            F.when(F.size(lines) == 0, out("empty", F.lit(0)))
            .when(lone_brace, out("brace", F.lit(1)))
            .when((F.size(lines) <= 2) & all_comment, out("trivial_comment", F.size(lines)))
            .when(real < 3, out("tiny", real))
            .otherwise(out("normal", real))
        )

    lines = F.filter(F.transform(split_lines(source), strip), lambda x: x != "")
    # Passing the lines through a one-element array makes them once for all branches.
    return F.get(F.transform(F.array(lines), classed), 0)
