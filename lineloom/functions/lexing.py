"""Blank out literals and comments of one file, keeping its line structure.

Each function works on the whole text of a row, in one left-to-right pass of one
regular expression, so a quote inside a comment or a brace inside a string is
read as what it is. The result has exactly the lines of the input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix of a line that begins inside a multi-line string.
INSIDE = "\x01"

# What may be open where a line ends, by state: nothing, or a token that begins with the text.
OPEN = {"java": ("", "/*", "/**", '"""'), "python": ("", '"""', "'''")}

_ESCAPES = r"\\[\\\"']"
_JAVA = (
    r"(?s)/\*.*?(?:\*/|\z)|//[^\n]*|\"\"\".*?(?:\"\"\"|\z)"
    r"|\"[^\"\n]*\"?|'[^'\n]*'?|[^/\"']+|/"
)
_PYTHON = (
    r"(?s)#[^\n]*|\"\"\".*?(?:\"\"\"|\z)|'''.*?(?:'''|\z)"
    r"|\"[^\"\n]*\"?|'[^'\n]*'?|[^#\"']+"
)


def _tokens(content: Column, pattern: str) -> Column:
    plain = F.regexp_replace(content, _ESCAPES, "__")
    return F.regexp_extract_all(plain, F.lit(pattern), F.lit(0))


def open_after(content: Column, language: str, state: int) -> Column:
    """The state after whole lines of text that begin in ``state`` (a place in ``OPEN``)."""
    opener = OPEN[language][state]
    text = F.concat(F.lit(opener + "\n"), content) if opener else content
    last = F.try_element_at(_tokens(text, _JAVA if language == "java" else _PYTHON), F.lit(-1))
    out = F.lit(0)
    # Only an open token ends with the line; a longer opening is the more exact one.
    for number, begin in enumerate(OPEN[language]):
        if begin:
            out = F.when(last.startswith(begin) & last.endswith("\n"), number).otherwise(out)
    return F.coalesce(out, F.lit(0))


def _is_literal(t: Column) -> Column:
    return t.startswith('"') | t.startswith("'")


def java_tokens(content: Column) -> Column:
    return _tokens(content, _JAVA)


def java_code(tokens: Column) -> Column:
    """The text of ``java_tokens`` with comments as spaces and literals as underscores, place by place."""

    def piece(t: Column) -> Column:
        return (
            F.when(t.startswith("/*") | t.startswith("//"), F.regexp_replace(t, r"[^\n]", " "))
            .when(_is_literal(t), F.regexp_replace(t, r"[^\n]", "_"))
            .otherwise(t)
        )

    return F.array_join(F.transform(tokens, piece), "")


def java_marks(tokens: Column) -> Column:
    """Per line, one letter per token: ``c`` code, ``l`` line comment, ``b`` block
    comment, ``D`` first and ``d`` later lines of a documentation comment."""

    def piece(t: Column) -> Column:
        doc = F.regexp_replace(t, r"[^\n]+", "d")
        return (
            F.when(t.startswith("/**"), F.concat(F.lit("D"), F.substring(doc, 2, 2**31 - 1)))
            .when(t.startswith("/*"), F.regexp_replace(t, r"[^\n]+", "b"))
            .when(t.startswith("//"), F.lit("l"))
            .when(_is_literal(t), F.regexp_replace(t, r"[^\n]+", "c"))
            .otherwise(F.regexp_replace(F.regexp_replace(t, r"[^\s]+", "c"), r"[^\n\S]+", ""))
        )

    return F.array_join(F.transform(tokens, piece), "")


def python_code(content: Column) -> Column:
    """Python text with comments dropped and literals as underscores.

    Lines that begin inside a multi-line string get the prefix ``INSIDE``.
    """

    def piece(t: Column) -> Column:
        return (
            F.when(t.startswith("#"), F.lit(""))
            .when(
                _is_literal(t),
                F.regexp_replace(F.regexp_replace(t, r"[^\n]+", "_"), "\n", "\n" + INSIDE),
            )
            .otherwise(t)
        )

    return F.array_join(F.transform(_tokens(content, _PYTHON), piece), "")
