"""Chunk ids, content classes, token limits, errors and their reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineloom.functions import text
from lineloom.schemas import ERRORS, MAX_TOKENS

Tokenizer = Callable[[Column], Column]


def chunk_id(*parts: str | Column) -> Column:
    """A stable id from the parts; the same chunk gets the same id in every run."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256)


def with_ids(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn(
        "chunk_id", chunk_id("file_path", "type", "name", "chunk_no", "start_line", "end_line", "source")
    )


def no_errors() -> Column:
    return F.array().cast(ERRORS)


def put_error(errors: Column, source: str, error: Column) -> Column:
    """Replace the entry of ``source`` by ``error``, or drop it where that is null.

    A step that runs twice so leaves one entry.
    """
    others = F.filter(errors, lambda e: e["source"] != source)
    entry = F.struct(F.lit(source).alias("source"), error.alias("error"))
    return F.when(error.isNull(), others).otherwise(F.array_append(others, entry)).cast(ERRORS)


def is_clean(errors: Column | None = None) -> Column:
    return F.size(F.col("errors") if errors is None else errors) == 0


def classify(chunks: DataFrame) -> DataFrame:
    """Add ``content_class`` and the ``line_count`` that goes with it."""
    found = text.content_class(F.col("source"))
    return chunks.withColumn("_c", found).select(
        *chunks.columns, F.col("_c.class").alias("content_class"), F.col("_c.count").alias("line_count")
    )


def validate(
    chunks: DataFrame, max_tokens: int = MAX_TOKENS, tokenizer: Tokenizer = text.token_count
) -> DataFrame:
    """Count tokens, note an error on chunks over the limit, and classify.

    ``tokenizer`` turns the text column into a count column: a built-in expression
    or a pandas UDF around a real tokenizer.
    """
    counted = chunks if "errors" in chunks.columns else chunks.withColumn("errors", no_errors())
    counted = counted.withColumn("token_count", tokenizer(F.col("source")))
    # Fixed value: the wording of the message.
    message = F.concat(
        F.lit("chunk "),
        F.col("chunk_id"),
        F.lit(" too large: "),
        F.col("token_count"),
        F.lit(f" tokens while maximum is {max_tokens}"),
    )
    over = F.when(F.col("token_count") > max_tokens, message)
    return classify(counted.withColumn("errors", put_error(F.col("errors"), "validation", over)))


def validation_summary(validated: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row: chunks within and over the limit, and chunks per content class."""
    over = F.col("token_count") > max_tokens
    return validated.agg(
        F.count_if(~over).alias("ok"),
        F.count_if(over).alias("over_limit"),
        *[F.count_if(F.col("content_class") == c).alias(c) for c in text.CONTENT_CLASSES],
    )


def error_counts(chunks: DataFrame) -> DataFrame:
    return chunks.agg(
        F.count_if(is_clean()).alias("correct"), F.count_if(~is_clean()).alias("with_errors")
    )


def error_rows(chunks: DataFrame) -> DataFrame:
    """One row per error of a chunk."""
    return chunks.select("chunk_id", F.explode("errors").alias("e")).select("chunk_id", "e.source", "e.error")


def cleanup(chunks: DataFrame) -> DataFrame:
    """What stays after a cleanup: the chunks with errors."""
    return chunks.where(~is_clean())


def with_status(chunks: DataFrame) -> DataFrame:
    """``failed`` with errors, ``embedded`` with a vector, else ``ready``."""
    return chunks.withColumn(
        "status",
        F.when(~is_clean(), "failed").when(F.col("embedding").isNotNull(), "embedded").otherwise("ready"),
    )
