"""The corpus pipeline: documents to clean, distinct, redacted, encoded training texts.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.llm import bpe, decontamination, near_duplicates, secret_scan, toxicity
from lineloom.llm.stage import Stage

#: Percent of shared shingles of five words from which documents are near copies.
NEAR_PERCENT = 80


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; labels teach it, nothing else. Null
    and empty texts are scored as empty ones, repeated rows alike, rows without id too."""
    return toxicity.kept(docs, toxicity.learnt(docs, _table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id. Rows
    that repeat its id are the same document and stay; rows without id are kept."""
    return near_duplicates.distinct(docs, NEAR_PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item. Null and empty texts hold none and
    stay, repeated rows alike; an empty benchmark keeps all."""
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found secrets replaced by a mark. A null text stays null, an empty
    one empty; other columns are not changed."""
    return secret_scan.redacted(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and the text that the ids decode to. Null and empty texts
    have no ids and decode to an empty text; repeated rows stay."""
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenizer.round_trip(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", encoded),
]

#: Scores, minwise links and byte-pair merges have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    stage = Stage(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for number, (name, function) in enumerate(STAGES):
        docs = stage.keep(function(spark, docs, sf_dir), f"{number}-{name}")
        if number:
            stage.drop(f"{number - 1}-{STAGES[number - 1][0]}")
    return docs
