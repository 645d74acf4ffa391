"""Benchmark decontamination by one Aho-Corasick automaton over normalised windows.

Items and documents are brought to lower-cased alphanumeric words between single spaces.
Every run of ``n`` words of an item (an item of fewer words: the whole item) is a pattern;
one pass over a normalised document finds all of them, and word numbers lead back to code
points of the original text.

Defined results: null texts and texts without words have no words and no hits; repeated
rows give a row each; an empty item, or an empty table of items, hits nothing; an item
without id marks words but is not listed. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.llm import texts
from lineloom.llm.stage import Stage

WINDOW = 10
#: Bytes of patterns in one automaton. Benchmarks beyond it are searched by a chain of
#: automata, one Python worker each, so no worker holds more.
AUTOMATON_BYTES = 32 << 20

FOUND = "doc_id long, text string, n_words long, hits binary, items array<string>"


def windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """Distinct windows of the items with the ids of the items that hold them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = texts.normal((text or "").encode()).decode().split(" ")[1:-1]
                for at in range(max(1, len(words) - n + 1) if words else 0):
                    names.append(item)
                    found.append(f" {' '.join(words[at : at + n])} ")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())], ["item", "pattern"])

    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text")).mapInArrow(cut, "item string, pattern string")
    return rows.groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _automata(items: DataFrame, n: int) -> Iterator[Broadcast]:
    """The patterns with their items, in groups of at most ``AUTOMATON_BYTES``, items counted as
    well; a group is collected at a time and left to the machines before the next is."""
    spark = items.sparkSession
    stage = Stage(spark, "windows")
    table = stage.keep(windows(items, n), "patterns")
    bytes_ = F.octet_length("pattern") + F.octet_length(F.array_join("items", ","))
    total = table.agg(F.sum(bytes_.cast("long"))).first()[0] or 0
    parts = -(-2 * total // AUTOMATON_BYTES) or 1
    for part in range(parts):
        rows = table.filter(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == part).collect()
        yield spark.sparkContext.broadcast([(r.pattern, list(r["items"])) for r in rows])
    stage.drop("")


def _merged(spans: list[tuple[int, int]]) -> np.ndarray:
    """Sorted disjoint intervals that cover the same words; those that only touch stay apart."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return np.array(out, np.int64).reshape(-1, 2)


def _scan(patterns):
    """Adds the hits of one automaton to ``hits`` (word intervals) and ``items``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for number, (pattern, _) in enumerate(patterns.value):
            machine.add_word(pattern, (number, pattern.count(" ") - 1))
        machine.make_automaton()
        some = len(machine) > 0
        for batch in batches:
            counts, hits, named = [], [], []
            for text, before, items in zip(batch.column(1), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                plain = texts.normal(text.as_buffer().to_pybytes()) if text.is_valid else b""
                counts.append(plain.count(b" ") - 1 if plain else 0)
                plain = plain.decode()
                found = list(machine.iter(plain)) if some and plain else []
                if found:
                    blanks = np.flatnonzero(np.frombuffer(plain.encode("utf-32-le"), np.uint32) == 32)
                    last = np.searchsorted(blanks, [end for end, _ in found])
                    spans = [(int(end) - size, int(end)) for end, (_, size) in zip(last, (value for _, value in found))]
                    before = _merged([*spans, *map(tuple, np.frombuffer(before, np.int64).reshape(-1, 2))]).tobytes()
                    items = sorted({*items, *(name for number in {value[0] for _, value in found} for name in patterns.value[number][1])})
                hits.append(before)
                named.append(items)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(hits, pa.binary()), pa.array(named, pa.list_(pa.string()))],
                ["doc_id", "text", "n_words", "hits", "items"],
            )

    return run


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word intervals to code points of the original text."""
    for batch in batches:
        n_hit, spans = [], []
        for text, hits in zip(batch.column(1), batch.column(3).to_pylist()):
            parts = np.frombuffer(hits, np.int64).reshape(-1, 2)
            n_hit.append(int((parts[:, 1] - parts[:, 0]).sum()))
            if not len(parts):
                spans.append([])
                continue
            raw = text.as_buffer().to_pybytes()
            data = np.frombuffer(raw, np.uint8)
            starts, ends, _ = texts.words(data, np.array([0, len(data)]), texts.ALNUM[texts.LOWER])
            points = texts.char_ends(raw)
            spans.append([{"start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in parts])
        place = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n_hit, pa.int64()), batch.column(4), pa.array(spans, pa.list_(place))],
            ["doc_id", "n_words", "n_hit", "items", "spans"],
        )


def contamination(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """For each document its words, the words inside windows of ``items``, the ids of
    those items (as sorted strings) and the hit spans in code points of the original."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(b"").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    for patterns in _automata(items, n):
        rows = rows.mapInArrow(_scan(patterns), FOUND)
    return rows.mapInArrow(_offsets, "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>")


def clean(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """The documents without a hit, with the columns they came with.

    The scan runs beside the row and is joined to nothing: text goes through it and comes
    back with the verdict. A document is kept or dropped by its own text alone.
    """
    rows = docs
    for patterns in _automata(items, n):
        rows = rows.mapInArrow(_drop(patterns, docs.columns.index("text")), docs.schema)
    return rows


def _drop(patterns, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for pattern, _ in patterns.value:
            machine.add_word(pattern, 1)
        machine.make_automaton()
        some = len(machine) > 0
        for batch in (part for whole in batches for part in texts.parts(whole, column)):
            kept = []
            for text in batch.column(column):
                plain = texts.normal(text.as_buffer().to_pybytes()).decode() if text.is_valid else ""
                kept.append(not (some and plain and next(machine.iter(plain), None)))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return run
