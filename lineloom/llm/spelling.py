"""Spelling variants grouped under their most frequent form, by k-d trees over letter counts.

Words and their numbers are counted over all texts in the JVM. Words that are one inserted,
deleted or replaced letter apart are found by range searches: a word of length L looks among words
of length L, L - 1 and L + 1. ``letter_tree`` says how boxes are pruned and letters verified.

The words of one length may be too many for a task. So a tree of a length is cut into cells:
its upper part is built from a sample of at most ``SAMPLE`` words, those of the least hashes, and
travels with the tasks; it only decides where a word lies. Every word goes to its own
cell, and, to be answered, to all cells its box meets. A cell has about ``CELL`` words, and a
leaf of the upper tree that stands for more, because the sample cannot part it further, is dealt
to several blocks. Each block builds the lower part of the tree over all its words and
answers the words sent to it as they stream by, with the number of near words and the best
of them; these are combined by word. No pair of words leaves a task.

A word's form is its most frequent near word, if that is ``TIMES`` as frequent; so numbers grow
along forms by that factor, and roots are found by doubling steps in a few rounds.

Defined results: null and empty texts have no words; a row without id hashes as an empty id;
repeated rows count as often as they stand; an empty table gives no rows. Ties go to the first word
in code-point order. Other columns than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.llm import letter_tree, texts
from lineloom.llm.letter_tree import Cell, LetterTree
from lineloom.llm.stage import Stage

#: Runs of letters; a word has ``LEAST_LENGTH`` letters and stands ``LEAST_COUNT`` times at least.
LETTERS = "a-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: One run in so many, by its hash, loses a letter.
EVERY = 31
#: So many times a word's number has its form's at least.
TIMES = 10
#: Words the upper trees are built from; words of a cell; least sampled words of a cell.
SAMPLE, CELL, LEAST_SAMPLED = 1 << 16, 1 << 14, 16
#: Words answered at once.
AT_ONCE = 4096
#: What a row is to its cell: one of its words, or a word of the same length, a longer or a shorter one to be answered.
POINT, SAME, LONGER, SHORTER = range(4)
_STEPS = {SAME: (0, 1, 1), LONGER: (-1, 0, 1), SHORTER: (1, 1, 0)}


def words(docs: DataFrame) -> DataFrame:
    """``word`` and its number ``n`` over all texts."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # shorter runs give no word whether they lose a letter or not
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"),
    )
    chosen = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    runs = runs.select("run", chosen.alias("h")).withColumn("at", at)
    found = runs.select(F.when(F.col("h") % EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    found = found.filter(F.length("word") >= LEAST_LENGTH)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _bytes(column: pa.Array) -> list[bytes]:
    """Words as one byte for each letter."""
    return [w.encode("latin-1") for w in column.to_pylist()]


class Cells:
    """The upper trees of all lengths. A cell is named by length and leaf, a block by a number behind them."""

    def __init__(self, sampled: list[bytes], total: int):
        each = max(1.0, total / max(1, len(sampled)))
        leaf = max(LEAST_SAMPLED, int(CELL / each))
        self.trees: dict[int, LetterTree] = {}
        self.blocks: dict[int, np.ndarray] = {}
        by_length: dict[int, list[bytes]] = {}
        for word in sampled:
            by_length.setdefault(len(word), []).append(word)
        for length, own in by_length.items():
            tree = LetterTree.built(letter_tree.counts(letter_tree.letters(own)), leaf)
            sizes = np.where(tree.dimension < 0, tree.right - tree.left, 0)
            self.trees[length] = tree
            self.blocks[length] = np.maximum(1, np.ceil(sizes * each / (2 * CELL))).astype(np.int64)

    def of(self, words: list[bytes], length: int, up: int, down: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``words`` (all of one length), the leaf of the tree of ``length`` each meets, and its blocks."""
        if length not in self.trees:  # too rare to be in the sample: one cell
            return np.arange(len(words)), np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
        row, leaf = self.trees[length].leaves(letter_tree.counts(letter_tree.letters(words)), up, down)
        return row, leaf, self.blocks[length][leaf]


def _routed(known):
    """Rows of (length, leaf, block, kind, word, n) for the cells of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = known.value
        for batch in batches:
            own, n = _bytes(batch.column(0)), np.asarray(batch.column(1), np.int64)
            sizes = np.array([len(w) for w in own])
            for length in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == length)
                part = [own[i] for i in rows]
                hashes = texts.mix(np.array([crc32(w) for w in part], np.uint64))
                for kind in (POINT, SAME, LONGER, SHORTER):
                    step, up, down = _STEPS.get(kind, (0, 0, 0))
                    row, leaf, blocks = cells.of(part, length + step, up, down)
                    if kind == POINT:
                        block = (hashes[row] % blocks.astype(np.uint64)).astype(np.int64)
                    else:
                        row, leaf, blocks = np.repeat(row, blocks), np.repeat(leaf, blocks), blocks
                        block = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    places = pa.array(rows[row])
                    same = [pa.array(np.full(len(row), v, t)) for v, t in ((length + step, np.int32), (kind, np.int32))]
                    columns = [same[0], pa.array(leaf.astype(np.int32)), pa.array(block.astype(np.int32)), same[1], batch.column(0).take(places), pa.array(n[rows[row]])]
                    yield pa.RecordBatch.from_arrays(columns, ["length", "leaf", "block", "kind", "word", "n"])

    return run


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and kind: builds each cell's tree and answers the words that follow."""
    key, cell = None, None
    points: list[tuple[list[bytes], np.ndarray]] = []
    for batch in batches:
        where = np.stack([np.asarray(batch.column(c), np.int64) for c in range(4)], 1)
        borders = np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1
        for first, last in zip([0, *borders], [*borders, len(where)]):
            if first == last:
                continue
            place, kind = tuple(where[first, :3]), where[first, 3]
            if place != key:
                key, cell, points = place, None, []
            part = batch.slice(first, last - first)
            if kind == POINT:
                points.append((_bytes(part.column(4)), np.asarray(part.column(5), np.int64)))
                continue
            if cell is None and points:
                cell, points = Cell([w for own, _ in points for w in own], np.concatenate([n for _, n in points])), []
            for at in range(0, part.num_rows if cell else 0, AT_ONCE):
                asked = part.column(4).slice(at, AT_ONCE)
                near, best = cell.near(_bytes(asked))
                hit = np.flatnonzero(near)
                best = best[hit]
                columns = [asked.take(pa.array(hit)), pa.array(near[hit]), pa.array(cell.n[best]), pa.array([cell.words[b].decode("latin-1") for b in best], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])


def nearest(counted: DataFrame) -> DataFrame:
    """For each ``word`` of ``counted`` (with ``n``) that has near words: how many, and the best."""
    spark = counted.sparkSession
    total = counted.count()
    sampled = counted.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE).toArrow().column("word")
    known = spark.sparkContext.broadcast(Cells([w for chunk in sampled.chunks for w in _bytes(chunk)], total))
    routed = counted.mapInArrow(_routed(known), "length int, leaf int, block int, kind int, word string, n long")
    dealt = routed.repartition("length", "leaf", "block").sortWithinPartitions("length", "leaf", "block", "kind")
    answers = dealt.mapInArrow(_answers, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    near = answers.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("near"))
    return near.select("word", "n_near", F.col("near.best").alias("near"), (-F.col("near.less")).alias("near_count"))


def variants(docs: DataFrame) -> DataFrame:
    """For each word its ``form``, the ``root`` of its forms, its number ``n``, the number of
    near words ``n_near`` and its form's number ``form_n``."""
    stage = Stage(docs.sparkSession, "spelling")
    counted = stage.keep(words(docs), "words")
    has_form = F.col("near_count") >= TIMES * F.col("n")
    formed = counted.join(nearest(counted), "word", "left").select(
        "word",
        F.when(has_form, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("near_count")).alias("form_n"),
    )
    formed = stage.keep(formed, "forms")
    # the longest chain of forms, each TIMES as frequent, is below this power of two
    most = formed.agg(F.max("form_n")).first()[0] or 0
    steps, number = 0, LEAST_COUNT
    while number * TIMES <= most:
        steps, number = steps + 1, number * TIMES
    up = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for turn in range(max(0, steps - 1).bit_length()):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        up = stage.keep(up.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), f"roots-{turn}")
    return formed.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
