"""Toxicity by weak supervision.

Voters are looked for in a bounded sample of labelled training rows: words (lexicon voters)
and word beginnings of a few characters (pattern voters) that toxic texts hold far more
often than others (also: hold a beginning several times), and one voter for the absence of them all. A generative label model then
forgets the labels: it estimates by expectation and maximisation how often each voter fires
on either hidden class, and from the votes' correlation within the classes how much voters
repeat each other; repeated votes count less. Its posteriors are the labels on which a
linear classifier over the votes is trained. Every text is scored by the classifier, by one
pass of an automaton over its words.

The sample holds at most ``EACH`` rows of either label and the model at most ``VOTERS``
voters, so what is broadcast is bounded.

Defined results: null and wordless texts have no votes and get the score of a text without
any; repeated rows give a row each; without training rows of both labels there are no voters
and every score is the share of label 1. Labels, language, source and id never enter a
score. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.llm import texts
from lineloom.llm.labelled import fold, sample

EACH, VOTERS = 4000, 128
BEGINNINGS, NEEDED = (4, 5, 6, 7, 8), (1, 3)
#: A voter must be this many times as frequent in toxic texts.
RATIO = 20.0
#: A voter must fire on this share of the toxic texts; groups of copies hold rarer words.
SUPPORT = 0.02
#: A longer pattern that fires this share as often takes the place of the shorter.
SAME = 0.9
THRESHOLD = 0.3
FOLDS, HELD = 4, 2


class Model(NamedTuple):
    patterns: tuple[tuple[str, int], ...]
    weights: np.ndarray
    intercept: float


def _terms(text: str) -> set[tuple[str, int]]:
    """Voters that fire on a text: `` word `` and `` beginning``, with how often it must stand there."""
    words = Counter(texts.normal(text.encode()).decode().split(" ")[1:-1])
    begun: Counter = Counter()
    for word, n in words.items():
        for k in BEGINNINGS:
            if len(word) >= k:
                begun[word[:k]] += n
    return {(f" {w} ", 1) for w in words} | {(f" {b}", need) for b, n in begun.items() for need in NEEDED if n >= need}


def voters(rows: list[tuple[str, int]]) -> tuple[tuple[str, int], ...]:
    """The most frequent patterns that mark toxic texts. Of a pattern and a longer one that
    fires nearly as often, the longer stays; what fires only inside another that is as pure
    goes."""
    sizes = Counter(label for _, label in rows)
    if not sizes[0] or not sizes[1]:
        return ()
    by = {0: Counter(), 1: Counter()}
    for text, label in rows:
        by[label].update(_terms(text))
    # by a cautious estimate: two deviations below for toxic texts, one text more for others
    found = {t for t, n in by[1].items() if n >= max(5, SUPPORT * sizes[1]) and (n - 2 * n**0.5) / sizes[1] >= RATIO * (by[0][t] + 1) / sizes[0]}

    def begun(term: tuple[str, int]) -> list[tuple[str, int]]:
        return [short for k in BEGINNINGS if k + 1 < len(term[0]) and (short := (term[0][: k + 1], term[1])) in found]

    for term in sorted(found, key=lambda t: len(t[0])):
        for short in begun(term):
            if by[1][term] >= SAME * by[1][short]:
                found.discard(short)
    found -= {t for t in found if any(by[0][short] <= by[0][t] * by[1][short] / by[1][t] for short in begun(t))}
    return tuple(sorted(found, key=lambda t: (-by[1][t], t))[:VOTERS])


def _machine(patterns: tuple[tuple[str, int], ...]) -> ahocorasick.Automaton:
    by: dict[str, list[int]] = {}
    for number, (pattern, _) in enumerate(patterns):
        by.setdefault(pattern, []).append(number)
    machine = ahocorasick.Automaton()
    for pattern, numbers in by.items():
        machine.add_word(pattern, numbers)
    machine.make_automaton()
    return machine


def votes(machine: ahocorasick.Automaton, patterns: tuple[tuple[str, int], ...], batch: list[bytes]) -> np.ndarray:
    """Which voters fire on each text; the last voter fires where no other does."""
    n = len(patterns)
    out = np.zeros((len(batch), n + 1), np.float32)
    for row, text in enumerate(batch):
        plain = texts.normal(text).decode()
        if n and plain:
            for _, numbers in machine.iter(plain):
                out[row, numbers] += 1
    out[:, :n] = out[:, :n] >= np.array([need for _, need in patterns])
    out[:, n] = out[:, :n].max(1, initial=0) == 0
    return out


def label_model(v: np.ndarray, prior: float, rounds: int = 50) -> np.ndarray:
    """Posterior of the toxic class for each row of votes, learnt without labels."""
    p = np.where(v[:, -1] == 1, 0.05, 0.95)
    weight = np.ones(v.shape[1])
    for _ in range(rounds):
        on = (p @ v + 0.1) / (p.sum() + 0.2)  # how often each voter fires on either class
        off = ((1 - p) @ v + 0.1) / ((1 - p).sum() + 0.2)
        centred = v - np.outer(p, on) - np.outer(1 - p, off)
        spread = centred.T @ centred / len(v)
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-6))
        repeated = np.maximum(spread / np.outer(scale, scale), 0)
        np.fill_diagonal(repeated, 0)
        weight = 1 / (1 + repeated.sum(1))
        fired, silent = np.log(on / off), np.log((1 - on) / (1 - off))
        logit = np.log(prior / (1 - prior)) + v @ (weight * fired) + (1 - v) @ (weight * silent)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        done = np.abs(new - p).max() < 1e-6
        p = new
        if done:
            break
    return p


def linear(v: np.ndarray, p: np.ndarray, row_weight: np.ndarray, ridge: float = 1e-4, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by damped Newton steps."""
    x = np.hstack([v, np.ones((len(v), 1))]).astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (row_weight * (q - p)) / row_weight.sum() + ridge * w
        bend = (x * (row_weight * q * (1 - q))[:, None]).T @ x / row_weight.sum() + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step * min(1, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fitted(rows: list[tuple[str, int]], share: float) -> Model:
    patterns = voters(rows)
    share = min(max(share, 1e-3), 1 - 1e-3)
    if not patterns:
        return Model((), np.zeros(1), float(np.log(share / (1 - share))))
    v = votes(_machine(patterns), patterns, [text.encode() for text, _ in rows])
    toxic = np.mean([label for _, label in rows])
    p = label_model(v, min(max(toxic, 0.01), 0.99))
    # the sample is balanced by label: weigh the hidden classes back to their shares
    weight = p * share / max(p.mean(), 1e-3) + (1 - p) * (1 - share) / max(1 - p.mean(), 1e-3)
    return Model(patterns, *linear(v, p, weight))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every text."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(known.value.patterns)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(machine, known.value, batch.column(1)))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def _scores(machine, model: Model, column: pa.Array) -> np.ndarray:
    out = [np.zeros(0)]
    for _, _, data, offsets in texts.slices(column):
        raw = data.tobytes()
        v = votes(machine, model.patterns, [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])])
        out.append(1 / (1 + np.exp(-np.clip(v @ model.weights + model.intercept, -30, 30))))
    return np.concatenate(out).astype(float)


def learnt(docs: DataFrame, labels: DataFrame) -> Model:
    return fitted(*sample(docs, labels, "toxic", FOLDS, HELD, EACH))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    return scored(docs, learnt(docs, labels)).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that the model does not call toxic, with the columns they came with."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(known.value.patterns)
        for batch in (part for whole in batches for part in texts.parts(whole, at)):
            yield batch.filter(pa.array(_scores(machine, known.value, batch.column(at)) < THRESHOLD, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
