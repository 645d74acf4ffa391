"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. A passage is described by the shape of
its text: shares of kinds of characters, lengths and endings of words, words that repeat
nearby, distinct words. A layer encodes every passage; gated attention weighs the encodings;
the score is a logistic function of the weighted sum. All weights are learnt together from
document labels, so the attention finds the passages that tell.

Training takes at most ``EACH`` labelled rows of either label, each with all its passages;
only the passages' descriptions, of some half of the texts' size, leave the executors.
Gradients are summed over ``CHUNK`` passages at a time. The model has a fixed size.

Defined results: a null or wordless text has no passages, and its score is that of an empty
sum; repeated rows give a row each; without training rows of both labels every score is the
share of label 1. Labels, language, source and id never enter a score. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.llm import texts
from lineloom.llm.labelled import fold, sampled

PASSAGE = 50
EACH = 2500
THRESHOLD = 0.7
FOLDS, HELD = 4, 2
WIDTH, ROUNDS, BATCH, RATE = 16, 30, 64, 0.01
#: Passages whose encodings are held at once in training.
CHUNK = 1 << 15


def _kinds() -> np.ndarray:
    """Kinds of bytes, one row each: lower and upper case, digits, non-ASCII, white space,
    line ends, sentence marks, brackets and quotes, other marks, and each mark by itself."""
    text = [
        "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "", " \t\x0b\x0c\r", "\n", ".,;:?", "()[]{}\"'<>", "",
        *"!#$%&*+-/=@\\^_`|~",
    ]
    rows = np.zeros((len(text), 256), np.uint8)
    for row, characters in enumerate(text):
        rows[row, [ord(c) for c in characters]] = 1
    rows[3, 128:] = 1
    rows[8, 33:127] = rows[:8, 33:127].sum(0) == 0
    return rows


_KINDS = _kinds()
#: Bytes of the kinds above, then the measures over words.
FEATURES = len(_KINDS) + 11


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Descriptions of all passages of a slice of texts, and the number of passages of each."""
    starts, ends, rows = texts.words(data, offsets, texts.SPACED)
    counts = np.diff(rows)
    parts = -(-counts // PASSAGE)
    if not len(starts):
        return np.zeros((0, FEATURES), np.float32), parts
    row_of = np.repeat(np.arange(len(parts)), parts)
    within = np.arange(len(row_of)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = rows[row_of] + within * PASSAGE
    last = np.minimum(first + PASSAGE, rows[row_of + 1])  # behind the last word
    n = (last - first).astype(float)
    begin, end = starts[first], ends[last - 1]
    size = (end - begin).astype(float)
    out = np.empty((len(first), FEATURES))

    def over(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[b] - total[a]

    for k, kind in enumerate(_KINDS):
        out[:, k] = over(kind[data], begin, end) / size
    word = texts.word_hashes(texts.LOWER[data], starts, ends)
    part = np.repeat(np.arange(len(first)), last - first)
    lengths = ends - starts
    tail, head = data[ends - 1], data[starts]
    letters = _KINDS[0] + _KINDS[1] + _KINDS[3]
    k = len(_KINDS)
    for lag in (1, 2, 3):
        same = np.zeros(len(word), np.int64)
        same[lag:] = (word[lag:] == word[:-lag]) & (part[lag:] == part[:-lag])
        out[:, k + lag - 1] = over(same, first, last) / n
    order = np.lexsort((word, part))
    fresh = np.ones(len(word), np.int64)
    fresh[1:] = (word[order][1:] != word[order][:-1]) | (part[order][1:] != part[order][:-1])
    out[:, k + 3] = over(fresh, first, last) / n
    out[:, k + 4] = np.log1p(over(lengths, first, last) / n)
    out[:, k + 5] = over(lengths > 12, first, last) / n
    out[:, k + 6] = over(lengths <= 3, first, last) / n
    out[:, k + 7] = over(letters[tail] == 0, first, last) / n
    out[:, k + 8] = over(letters[head] == 0, first, last) / n
    out[:, k + 9] = over(_KINDS[6][tail], first, last) / n
    out[:, k + 10] = n / PASSAGE
    return out.astype(np.float32), parts


def _encoded(w: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Encodings of passages, gates, tones and attention before it is shared out."""
    h = np.tanh(x @ w["encode"] + w["encode0"])
    gate = 1 / (1 + np.exp(-(h @ w["gate"])))
    tone = np.tanh(h @ w["tone"])
    return h, gate, tone, np.exp(np.clip((tone * gate) @ w["attend"], -30, 30))


def _sums(h: np.ndarray, a: np.ndarray, bags: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(bags, a * h[:, k], n) for k in range(h.shape[1])], 1) if len(bags) else np.zeros((n, h.shape[1]))


def _scored(w: dict[str, np.ndarray], z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"][0], -30, 30)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """All passages ``x`` of ``n`` texts; ``bags`` (sorted) says whose they are."""
    h, _, _, a = _encoded(w, x)
    z = _sums(h, a / np.bincount(bags, a, n)[bags], bags, n)
    return {"z": z, "p": _scored(w, z)}


def _gradient(w, x, bags, y, weight, rows=None):
    """``rows``: the passages of ``x`` that are meant, all by default."""
    rows = np.arange(len(bags)) if rows is None else rows
    parts = [slice(at, at + CHUNK) for at in range(0, len(bags), CHUNK)]
    n, held = len(y), None
    total, z = np.zeros(n), np.zeros((n, len(w["out"])))
    for part in parts:
        own = x[rows[part]].astype(float)
        held = own, *_encoded(w, own)
        total += np.bincount(bags[part], held[4], n)
        z += _sums(held[1], held[4], bags[part], n)
    z /= np.where(total > 0, total, 1)[:, None]
    d = (_scored(w, z) - y) * weight / weight.sum()
    g = {k: np.zeros_like(v) for k, v in w.items()} | {"out": z.T @ d, "out0": np.array([d.sum()])}
    mean = d * (z @ w["out"])
    for part in parts:
        if len(parts) > 1:
            own = x[rows[part]].astype(float)
            held = own, *_encoded(w, own)
        own, h, gate, tone, a = held
        a = a / total[bags[part]]
        dz = np.outer(d, w["out"])[bags[part]]
        dh = a[:, None] * dz
        de = a * ((dz * h).sum(1) - mean[bags[part]])
        g["attend"] += (tone * gate).T @ de
        both = np.outer(de, w["attend"])
        dtone = both * gate * (1 - tone**2)
        dgate = both * tone * gate * (1 - gate)
        g["tone"] += h.T @ dtone
        g["gate"] += h.T @ dgate
        dh += dtone @ w["tone"].T + dgate @ w["gate"].T
        dx = dh * (1 - h**2)
        g["encode"] += own.T @ dx
        g["encode0"] += dx.sum(0)
    return g


def described(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """All passages of the training rows, where those of each row begin (one more at the
    end), the rows' labels, and the share of label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, data, offsets in texts.slices(batch.column(0)):
                x, parts = passages(data, offsets)
                found += [own.tobytes() for own in np.split(x, np.cumsum(parts)[:-1])]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1)], ["passages", "label"])

    taken, share = sampled(docs, labels, "quality", FOLDS, HELD, EACH)
    table = taken.mapInArrow(run, "passages binary, label int").toArrow()
    rows = [np.frombuffer(own.as_buffer(), np.float32).reshape(-1, FEATURES) for own in table.column("passages")]
    borders = np.concatenate([[0], np.cumsum([len(own) for own in rows])]).astype(int)
    x = np.concatenate([np.zeros((0, FEATURES), np.float32), *rows])
    return x, borders, np.asarray(table.column("label"), float), share


def fitted(x: np.ndarray, borders: np.ndarray, y: np.ndarray, share: float) -> Model:
    """Adam over mini-batches of texts, by a fixed seed; ``x`` is overwritten."""
    draw = np.random.default_rng(8)
    w = {
        "encode": draw.normal(0, FEATURES**-0.5, (FEATURES, WIDTH)), "encode0": np.zeros(WIDTH),
        "gate": draw.normal(0, WIDTH**-0.5, (WIDTH, WIDTH)), "tone": draw.normal(0, WIDTH**-0.5, (WIDTH, WIDTH)),
        "attend": np.zeros(WIDTH), "out": draw.normal(0, WIDTH**-0.5, WIDTH), "out0": np.zeros(1),
    }
    if not len(y) or y.min() == y.max():
        share = min(max(share, 1e-3), 1 - 1e-3)
        w |= {"out": np.zeros(WIDTH), "out0": np.array([np.log(share / (1 - share))])}
        return Model(np.zeros(FEATURES), np.ones(FEATURES), w)
    parts, n = [slice(at, at + CHUNK) for at in range(0, len(x), CHUNK)], max(len(x), 1)
    mean = sum((x[part].sum(0, dtype=float) for part in parts), np.zeros(FEATURES)) / n
    spread = np.maximum(np.sqrt(sum((((x[part] - mean) ** 2).sum(0) for part in parts), np.zeros(FEATURES)) / n), 1e-3)
    for part in parts:
        x[part] = np.clip((x[part] - mean) / spread, -8, 8)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())) ** 0.5
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for turn in range(ROUNDS):
        order = draw.permutation(len(y))
        for at in range(0, len(y), BATCH):
            step += 1
            chosen = order[at : at + BATCH]
            rows = np.concatenate([np.arange(borders[i], borders[i + 1]) for i in chosen])
            bags = np.repeat(np.arange(len(chosen)), borders[chosen + 1] - borders[chosen])
            g = _gradient(w, x, bags, y[chosen], weight[chosen], rows)
            rate = RATE * (1 - turn / ROUNDS)
            for k in w:
                slope = g[k] + 1e-4 * w[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, spread, w)


def scores(model: Model, column: pa.Array) -> np.ndarray:
    out = [np.zeros(0)]
    for _, _, data, offsets in texts.slices(column):
        x, parts = passages(data, offsets)
        x = np.clip((x - model.mean) / model.spread, -8, 8)
        out.append(_forward(model.weights, x, np.repeat(np.arange(len(parts)), parts), len(parts))["p"])
    return np.concatenate(out)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    known = docs.sparkSession.sparkContext.broadcast(fitted(*described(docs, labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(known.value, batch.column(1)))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
