"""Byte-level BPE encoding and decoding with a transducer lexicon.

A text is cut at special tokens, then into words by the tokenizer's pattern. The words of a
slice of texts are looked up once each: frequent ones in a minimal acyclic transducer that
holds their ids, the others are merged exactly, many words at a time. The frequent words are
the entries of the vocabulary that their own merges give back whole: the vocabulary lists
them in the order of their frequency, so no pass over the corpus is needed, and the lexicon
is the same for every input.

The vocabulary is a ``tokenizers`` file whose path is a parameter; it is read by the driver.
Its fixed size (some MB) bounds what is broadcast. The lexicon is a file in the shared folder
that Spark hands to every executor, where workers map it.

Defined results: a null text is empty and has no ids; repeated rows give a row each. Other
columns are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.llm import texts
from lineloom.llm.lexicon import Lexicon, compiled
from lineloom.llm.stage import Stage

# Fixed value: the word pattern of byte-level BPE, with white space as Unicode defines it.
PATTERN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
)
#: Words that a worker remembers; beyond, it starts anew.
REMEMBERED = 150_000
#: Longer words are merged one by one with a heap.
LONG = 64
NONE = 1 << 30


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merges and bytes of a byte-level vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        letters = byte_letters()
        ids: dict[str, int] = told["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.bytes = [b""] * size
        for token, number in ids.items():
            self.bytes[number] = bytes(letters[c] for c in token)
        for token, number in self.special.items():
            self.bytes[number] = token.encode()
        self.byte_ids = np.array([ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        keys = np.array([(ids[a] << 17) | ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 17) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_long(self, word: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        rank = self.rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(rank) if r < NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q < len(ids):
                    s = int(self.rank(np.array([ids[p]]), np.array([ids[q]]))[0])
                    if s < NONE:
                        heapq.heappush(heap, (s, p, ids[p], ids[q]))
        return [i for i in ids if i >= 0]

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word: in every round, every open word merges its first pair of
        the lowest rank."""
        out: list[np.ndarray | None] = [None] * len(words)
        short = []
        for i, word in enumerate(words):
            if len(word) > LONG:
                out[i] = np.array(self.merge_long(word), np.int64)
            else:
                short.append(i)
        if not short:
            return out
        lengths = np.array([len(words[i]) for i in short])
        which = np.array(short)
        ids = self.byte_ids[np.frombuffer(b"".join(words[i] for i in short), np.uint8)]
        ends = np.cumsum(lengths)
        ranks = np.full(len(ids), NONE, np.int64)
        ranks[:-1] = self.rank(ids[:-1], ids[1:])
        ranks[ends - 1] = NONE
        while len(which):
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            best = np.minimum.reduceat((ranks << 32) + np.arange(len(ranks)), starts)
            open_ = (best >> 32) < NONE
            if not open_.all():
                ends = starts + lengths
                for row in np.flatnonzero(~open_):
                    out[which[row]] = ids[starts[row] : ends[row]]
                stay = np.repeat(open_, lengths)
                moved = np.cumsum(stay) - 1
                ids, ranks = ids[stay], ranks[stay]
                which, lengths, best = which[open_], lengths[open_], best[open_]
                if not len(which):
                    break
                place = moved[best & 0xFFFFFFFF]
            else:
                place = best & 0xFFFFFFFF
            ids[place] = self.merged[best >> 32]
            ranks[place] = ranks[place + 1]  # NONE at the end of a word
            keep = np.ones(len(ids), bool)
            keep[place + 1] = False
            left = np.cumsum(keep)[place] - 1
            ids, ranks = ids[keep], ranks[keep]
            lengths = lengths - 1
            ends = np.cumsum(lengths)
            starts = ends - lengths
            right = left[left < ends - 1]
            ranks[right] = self.rank(ids[right], ids[right + 1])
            ranks[left[left >= ends - 1]] = NONE
            before = left[left > starts] - 1
            ranks[before] = self.rank(ids[before], ids[before + 1])
        return out

    def frequent_words(self) -> dict[bytes, list[int]]:
        """The entries that their own merges give back whole."""
        known = [i for i, b in enumerate(self.bytes) if b and b.decode(errors="replace") not in self.special]
        merged = self.merge([self.bytes[i] for i in known])
        return {self.bytes[i]: [i] for i, m in zip(known, merged) if len(m) == 1 and m[0] == i}


class Words:
    """The ids of the words a worker has met."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.cut = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.forget()

    def forget(self) -> None:
        self.number = {token: i for i, token in enumerate(self.vocabulary.special)}
        self.ids = np.array(list(self.vocabulary.special.values()), np.int32)
        self.lengths = np.ones(len(self.ids), np.int64)
        self.starts = np.arange(len(self.ids))

    def of(self, text: str) -> list[str]:
        if self.cut is None or not any(token in text for token in self.vocabulary.special):
            return PATTERN.findall(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [part] if part in self.vocabulary.special else PATTERN.findall(part)
        return out

    def learn(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in raw])]).astype(np.int64)
        numbers = self.lexicon.numbers(np.frombuffer(b"".join(raw), np.uint8), offsets)
        unseen = np.flatnonzero(numbers < 0)
        ids = [self.lexicon.ids[self.lexicon.offsets[n] : self.lexicon.offsets[n + 1]] if n >= 0 else None for n in numbers.tolist()]
        for i, merged in zip(unseen.tolist(), self.vocabulary.merge([raw[i] for i in unseen.tolist()])):
            ids[i] = merged
        lengths = np.array([len(i) for i in ids], np.int64)
        self.number.update(zip(words, range(len(self.lengths), len(self.lengths) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, np.concatenate(ids).astype(np.int32)])

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the number of ids of each."""
        if len(self.number) > REMEMBERED:
            self.forget()
        words, sizes = [], []
        for text in batch:
            found = self.of(text)
            words += found
            sizes.append(len(found))
        if new := list(set(words).difference(self.number)):
            self.learn(new)
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        lengths = self.lengths[at]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.repeat(self.starts[at] - total[:-1], lengths) + np.arange(total[-1])]
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)])


class Decoder:
    """The bytes of all entries, one behind the other."""

    def __init__(self, vocabulary: Vocabulary):
        self.lengths = np.array([len(b) for b in vocabulary.bytes], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(vocabulary.bytes), np.uint8)

    def text(self, ids: np.ndarray) -> str:
        size = self.lengths[ids]
        total = np.cumsum(size)
        places = np.repeat(self.starts[ids] - total + size, size) + np.arange(total[-1] if len(total) else 0)
        return self.flat[places].tobytes().decode(errors="replace")


class Tokenizer:
    """A vocabulary and its lexicon, ready for the workers of one Spark session."""

    def __init__(self, spark: SparkSession, path: str):
        vocabulary = Vocabulary(path)
        stage = Stage(spark, "lexicon")
        name = stage.folder.rsplit("/", 1)[1] + ".fsa"
        spark.sparkContext.addFile(stage.put_bytes(name, compiled(vocabulary.frequent_words())))
        self.name, self.vocabulary = name, spark.sparkContext.broadcast(vocabulary)

    def encode(self, docs: DataFrame) -> DataFrame:
        """``doc_id`` and ``ids`` of every text."""
        return self._passed(docs, False)

    def round_trip(self, docs: DataFrame) -> DataFrame:
        """``doc_id``, ``ids`` and the ``text`` that they decode to, in one pass of one worker."""
        return self._passed(docs, True)

    def _passed(self, docs: DataFrame, decoded: bool) -> DataFrame:
        name, vocabulary = self.name, self.vocabulary

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Words(vocabulary.value, Lexicon(SparkFiles.get(name)))
            decoder = Decoder(vocabulary.value) if decoded else None
            for batch in batches:
                for first, last, data, offsets in texts.slices(batch.column(1)):
                    raw = data.tobytes()
                    ids, sizes = known.encode([raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])])
                    borders = np.concatenate([[0], np.cumsum(sizes)])
                    columns = [batch.column(0)[first:last], pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids, pa.int32()))]
                    if decoder:
                        columns.append(pa.array([decoder.text(ids[a:b]) for a, b in zip(borders, borders[1:])], pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"][: len(columns)])

        schema = "doc_id long, ids array<int>" + ", text string" * decoded
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)

    def decode(self, encoded: DataFrame) -> DataFrame:
        """``doc_id``, ``ids`` and their ``text``; bytes that are not UTF-8 become U+FFFD."""
        vocabulary = self.vocabulary

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            decoder = Decoder(vocabulary.value)
            for batch in batches:
                out = [decoder.text(np.asarray(row.values, np.int64) if row.is_valid else np.zeros(0, np.int64)) for row in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["doc_id", "ids", "text"])

        return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
