"""Language-model scores from a probabilistic suffix tree over words, kept as tables.

Symbols are lower-cased words and one end per text. The tree grows a word at a time, back
from the symbol that is told: a context is a candidate if it stands ``LEAST_STATE`` times in
the training texts, its longest suffix is a state and its words but the last are a candidate
(so that its count is known from the level before). It becomes a state if its next symbols
diverge from those of the suffix: the log likelihood it gains over the suffix, each
occurrence left out of its own estimate, must exceed ``GAIN`` nats. Levels are added until no
candidate passes. The least counts are absolute, so a context kept on a small corpus stays
when the corpus grows, and the tree grows with the corpus.

In a state ``s`` a next symbol seen ``c >= LEAST_LISTED`` times in ``n`` has the probability
``(c - DISCOUNT) / n + left(s) * p`` and any other ``left(s) * p``, where ``p`` is that of the
suffix and ``left`` is what discounts and unlisted symbols free; the root is the add-one
distribution over all words. So the log probability of a text is a plain sum: every sequence
of words in it that is a state adds ``log left``, every one that is a listed symbol after a
state adds by how much it is likelier than ``left * p``, every word adds its root value. The
tree is a table of such values by the 64-bit key of the sequence, and scoring is a join of
the texts' sequences with it.

What is broadcast has a bounded size: values of the ``HOT`` most frequent sequences, summed
where the texts are read, and a bit filter of at most ``2 ** FILTER_BITS`` bits that says which other
sequences may be in the table. A filter that fills up lets more keys into the join, which is
exact, so results do not depend on it. Counts of candidates pass through such a filter and an
exact join, too. Which pairs of words may be listed is told by counts of the first ``44`` bits
of their keys, four bytes a pair; what they let through is counted exactly. From the third level
on one pass over the texts counts ``LEVELS`` levels: contexts of which every part as long as the
first level's may be a candidate; those that turn out to be none meet no candidate in the join.

Counts and sequences to be scored are shuffled as packed arrays, one row for all keys of a task with the
same leading bits; ``_summed`` and ``_looked_up`` work on all keys with these bits, some
``2 ** 20`` at any size of the input. A block of texts comes together again with what its
sequences add. Texts are scored in ``ROUNDS`` parts by their ids, so that what is shuffled for one
is freed before the next.

Defined results: a null text is empty and scores its end alone; a row without id is part of
the training rows; repeated rows count and are returned as often as they stand. Without
training rows every count is 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.llm import texts
from lineloom.llm.stage import Stage, freed_shuffles

LEAST_STATE, LEAST_LISTED = 16, 4
DISCOUNT, GAIN = 0.75, 10.0
#: The symbol for the end of a text.
END = np.uint64(0x9D5C0FB8A1E3F2C7)
#: Distinct keys that a task holds before it passes their counts on.
HELD = 1 << 21
#: Sequences whose values are broadcast, and bits of a filter.
HOT, FILTER_BITS = 1 << 20, 27
#: Counts from which on sequences are as frequent as any.
MOST = 1 << 12
#: The key of a sequence and one more word: the key turned by so many bits, and the word's.
TURN = 23
#: Leading bits of a pair's key that deal it, and the bits after the next 32, which are left out.
DEALT, LEFT = 12, 20
#: Levels that one pass counts from the third on.
LEVELS = 4
#: Texts of one block, whose numbers take two bytes.
BLOCK = 1 << 16
#: Parts of the texts that are scored one after another, each shuffled and freed by itself.
ROUNDS = 2


class Sorted:
    """Places of 64-bit keys in the order of their mixed values, by leading bits and a short walk."""

    def __init__(self, mixed: np.ndarray):
        self.mixed = np.append(mixed, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.bits = np.uint64(max(44, 64 - max(1, len(mixed).bit_length())))
        self.first = np.searchsorted(mixed, np.arange((1 << (64 - int(self.bits))), dtype=np.uint64) << self.bits).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is missing."""
        out = np.full(len(wanted), -1, np.int64)
        size = len(self.mixed) - 1
        if not size or not len(wanted):
            return out
        mixed = texts.mix(wanted)
        at = self.first[mixed >> self.bits].astype(np.int64)
        rows = np.arange(len(wanted))
        while len(rows):
            here = self.mixed[at]
            hit = (here == mixed) & (at < size)
            out[rows[hit]] = at[hit]
            more = here < mixed
            rows, at, mixed = rows[more], at[more] + 1, mixed[more]
        return out


class Filter:
    """Keys that may be in a staged table: three bits of one 64-bit word are set for each of its keys, of 16
    or more bits for a key and at most ``2 ** FILTER_BITS``. The last ``LEFT`` bits of a key are not looked at."""

    def __init__(self, keys: DataFrame):
        self.keys = keys.count()
        self.mask = (1 << (min(FILTER_BITS, max(10, (16 * self.keys).bit_length())) - 6)) - 1
        spots = " | ".join(f"shiftleft(1L, CAST(shiftrightunsigned(key, {by}) & 63L AS INT))" for by in self._shifts)
        words = keys.groupBy(F.expr(f"shiftrightunsigned(key, {LEFT + 20}) & {self.mask}L").alias("place"))
        with freed_shuffles(keys.sparkSession):
            table = words.agg(F.expr(f"bit_or({spots})").alias("bits")).toArrow()
        self.bits = np.zeros(self.mask + 1, np.uint64)
        place, bits = (np.asarray(table.column(c).combine_chunks(), np.int64) for c in range(2))
        self.bits[place] = bits.view(np.uint64)

    _shifts = (LEFT, LEFT + 6, LEFT + 12)

    def has(self, keys: np.ndarray) -> np.ndarray:
        one, six = np.uint64(1), np.uint64(63)
        spots = np.zeros_like(keys)
        for by in self._shifts:
            spots |= one << ((keys >> np.uint64(by)) & six)
        return (self.bits[(keys >> np.uint64(LEFT + 20)) & np.uint64(self.mask)] & spots) == spots


class Tree(NamedTuple):
    """All values as a table ``key, n, root, value``: ``n`` occurrences in the training texts,
    ``root`` the log10 root probability of a word (null for longer sequences), ``value`` what
    one occurrence adds to the score of a text. ``n`` symbols, ``v`` distinct."""

    values: DataFrame
    n: int
    v: int
    depth: int

    @property
    def unseen(self) -> float:
        """The log10 root probability of a word that no training text holds."""
        return -float(np.log10(self.n + self.v + 1))


def _longer(keys: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Keys of the sequences one word longer than those of ``keys`` that end at each symbol."""
    before = np.zeros_like(keys)
    before[1:] = keys[:-1]
    return ((before << np.uint64(TURN)) | (before >> np.uint64(64 - TURN))) ^ symbols


def _longer_sql(key: str, word: str) -> F.Column:
    return F.expr(f"(shiftleft({key}, {TURN}) | shiftrightunsigned({key}, {64 - TURN})) ^ {word}")


def _symbols(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of texts: rows, symbols of all texts, and where each text begins (one more at the end)."""
    for first, last, data, offsets in texts.slices(column):
        data = texts.LOWER[data]
        starts, ends, rows = texts.words(data, offsets, texts.SPACED)
        hashes = texts.word_hashes(data, starts, ends)
        symbols = np.insert(hashes, rows[1:], END)
        yield first, last, symbols, rows + np.arange(len(rows))


def _counted(size: int, contexts=None, listed=None, form=None, words=None, levels: int = 1):
    """Counts of contexts of ``size`` words that pass the filter ``contexts``, with their next
    symbols, as ``form`` has them; combined over what a task holds. ``listed`` passes the
    symbols after one word by the key of both, after more words by that of the suffix and the symbol,
    ``words`` by the symbol's own. Of the next ``levels - 1`` sizes contexts are counted of which all
    parts of ``size`` words pass."""

    def combined(held):
        key, level, word, n = (np.concatenate(x) for x in zip(*held))
        key, at, place = np.unique(key, return_index=True, return_inverse=True)
        return key, level[at], word[at], np.bincount(place, n).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for _, _, symbols, borders in _symbols(batch.column(0)):
                keys = symbols
                at = np.arange(len(symbols))
                if size:
                    for _ in range(size - 1):
                        keys = _longer(keys, symbols)
                    at = at[at - np.repeat(borders[:-1], np.diff(borders)) >= size]
                    at = at[contexts.value.has(keys[at - 1])]
                    known = np.zeros(len(symbols), bool)
                    known[at] = True
                    if words is not None:
                        at = at[words.value.has(symbols[at])]
                    before, keys = keys, _longer(keys, symbols)
                    if listed is not None:
                        at = at[listed.value.has(keys[at] if size == 1 else before[at])]
                for level in range(size, size + levels):
                    if level > size:
                        # the part that ends so many words earlier
                        at = at[known[at - (level - size)]]
                        keys = _longer(keys, symbols)
                    if level > size and not len(at):
                        break
                    found, place, n = np.unique(keys[at], return_index=True, return_counts=True)
                    held.append((found, np.full(len(found), level, np.uint8), symbols[at][place], n.astype(np.int64)))
                    rows += len(found)
                if rows > HELD:
                    held = [combined(held)]
                    rows = len(held[0][0])
                    if rows > HELD // 2:
                        yield form(held[0])
                        held, rows = [], 0
        if held:
            yield form(combined(held))

    return run


def _planes(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    """Arrays between borders as bytes: the first byte of all values, then the second, so that they compress."""
    rows = values.view(np.uint8).reshape(len(values), values.itemsize)
    return pa.array([rows[a:b].T.tobytes() for a, b in zip(borders[:-1], borders[1:])], pa.binary())


def _rising(keys: np.ndarray, borders: np.ndarray) -> pa.Array:
    """Sorted keys between borders by their distances."""
    steps = np.diff(keys, prepend=np.uint64(0))
    steps[borders[:-1]] = keys[borders[:-1]]
    return _planes(steps, borders)


def _values(packed: pa.ChunkedArray, kind: type, rising: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All values of the arrays of a column, and how many each array has."""
    size = np.dtype(kind).itemsize
    counts = np.asarray(pc.binary_length(packed), np.int64) // size
    out, at = np.empty(counts.sum(), kind), 0
    for part, n in zip(packed, counts.tolist()):
        here = out[at : at + n]
        here.view(np.uint8).reshape(n, size)[:] = np.frombuffer(part.as_buffer(), np.uint8).reshape(size, n).T
        if rising:
            np.cumsum(here, out=here)
        at += n
    return out, counts


def _by_bits(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading bits that sorted keys have, and where each begins (one more entry at the end)."""
    numbers, first = np.unique(keys >> np.uint64(64 - bits), return_index=True)
    return numbers.astype(np.int32), np.append(first, len(keys))


def _packets(bits: int):
    def out(held) -> pa.RecordBatch:
        key, level, word, n = held
        dealt, borders = _by_bits(key, bits)
        columns = [pa.array(dealt), _rising(key, borders), *(_planes(x, borders) for x in (level, word, n.astype(np.uint32)))]
        return pa.RecordBatch.from_arrays(columns, ["dealt", "keys", "sizes", "words", "counts"])

    return out


def _summed(packets: pa.Table) -> pa.Table:
    """Contexts and next symbols of one dealing that are counted ``LEAST_LISTED`` times."""
    key, _ = _values(packets.column("keys"), np.uint64, rising=True)
    size, word, n = (_values(packets.column(c), t)[0] for c, t in (("sizes", np.uint8), ("words", np.uint64), ("counts", np.uint32)))
    key, at, place = np.unique(key, return_index=True, return_inverse=True)
    c = np.bincount(place, n).astype(np.int64)
    often = c >= LEAST_LISTED
    at, c = at[often], c[often]
    context = key[often] ^ word[at]
    context = (context >> np.uint64(TURN)) | (context << np.uint64(64 - TURN))
    return pa.table({"size": size[at].astype(np.int32), "key": context.view(np.int64), "word": word[at].view(np.int64), "c": c})


def _totals(held) -> pa.RecordBatch:
    key, _, _, n = held
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])


def _dealt(held) -> pa.RecordBatch:
    """The counts of sorted keys by their leading bits: the next 32 bits of each key, and its count."""
    key, _, _, n = held
    dealt = key >> np.uint64(64 - DEALT)
    numbers, first = np.unique(dealt, return_index=True)
    ends = np.append(first, len(key)).astype(np.int32)

    def cut(values: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends * np.int32(values.itemsize)), pa.py_buffer(values)])

    prints = ((key >> np.uint64(LEFT)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    # only whether a count reaches LEAST_LISTED is asked
    columns = [pa.array(numbers.astype(np.int32)), cut(prints), cut(np.minimum(n, 255).astype(np.uint8))]
    return pa.RecordBatch.from_arrays(columns, ["dealt", "prints", "counts"])


def _often(pairs: pa.Table) -> pa.Table:
    """The keys, without their last bits, that one dealing counts ``LEAST_LISTED`` times."""
    prints, counts = (np.frombuffer(b"".join(pairs.column(c).to_pylist()), t) for c, t in (("prints", np.uint32), ("counts", np.uint8)))
    prints, place = np.unique(prints, return_inverse=True)
    prints = prints[np.bincount(place, counts) >= LEAST_LISTED].astype(np.uint64)
    leading = np.uint64(pairs.column("dealt")[0].as_py()) << np.uint64(64 - DEALT)
    return pa.table({"key": (leading | (prints << np.uint64(LEFT))).view(np.int64)})


def _pass(training: DataFrame, stage: Stage, words: DataFrame, candidates: DataFrame, rows: DataFrame | None, size: int, last: int, bits: int) -> DataFrame:
    """What stands after contexts of ``size`` to ``last`` words in the training texts: ``size, key, word, c``."""
    context = training.sparkSession.sparkContext
    schema = "size int, key long, word long, c long"
    known = Filter(candidates)
    if not known.keys:
        return training.sparkSession.createDataFrame([], schema)
    known = context.broadcast(known)
    common = None
    if size == 1:
        # most pairs of words stand once: only bits of their keys are dealt, then what may be listed is counted
        common = context.broadcast(Filter(words.filter(F.col("n") >= LEAST_LISTED)))
        pairs = training.mapInArrow(_counted(1, known, form=_dealt, words=common), "dealt int, prints binary, counts binary")
        listed = stage.keep(pairs.groupBy("dealt").applyInArrow(_often, "key long"), "pairs")
    else:
        # a symbol is listed after a context only if it is after the suffix
        listed = rows.select(_longer_sql("key", "word").alias("key"))
    listed = context.broadcast(Filter(listed))
    counted = training.mapInArrow(
        _counted(size, known, listed, _packets(bits), levels=last - size + 1),
        "dealt int, keys binary, sizes binary, words binary, counts binary",
    )
    counted = stage.keep(counted.groupBy("dealt").applyInArrow(_summed, schema), f"counted-{size}")
    for sent in (known, listed, *([common] if common else [])):
        sent.destroy()
    return counted


def grown(training: DataFrame, stage: Stage) -> Tree:
    """The tree of the training texts (``text``)."""
    spark = training.sparkSession
    words = training.mapInArrow(_counted(0, form=_totals), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    words = stage.keep(words, "words")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    root = (F.col("n") + 1) / F.lit(float(n + v + 1))
    #: sequences of one length: the symbol they end in, their count, what their last symbol's
    #: probability is after the longest state before it, and what they add to a score
    level = words.select("key", "n", F.col("key").alias("word"), F.lit(0).cast("long").alias("rest"), root.alias("p"), F.log10(root).alias("value"))
    states, rows, parts, size = None, None, [], 0
    #: counts of the last pass, the first and the last size it counted
    passed, first, last = None, 0, 0
    bits = max(4, (n >> 20).bit_length())
    while True:
        size += 1
        longer = level
        if states is not None:
            # the suffix of a context was tested one level before
            longer = rows.select(_longer_sql("key", "word").alias("key"), F.col("shorter").alias("rest"), F.col("c").alias("n"), "word")
            longer = longer.join(states.select(F.col("key").alias("rest")), "rest", "left_semi")
        candidates = longer.filter((F.col("n") >= LEAST_STATE) & (F.col("word") != int(END.astype(np.int64)))).select("key", "rest", "n")
        candidates = stage.keep(candidates, f"candidates-{size}")
        if size > last:
            first, last = size, size + (LEVELS - 1 if size > 2 else 0)
            passed = _pass(training, stage, words, candidates, rows, size, last, bits)
        counted = passed.filter(F.col("size") == size).drop("size")
        freed = counted.groupBy("key").agg(F.sum("c").alias("share"), F.count("*").alias("m"))
        freed = candidates.join(freed, "key").withColumn("freed", F.col("n") - F.col("share") + DISCOUNT * F.col("m"))
        rows = counted.join(freed.select("key", "rest", "n", "freed"), "key").withColumn("shorter", _longer_sql("rest", "word"))
        rows = rows.join(level.select(F.col("key").alias("shorter"), F.col("p").alias("below")), "shorter")
        rows = stage.keep(rows.select("key", "word", "c", "n", "freed", "below", "shorter"), f"rows-{size}")
        again = F.greatest(F.col("c") - 1 - DISCOUNT, F.lit(0.0)) + F.col("freed") * F.col("below")
        gain = F.col("c") * F.log(again / (F.greatest(F.col("n") - 1, F.lit(1)) * F.col("below")))
        tested = rows.groupBy("key").agg(F.sum(gain).alias("gain"), F.sum("c").alias("share"), F.first("n").alias("n"), F.first("freed").alias("freed"))
        unlisted = F.when(F.col("n") > F.col("share"), (F.col("n") - F.col("share")) * F.log(F.col("freed") / F.col("n"))).otherwise(0.0)
        states = tested.filter(F.col("gain") + unlisted > GAIN).select("key", F.col("n").alias("times"), (F.col("freed") / F.col("n")).alias("left"))
        states = stage.keep(states, f"states-{size}")
        # sequences of this length are now complete: those that are states add what they leave
        whole = level.join(states, "key", "full").select(
            "key", F.coalesce("n", "times").alias("n"),
            (F.log10("p") if size == 1 else F.lit(None).cast("double")).alias("root"),
            (F.coalesce("value", F.lit(0.0)) + F.coalesce(F.log10("left"), F.lit(0.0))).alias("value"),
        )
        parts.append(stage.keep(whole, f"values-{size}"))
        grows = not states.isEmpty()
        done = [f"candidates-{size}", *(["words", "pairs"] if size == 1 else [f"rows-{size - 1}", f"level-{size - 1}"])]
        stage.drop(*done, *([f"counted-{first}"] if size == last or not grows else []))
        if not grows:
            break
        after = F.col("left") * F.col("below")
        p = (F.col("c") - DISCOUNT) / F.col("n") + after
        level = rows.join(states, "key").select(_longer_sql("key", "word").alias("key"), F.col("c").alias("n"), p.alias("p"), F.log10(p / after).alias("value"))
        level = stage.keep(level, f"level-{size}")
    values = parts[0]
    for part in parts[1:]:
        values = values.unionByName(part)
    return Tree(values, n, v, len(parts))


class Hot(NamedTuple):
    """Values of the most frequent sequences, a filter of the others, and how often these stand in the training texts."""

    places: Sorted
    root: np.ndarray
    value: np.ndarray
    others: Filter
    depth: int
    times: int


def _hot(tree: Tree) -> tuple[Hot, DataFrame]:
    """What is broadcast, and the table of all other values."""
    times = F.least("n", F.lit(MOST))
    sizes = tree.values.groupBy(times.alias("times")).agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()
    stand = {r.times: r.n for r in sizes}
    sizes = {r.times: r.rows for r in sizes}
    # whole counts from above, as long as they fit
    total, least = 0, MOST + 1
    for count in sorted(sizes, reverse=True):
        total += sizes[count]
        if total > HOT:
            break
        least = count
    table = tree.values.filter(times >= least).select("key", "root", "value").toArrow()
    key, root, value = (table.column(c).combine_chunks() for c in range(3))
    del table
    others = tree.values.filter(times < least).select("key", "root", "value")
    mixed = texts.mix(np.asarray(key, np.int64).view(np.uint64))
    order = np.argsort(mixed)
    root, value = np.asarray(root.fill_null(0.0), float)[order], np.asarray(value, float)[order]
    places = Sorted(mixed[order])
    del key, mixed, order
    return Hot(places, root, value, Filter(others), tree.depth, sum(x for k, x in stand.items() if k < least)), others


#: One text, or sequences by their leading bits with the numbers of their texts in the block.
ASKED = "dealt int, block long, row int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, places binary, keys binary"
#: One text, or what the sequences of one dealing add to texts of a block.
ADDED = "block long, row int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, places binary, known binary, roots binary, sums binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _blank(n: int, schema: str, **columns: pa.Array) -> pa.RecordBatch:
    """``n`` rows, null but for the given columns."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
    named = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, kinds[k]) for c, k in named], [c for c, _ in named])


def _scored(known, bits: int):
    """Texts with what the broadcast values add to them, and their other sequences that may be in the tree."""

    def block(number: int, texts_: list, cold: list) -> Iterator[pa.RecordBatch]:
        names = ("doc_id", "held_out", "n_tokens", "n_known", "base", "score")
        columns = {c: pa.concat_arrays(x) for c, x in zip(names, zip(*texts_))}
        size = len(columns["doc_id"])
        dealt = pa.array(np.full(size, number & ((1 << bits) - 1), np.int32))
        yield _blank(size, ASKED, dealt=dealt, block=pa.array(np.full(size, number)), row=pa.array(np.arange(size, dtype=np.int32)), **columns)
        place, key = (np.concatenate(x) for x in zip(*cold))
        order = np.argsort(key)
        place, key = place[order], key[order]
        dealt, borders = _by_bits(key, bits)
        numbers = pa.array(np.full(len(dealt), number))
        yield _blank(len(dealt), ASKED, dealt=pa.array(dealt), block=numbers, places=_planes(place, borders), keys=_rising(key, borders))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = known.value
        number = TaskContext.get().partitionId() << 32
        held: list[list] = []
        cold: list[tuple[np.ndarray, np.ndarray]] = []
        done = rows = 0
        for batch in (b.slice(at, BLOCK) for b in batches for at in range(0, b.num_rows, BLOCK)):
            for first, last, symbols, borders in _symbols(batch.column(2)):
                size = last - first
                if held and (rows > HELD // 2 or done + size > BLOCK):
                    yield from block(number, held, cold)
                    number, held, cold, done, rows = number + 1, [], [], 0, 0
                sizes = np.diff(borders)
                row = np.repeat(np.arange(size), sizes)
                inside = np.arange(len(symbols)) - np.repeat(borders[:-1], sizes)
                n_known, base, score = np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
                keys, at = symbols, np.arange(len(symbols))
                for level in range(hot.depth):
                    place = hot.places.find(keys[at])
                    hit = place >= 0
                    where, place = row[at[hit]], place[hit]
                    if not level:
                        n_known += np.bincount(where, minlength=size)
                        base += np.bincount(where, hot.root[place], size)
                    score += np.bincount(where, hot.value[place], size)
                    rest = at[~hit]
                    rest = rest[hot.others.has(keys[rest])]
                    cold.append(((row[rest] + done).astype(np.uint16), keys[rest]))
                    rows += len(rest)
                    # a longer sequence is in the tree only if its suffix is
                    alive = np.concatenate([at[hit], rest])
                    at = np.sort(alive[inside[alive] > level])
                    if not len(at):
                        break
                    keys = _longer(keys, symbols)
                held.append([batch.column(0)[first:last], batch.column(1)[first:last], pa.array(sizes.astype(np.int64)), *(pa.array(x) for x in (n_known, base, score))])
                done += size
        if held:
            yield from block(number, held, cold)

    return run


def _table(bits: int):
    """Values ``key, root, value`` as packed arrays by their leading bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows > HELD:
                yield packed(held)
                held, rows = [], 0
        if rows:
            yield packed(held)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        key = np.asarray(table.column("key"), np.int64).view(np.uint64)
        # words alone have a root
        root, value = (np.asarray(table.column(c).fill_null(np.nan), float) for c in ("root", "value"))
        order = np.argsort(key)
        dealt, borders = _by_bits(key[order], bits)
        columns = [pa.array(dealt), _rising(key[order], borders), _planes(root[order], borders), _planes(value[order], borders)]
        return pa.RecordBatch.from_arrays(columns, ["dealt", "keys", "roots", "sums"])

    return run


def _looked_up(asked: pa.Table, table: pa.Table) -> pa.Table:
    """Texts as they are, and what the sequences of one dealing add to each text."""
    is_text = asked.column("keys").is_null()
    out = [_blank(len(x), ADDED, **{c: x.column(c) for c in asked.column_names if c not in ("dealt", "keys")}) for x in asked.filter(is_text).to_batches()]
    asked = asked.filter(asked.column("keys").is_valid())
    key, _ = _values(table.column("keys"), np.uint64, rising=True)
    if len(asked) and len(key):
        root, value = (_values(table.column(c), np.float64)[0] for c in ("roots", "sums"))
        order = np.argsort(key)
        key, root, value = key[order], root[order], value[order]
        wanted, sizes = _values(asked.column("keys"), np.uint64, rising=True)
        place, _ = _values(asked.column("places"), np.uint16)
        blocks, block = np.unique(np.asarray(asked.column("block")), return_inverse=True)
        text = (np.repeat(block, sizes) << 16) | place
        at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        hit = key[at] == wanted
        text, at = text[hit], at[hit]
        del wanted, place, hit
        text, which = np.unique(text, return_inverse=True)
        word = ~np.isnan(root[at])
        known = np.bincount(which[word], minlength=len(text)).astype(np.uint32)
        roots, sums = np.bincount(which[word], root[at][word], len(text)), np.bincount(which, value[at], len(text))
        numbers, first = np.unique(text >> 16, return_index=True)
        borders = np.append(first, len(text))
        columns = (("places", (text & 0xFFFF).astype(np.uint16)), ("known", known), ("roots", roots), ("sums", sums))
        out.append(_blank(len(numbers), ADDED, block=pa.array(blocks[numbers]), **{c: _planes(x, borders) for c, x in columns}))
    return pa.Table.from_batches(out, _blank(0, ADDED).schema)


def _added(block: pa.Table) -> pa.Table:
    """The texts of a block with all that their sequences add."""
    parts = block.filter(block.column("places").is_valid())
    texts_ = block.filter(block.column("places").is_null()).sort_by("row")
    place = _values(parts.column("places"), np.uint16)[0]
    sums = [np.bincount(place, _values(parts.column(c), t)[0], len(texts_)) for c, t in (("known", np.uint32), ("roots", np.float64), ("sums", np.float64))]
    n_known, base, score = (np.asarray(texts_.column(c)) + x for c, x in zip(("n_known", "base", "score"), sums))
    columns = {"n_known": pa.array(n_known.astype(np.int64)), "base": pa.array(base), "score": pa.array(score)}
    return pa.table({c: columns.get(c, texts_.column(c)) for c in (x.split()[0] for x in SCORED.split(", "))})


def told(rows: DataFrame, tree: Tree, stage: Stage) -> DataFrame:
    """Scores of ``doc_id, held_out, text``."""
    hot, others = _hot(tree)
    bits = max(4, (hot.times >> 20).bit_length())
    known = rows.sparkSession.sparkContext.broadcast(hot)
    found = None
    for part in range(ROUNDS):
        own = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == part)
        asked = own.mapInArrow(_scored(known, bits), ASKED).groupBy("dealt")
        table = others.mapInArrow(_table(bits), "dealt int, keys binary, roots binary, sums binary").groupBy("dealt")
        added = asked.cogroup(table).applyInArrow(_looked_up, ADDED)
        scored = stage.keep(added.groupBy("block").applyInArrow(_added, SCORED), f"scored-{part}")
        found = found.unionByName(scored) if found is not None else scored
    known.destroy()
    unseen = (F.col("n_tokens") - F.col("n_known")) * F.lit(tree.unseen)
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(tree.n).cast("long").alias("train_tokens"),
        (F.col("base") + unseen).alias("base_score"),
        (F.col("score") + unseen).alias("score"),
    )


def scores(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """Scores of every text by a tree learnt from the rows whose crc32 of the id modulo
    ``folds`` is not ``held``: base (root only) and tree, in log10."""
    stage = Stage(docs.sparkSession, "suffix-tree", free_shuffles=True)
    out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(folds)) == held
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), "text")
    tree = grown(rows.filter(~F.col("held_out")).select("text"), stage)
    scored = told(rows, tree, stage)
    stage.drop(*(f"{table}-{k}" for table in ("values", "states", "rows", "level") for k in range(1, tree.depth + 1)))
    return scored
