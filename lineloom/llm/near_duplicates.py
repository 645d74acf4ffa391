"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles. Equal sets are one class. Classes get
``COORDINATES`` minwise values; a tree starts at every class and branches: a node chooses
some coordinates by its own path, and a class goes to one child for each, named by the path
and the minwise value there. Classes that agree on most values meet again and again, others
part soon. A node is compared once it is small, and branches further while it is not.

With three coordinates chosen at the root and two at every other node, a pair at similarity
0.85 meets in a tree with a chance of about 0.992 at the largest depth, one at 0.80 with 0.979.
There are as many trees as bring the chance that a pair at the threshold meets in none below
``UNMET``: three at 0.85, four at 0.80.

Nodes are compared on full shingle sets, in pairs of blocks of bounded rows and bytes: the shingles
that several sets of a block pair share become columns of a matrix, and one product has all the
intersections. A block pair gives no more links than it takes to join the components that meet
in it, so what comes out of a node grows with its classes and not with their pairs.

Large groups of near copies are mostly joined before pairs are looked for: in one tree, all classes of
a large node are compared with ``CENTRES`` of them, those that share their nodes with most
others. Then a node counts only pairs of different components: the classes outside of its largest
component are compared with all others, and only these. Small nodes with the same
classes are compared once. Nothing is capped.

Defined results: without words or text a document has no shingles and is linked with
nothing; a row without id likewise, with a null component, and is kept; repeated rows share
their component, and each row of the smallest id is kept. Classes are told apart by a hash of 64
bits: two different sets fall together with a chance of 2 ** -64.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineloom.llm import texts
from lineloom.llm.components import components
from lineloom.llm.stage import Stage

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
COORDINATES, AT_ROOT, AT_NODE = 64, 3, 2
#: Pairs that are compared in a node that does not branch further; largest depth.
LEAF, DEPTH = 1 << 24, 6
#: Nodes above this size have centres.
SMALL, CENTRES = 64, 64
#: Classes and bytes of shingles of a block, on average.
BLOCK, BLOCK_BYTES = 2048, 4 << 20
#: Numbers of a matrix of sets and shingles that are held at once.
HELD = 1 << 22
#: Rows with texts, signatures or sets that go to a Python worker at once.
ROWS_AT_ONCE = 500
#: Links that a worker gathers before it passes them on.
LINKS_AT_ONCE = 4096
#: Largest chance that a pair at the threshold meets in no tree.
UNMET = 1e-5
#: More trees than this are refused.
MOST_TREES = 1000

_MULTIPLY = np.random.default_rng(85).integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(58).integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


@cache
def trees(percent: int) -> int:
    """The least number of trees in one of which a pair at ``percent`` meets."""
    # given how many coordinates a pair agrees on, which all trees share
    equal = np.arange(COORDINATES + 1) / COORDINATES
    apart = np.zeros(COORDINATES + 1)
    for choices in (AT_NODE,) * (DEPTH - 1) + (AT_ROOT,):
        apart = (1 - equal * (1 - apart)) ** choices
    share = percent / 100
    chances = np.array([comb(COORDINATES, k) * share**k * (1 - share) ** (COORDINATES - k) for k in range(COORDINATES + 1)])
    for n in range(1, MOST_TREES + 1):
        if (chances * apart**n).sum() < UNMET:
            return n
    raise ValueError(f"pairs at {percent} percent need more than {MOST_TREES} trees")


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for first, last, data, offsets in texts.slices(column):
        data = texts.LOWER[data]
        starts, ends, rows = texts.words(data, offsets, texts.SPACED)
        hashes = texts.word_hashes(data, starts, ends)
        runs = texts.chained(hashes, SHINGLE)
        for a, b in zip(rows[:-1], rows[1:]):
            if b - a >= SHINGLE:
                yield np.unique(runs[a : b - SHINGLE + 1])
            elif b > a:
                yield texts.chained(hashes[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                yield np.zeros(0, np.uint64)


def _fingerprint(shingles: np.ndarray) -> np.int64:
    with np.errstate(over="ignore"):
        mixed = texts.mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
        return texts.mix(np.array([mixed.sum(dtype=np.uint64) + np.uint64(len(shingles))]))[0].astype(np.int64)


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The least value of each coordinate's permutation over each set, as bytes."""
    out = np.zeros((len(sets), COORDINATES), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        borders = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        with np.errstate(over="ignore"):
            for c in range(COORDINATES):
                out[full, c] = np.minimum.reduceat(flat * _MULTIPLY[c] + _ADD[c], borders) >> np.uint64(32)
    return out


def _read(signatures: list[bytes]) -> np.ndarray:
    """Coordinates of signatures."""
    return np.frombuffer(b"".join(signatures), np.uint32).reshape(-1, COORDINATES)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held: list[np.ndarray] = []
        sizes, keys, signatures, waiting = [], [], [], 0

        def flush():
            nonlocal waiting
            signatures.extend(row.tobytes() for row in _signatures(held))
            held.clear()
            waiting = 0

        for shingles in shingle_sets(batch.column(1)):
            sizes.append(len(shingles))
            keys.append(int(_fingerprint(shingles)) if len(shingles) else None)
            held.append(shingles)
            waiting += len(shingles)
            if waiting > texts.SLICE:
                flush()
        flush()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary())],
            ["doc_id", "id", "n_shingles", "signature"],
        )


def _children(nodes: np.ndarray, values: np.ndarray, choices: int) -> np.ndarray:
    """For each node and class, the ``choices`` children of the coordinates the node chooses."""
    out = np.empty((len(nodes), choices), np.uint64)
    with np.errstate(over="ignore"):
        first = (texts.mix(nodes) % np.uint64(COORDINATES)).astype(np.int64)
        step = (texts.mix(nodes + np.uint64(7)) % np.uint64(COORDINATES // 2)).astype(np.int64) * 2 + 1
        for k in range(choices):
            chosen = (first + k * step) % COORDINATES  # odd steps: distinct coordinates
            value = values[np.arange(len(nodes)), chosen].astype(np.uint64)
            out[:, k] = texts.mix(texts.mix(nodes * np.uint64(3) + chosen.astype(np.uint64)) + value)
    return out


def _roots(n: int):
    """``n`` trees down to depth two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0), np.int64)
            values = _read(batch.column(1).to_pylist())
            for tree in range(n):
                top = _children(np.full(len(ids), tree + 1, np.uint64), values, AT_ROOT)
                low = np.concatenate([_children(top[:, k], values, AT_NODE) for k in range(AT_ROOT)], 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(low.size, tree, np.int32)), pa.array(low.reshape(-1).astype(np.int64)), pa.array(np.repeat(ids, low.shape[1]))], ["tree", "node", "id"]
                )

    return run


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            values = _read(batch.column(2).to_pylist())
            low = _children(np.asarray(batch.column(0), np.int64).astype(np.uint64), values, AT_NODE)
            yield pa.RecordBatch.from_arrays([pa.array(low.reshape(-1).astype(np.int64)), pa.array(np.repeat(np.asarray(batch.column(1)), AT_NODE))], ["node", "id"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            kept, sets = [], []
            for row, (wanted, shingles) in enumerate(zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1)))):
                if len(shingles) and int(_fingerprint(shingles)) == wanted:
                    kept.append(wanted)
                    sets.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(sets, pa.binary())], ["id", "shingles"])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a column of sets, one behind the other, and the size of each set."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint64, (offsets[-1] - offsets[0]) // 8, offsets[0]) if offsets[-1] > offsets[0] else np.zeros(0, np.uint64)
    return flat, np.diff(offsets) // 8


def intersections(flat: np.ndarray, sizes: np.ndarray, some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``some`` sets with ``others``, of those in ``flat``."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
    shared = seen > 1  # what one set has alone is in no intersection
    column, owner = (np.cumsum(shared) - 1)[column[shared[column]]], owner[shared[column]]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(some), len(others)), np.float32)
    width = max(1, min(int(shared.sum()), HELD // len(sizes)))
    for at in range(0, int(shared.sum()), width):
        first, last = np.searchsorted(column, (at, at + width))
        held = np.zeros((len(sizes), width), np.float32)
        held[owner[first:last], column[first:last] - at] = 1
        common += held[some] @ held[others].T
    return common


def _spanning(ids: np.ndarray, roots: np.ndarray, out: np.ndarray, members: np.ndarray, near: np.ndarray) -> Iterator[tuple[int, int]]:
    """Of the ``near`` pairs of a row of ``out`` and one of ``members`` as many as join their components."""
    _, label = np.unique(roots, return_inverse=True)
    for i, row in zip(out, near):
        hit = members[row]
        labels, first = np.unique(label[hit], return_index=True)
        own = label[i]
        for other, at in zip(labels, first):
            if other != own:
                yield ids[i], ids[hit[at]]
                label[label == other] = own


#: How a row takes part in a pair of blocks.
OUTSIDER, MEMBER, BOTH = range(3)


def _links(held: list[pa.RecordBatch], percent: int) -> Iterator[tuple[int, int]]:
    """Links in one pair of blocks that join components."""
    ids, roots, sides = (np.concatenate([np.asarray(p.column(c), np.int64) for p in held]) for c in (3, 4, 5))
    out, members = np.flatnonzero(sides != MEMBER), np.flatnonzero(sides != OUTSIDER)
    if len(out) and len(np.unique(roots)) > 1:
        flat, sizes = (np.concatenate(x) for x in zip(*(_flat(p.column(6)) for p in held)))
        common = intersections(flat, sizes, out, members).astype(np.int64)
        near = 100 * common >= percent * (sizes[out][:, None] + sizes[members] - common)
        yield from _spanning(ids, roots, out, members, near & (ids[out][:, None] != ids[members]))


def _compare(percent: int):
    """Rows sorted by node and blocks to links that join components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, found = None, [], []

        def out() -> pa.RecordBatch:
            a, b = zip(*found)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c), np.int64) for c in range(3)], 1)
            borders = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for first, last in zip([0, *borders], [*borders, len(keys)]):
                if first == last:
                    continue
                if (here := tuple(keys[first])) != key:
                    if held:
                        found.extend(_links(held, percent))
                    key, held = here, []
                held.append(batch.slice(first, last - first))
            if len(found) >= LINKS_AT_ONCE:
                yield out()
        if held:
            found.extend(_links(held, percent))
        if found:
            yield out()

    return run


def _compared(rows: DataFrame, outside: Column, outsiders: Column, outsider_bytes: Column, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the rows ``outside`` with all rows of their node, as many as join components.
    ``rows`` have ``node``, ``id``, ``root`` and the node's ``n`` rows and ``bytes``;
    ``outsiders`` and ``outsider_bytes`` are those of the rows outside."""

    def blocks(n: Column, size: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES)).cast("int")

    def place(a, b, side) -> Column:
        return F.struct(a.cast("int").alias("block"), b.cast("int").alias("other"), F.lit(side).alias("side"))

    rows = rows.select("node", "id", "root", outside.alias("outside"), blocks(outsiders, outsider_bytes).alias("x"), blocks(F.col("n"), F.col("bytes")).alias("y"))
    rows = rows.withColumns({"px": F.pmod(F.xxhash64("id"), F.col("x")), "py": F.pmod(F.xxhash64("id"), F.col("y"))})
    once = F.when(F.col("outside"), F.array(place(F.lit(0), F.lit(0), BOTH))).otherwise(F.array(place(F.lit(0), F.lit(0), MEMBER)))
    inside = F.transform(F.sequence(F.lit(0), F.col("x") - 1), lambda k: place(k, F.col("py"), MEMBER))
    against = F.transform(F.sequence(F.lit(0), F.col("y") - 1), lambda k: place(F.col("px"), k, OUTSIDER))
    many = F.when(F.col("outside"), F.concat(inside, against)).otherwise(inside)
    rows = rows.select("node", "id", "root", F.inline(F.when((F.col("x") == 1) & (F.col("y") == 1), once).otherwise(many)))
    rows = rows.join(sets, "id").select("node", "block", "other", "id", "root", "side", "shingles")
    rows = rows.repartition("node", "block", "other").sortWithinPartitions("node", "block", "other")
    return rows.mapInArrow(_compare(percent), "a long, b long")


def _centred(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the classes in a large node of one tree with the node's centres."""
    # what a group of copies stems from shares most minwise values with the group
    weight = nodes.groupBy("id").agg(F.sum("n").alias("weight")).filter(F.col("weight") > SMALL)
    large = nodes.filter(f"tree = 0 AND n > {SMALL}").join(weight, "id")
    heaviest = Window.partitionBy("node").orderBy(F.col("weight").desc(), "id")
    centres = large.withColumn("at", F.row_number().over(heaviest)).filter(F.col("at") <= CENTRES).select("node", "id", F.lit(True).alias("centre"))
    rows = large.join(centres, ["node", "id"], "left").withColumn("root", F.col("id"))
    return _compared(rows, F.coalesce("centre", F.lit(False)), F.lit(CENTRES), CENTRES * F.col("bytes") / F.col("n"), sets, percent)


def _open(nodes: DataFrame, roots: DataFrame, stage: Stage, name: str) -> DataFrame:
    """Rows of the nodes that hold several components: how many rows and bytes, the largest
    component with its rows and bytes."""
    rows = stage.keep(nodes.join(roots, "id", "left").select("node", "id", "size", F.coalesce("root", "id").alias("root")), f"rows-{name}")
    counts = rows.groupBy("node", "root").agg(F.count("*").alias("k"), F.sum("size").alias("size")).groupBy("node")
    counts = counts.agg(F.sum("k").alias("n"), F.sum("size").alias("size"), F.max(F.struct("k", "root", "size")).alias("most")).filter("n > most.k")
    counts = counts.select(
        "node", "n", (8 * F.col("size")).alias("bytes"), F.col("most.root").alias("largest"), F.col("most.k").alias("k"), (8 * (F.col("size") - F.col("most.size"))).alias("other_bytes")
    )
    # written, so that a node with very many rows can be split in the join
    return rows.join(stage.keep(counts, f"counts-{name}"), "node")


def _met(nodes: DataFrame, roots: DataFrame, signatures: DataFrame, sets: DataFrame, percent: int, stage: Stage) -> DataFrame:
    """Links between components that meet in a leaf of a tree."""
    links = None
    others = F.col("n") - F.col("k")
    for depth in range(2, DEPTH + 1):
        ready = (others * F.col("n") <= LEAF) | (2 * F.col("k") >= F.col("n")) | F.lit(depth == DEPTH)
        rows = stage.keep(_open(nodes, roots, stage, str(depth)).withColumn("ready", ready), f"open-{depth}")
        found = _compared(rows.filter("ready"), F.col("root") != F.col("largest"), others, F.col("other_bytes"), sets.select("id", "shingles"), percent)
        found = stage.keep(found.distinct(), f"met-{depth}")
        links = found if links is None else links.union(found)
        large = rows.filter("NOT ready").select("node", "id")
        stage.drop(f"rows-{depth}", f"counts-{depth}")
        if depth == DEPTH or large.isEmpty():
            return links
        branched = large.join(signatures, "id").select("node", "id", "signature").mapInArrow(_branch, "node long, id long")
        nodes = stage.keep(branched.join(sets.select("id", "size"), "id"), f"nodes-{depth + 1}")


def _nodes(classes: DataFrame, percent: int, stage: Stage) -> DataFrame:
    """Rows (``tree``, ``node``, ``id``) of the nodes that several classes meet in, with the
    node's ``n``. Of small nodes with the same classes one is kept."""
    rows = stage.keep(classes.select("id", "signature").mapInArrow(_roots(trees(percent)), "tree int, node long, id long"), "all-nodes")
    met = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("tree").alias("tree"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.hash("id", F.lit(7))).alias("y"))
    met = stage.keep(met.filter("n > 1"), "met-nodes")
    same = met.filter(f"n <= {SMALL}").groupBy("n", "x", "y").agg(F.min(F.struct("tree", "node")).alias("one")).select("one.node", "n")
    kept = stage.keep(same.union(met.filter(f"n > {SMALL}").select("node", "n")), "kept-nodes")
    nodes = stage.keep(rows.join(kept, "node").select("tree", "node", "id", "n"), "nodes")
    stage.drop("all-nodes", "met-nodes", "kept-nodes")
    return nodes


@contextmanager
def _few_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send rows that hold texts or sets to a worker some at a time, while this operator's own steps run."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _classes_and_roots(docs: DataFrame, stage: Stage, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their class, the classes, and the component of each linked class."""
    sketches = stage.keep(docs.mapInArrow(_sketch, "doc_id long, id long, n_shingles long, signature binary"), "sketches")
    known = sketches.filter("doc_id IS NOT NULL AND id IS NOT NULL")
    classes = stage.keep(known.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature")), "classes")
    sketches = stage.keep(sketches.drop("signature"), "rows")
    stage.drop("sketches")

    nodes = _nodes(classes, percent, stage)
    wanted = nodes.select("id").distinct().join(classes.select("id", "doc_id"), "id")
    sets = docs.join(wanted, "doc_id").select("id", "text").mapInArrow(_full_sets, "id long, shingles binary")
    sets = sets.groupBy("id").agg(F.first("shingles").alias("shingles")).withColumn("size", F.expr("octet_length(shingles) DIV 8"))
    sets = stage.keep(sets, "sets")

    sized = stage.keep(nodes.join(sets.select("id", "size"), "id"), "sized")
    bytes_ = sized.filter(f"tree = 0 AND n > {SMALL}").groupBy("node").agg((8 * F.sum("size")).alias("bytes"))
    links = stage.keep(_centred(sized.join(stage.keep(bytes_, "bytes"), "node", "left"), sets.drop("size"), percent), "centred")
    roots = components(links, stage, "centred-components")
    met = _met(sized.select("node", "id", "size"), roots, classes.select("id", "signature"), sets, percent, stage)
    roots = components(links.union(met), stage, "components")
    stage.drop("sets", "nodes", "sized")
    return sketches, classes, roots


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """For each row its ``n_shingles``, ``component_id`` and whether it is ``kept``."""
    stage = Stage(docs.sparkSession, "near-duplicates")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with _few_at_once(docs.sparkSession, ROWS_AT_ONCE):
        sketches, classes, roots = _classes_and_roots(docs, stage, percent)

    named = classes.join(roots, "id").groupBy("root").agg(F.min("doc_id").alias("least"))
    named = roots.join(named, "root").select("id", "least")
    found = classes.select("id", F.col("doc_id").alias("first_id")).join(named, "id", "left").select("id", F.coalesce("least", "first_id").alias("least"))
    joined = sketches.select("doc_id", "id", "n_shingles").join(found, "id", "left")
    component = F.when(F.col("id").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("least"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def distinct(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows that ``near_duplicates`` keeps, with the columns they came with; rows that
    repeat a kept id are the same document and stay."""
    verdicts = near_duplicates(docs, percent)
    dropped = verdicts.filter(~F.col("kept")).select(F.col("doc_id").alias("__dropped")).distinct()
    same = docs["doc_id"].cast("long") == F.col("__dropped")
    return docs.join(dropped, same, "left_anti")
