"""Exact top-k by inner product over vector-approximation files.

A vector file is a table of blocks. Each block holds up to ``BLOCK`` vectors twice: as
cells (one byte per dimension, on a grid that spans the block) and exactly. A search pairs
blocks of queries with blocks of vectors. In a pair, the cells give an upper bound of every
score; exact vectors are then read in the order of their bounds until the k-th score is
certain. The best of each pair are merged. A task holds one pair at a time, whatever the
size of the table.

Defined results: vectors that are null or empty or hold a null or non-finite component
take no part; only vectors of equal length are compared; a repeated row is a row of its
own, as query and as candidate (a query leaves out its own row only); ties go to the
smaller id, then to the earlier row. Rows without id are candidates of no use and are left
out. Scores are exact while their sums of products stay below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineloom.llm.stage import Stage

BLOCK, QUERY_BLOCK, PAIRED = 4096, 512, 8
#: Cells per dimension: one byte.
CELLS = 256

FILE = "block long, dim int, ids binary, low binary, step binary, cells binary, exact binary"
PACK = "block long, dim int, ids binary, rows binary, exact binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Integer vectors into blocks; numbers follow the partition, so a retry repeats them."""
    number = TaskContext.get().partitionId() << 24
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def out(dim: int, size: int) -> Iterator[pa.RecordBatch]:
        nonlocal number
        ids = np.concatenate([a for a, _ in held[dim]])
        exact = np.concatenate([b for _, b in held[dim]])
        while len(ids) >= size:
            part, ids = ids[:BLOCK], ids[BLOCK:]
            vectors, exact = exact[:BLOCK], exact[BLOCK:]
            low, high = vectors.min(0), vectors.max(0)
            step = np.maximum((high - low) / CELLS, 1e-9)
            cells = np.clip(((vectors - low) / step).astype(np.int64), 0, CELLS - 1).astype(np.uint8)
            yield pa.RecordBatch.from_pylist(
                [dict(block=number, dim=dim, ids=part.tobytes(), low=low.tobytes(), step=step.tobytes(), cells=cells.tobytes(), exact=vectors.tobytes())],
                pa.schema([("block", pa.int64()), ("dim", pa.int32()), *((c, pa.binary()) for c in ("ids", "low", "step", "cells", "exact"))]),
            )
            number += 1
            if not len(ids):
                break
        held[dim] = [(ids, exact)]

    for batch in batches:
        column = batch.column(1)
        lengths = np.asarray(pc.list_value_length(column), np.int64)
        flat = np.asarray(column.flatten(), float)
        ids = np.asarray(batch.column(0), np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        for dim in np.unique(lengths):
            rows = np.flatnonzero(lengths == dim)
            vectors = np.floor(256 * flat[starts[rows][:, None] + np.arange(dim)])
            held.setdefault(int(dim), []).append((ids[rows], vectors))
            if sum(len(a) for a, _ in held[int(dim)]) >= BLOCK:
                yield from out(int(dim), BLOCK)
    for dim in held:
        if sum(len(a) for a, _ in held[dim]):
            yield from out(dim, 1)


def vector_file(vectors: DataFrame, stage: Stage) -> DataFrame:
    """The blocks of all comparable rows, written to the shared folder."""
    values = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), values.alias("values")).filter(
        F.col("id").isNotNull() & F.col("values").isNotNull() & (F.size("values") > 0)
    )
    rows = rows.filter(~F.exists("values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return stage.keep(rows.mapInArrow(_pack, FILE), "vectors")


def _queries(every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: dict[int, list[tuple]] = {}

        def out(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, rows, exact = (np.concatenate(x) for x in zip(*held.pop(dim)))
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, rows, exact))],
                ["block", "dim", "ids", "rows", "exact"],
            )

        for batch in batches:
            for block, dim, ids, exact in zip(*(batch.column(c).to_pylist() for c in range(4))):
                ids = np.frombuffer(ids, np.int64)
                chosen = np.flatnonzero(ids % every == 0)
                for at in range(0, len(chosen), QUERY_BLOCK):
                    part = chosen[at : at + QUERY_BLOCK]
                    held.setdefault(dim, []).append((ids[part], (block << 12) + part, np.frombuffer(exact).reshape(-1, dim)[part]))
                    if sum(len(x[0]) for x in held[dim]) >= QUERY_BLOCK:
                        yield out(dim)
        for dim in list(held):
            yield out(dim)

    return run


def _best(k: int):
    """The best ``k`` of one block of vectors for each query of one block of queries."""

    def search(q, own, ids, rows, low, step, cells, exact):
        middle = low + (cells + 0.5) * step
        bounds = q @ middle.T + (np.abs(q) @ (step / 2))[:, None]
        bounds += 1e-9 * np.abs(bounds) + 1e-6  # rounding of the bound itself
        out = []
        for i in range(len(q)):
            bound = np.where(rows == own[i], -np.inf, bounds[i])
            take = min(len(ids), 8 * k)
            while True:
                near = np.argpartition(-bound, take - 1)[:take] if take < len(ids) else np.arange(len(ids))
                near = near[rows[near] != own[i]]
                scores = exact[near] @ q[i]
                best = np.lexsort((rows[near], ids[near], -scores))[:k]
                rest = -np.inf
                if take < len(ids):
                    left = np.ones(len(ids), bool)
                    left[near] = False
                    rest = bound[left].max()
                if take >= len(ids) or len(best) == k and scores[best[-1]] > rest:
                    break
                take = min(len(ids), 4 * take)
            out.append((ids[near[best]], rows[near[best]], scores[best]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                dim = pair["dim"]
                qid, own = np.frombuffer(pair["q_ids"], np.int64), np.frombuffer(pair["q_rows"], np.int64)
                ids = np.frombuffer(pair["ids"], np.int64)
                rows = (pair["block"] << 12) + np.arange(len(ids))
                found = search(
                    np.frombuffer(pair["q_exact"]).reshape(-1, dim), own, ids, rows, np.frombuffer(pair["low"]), np.frombuffer(pair["step"]),
                    np.frombuffer(pair["cells"], np.uint8).reshape(-1, dim), np.frombuffer(pair["exact"]).reshape(-1, dim),
                )
                sizes = [len(a) for a, _, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(qid, sizes)), pa.array(np.repeat(own, sizes)), *(pa.array(np.concatenate([f[c] for f in found]).astype(np.int64)) for c in range(3))],
                    ["query_id", "query_row", "vec_id", "vec_row", "score"],
                )

    return run


def top_k(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """For each row whose id is divisible by ``every``: its ``k`` best other rows by the
    integer inner product of ``floor(256 * x)``."""
    stage = Stage(vectors.sparkSession, "vector-file")
    file = vector_file(vectors, stage)
    queries = stage.keep(file.select("block", "dim", "ids", "exact").mapInArrow(_queries(every), PACK), "queries")
    buckets = -(-queries.count() // PAIRED) or 1
    dealt = queries.select(
        F.pmod(F.xxhash64("block"), F.lit(buckets)).cast("int").alias("bucket"),
        "dim",
        *(F.col(c).alias(f"q_{c}") for c in ("ids", "rows", "exact")),
    )
    pairs = file.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).join(dealt, ["bucket", "dim"])
    found = pairs.mapInArrow(_best(k), "query_id long, query_row long, vec_id long, vec_row long, score long")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "vec_row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
