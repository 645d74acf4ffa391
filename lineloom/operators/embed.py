"""Token-bounded batches, embedding providers, and their results on the chunks."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineloom.functions import text, vectors
from lineloom.operators.quality import is_clean, put_error
from lineloom.plans.scan import with_running
from lineloom.schemas import MAX_TOKENS
from lineloom.session import staged

# What a failed provider call waits for before the next, in units of ``wait`` seconds.
PAUSES = (1, 2)
FIRST_WAIT = 1.0
# Tokens whose bucket a task remembers.
HELD_TOKENS = 100_000

Provider = Callable[[list[str]], Sequence[Sequence[float]]]

_RESULT = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("batch_no", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("error", T.StringType()),
    ]
)


def running_tokens(df: DataFrame, position: str, tokens: str, partitions: int | None = None) -> DataFrame:
    """Total of ``tokens`` up to and including each row, over all rows in the order of ``position``.

    Rows are dealt to ranges of positions by a sample of them, so sparse or hashed positions fill
    ranges as evenly as dense ones; a range adds up its own rows and gets the total of those before it.
    """
    spread = df.repartitionByRange(partitions, position) if partitions else df.repartitionByRange(position)
    # written, so that a row's range is the same wherever it is read
    ranges = staged(spread.withColumn("_block", F.spark_partition_id()))
    before = with_running(ranges, [], [position], sums={"_before": F.col(tokens)})
    return before.withColumn("running_total", F.col("_before") + F.col(tokens)).select(*df.columns, "running_total")


def _exits(sizes: np.ndarray, limit: int, carry_reset: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a block of rows does to a batch that is open before it, for every row that may be
    the first to open another: the tokens up to it, the batches opened from it on, and the
    tokens of the last. Only rows up to the first that opens one after an empty batch count."""
    upto = np.cumsum(sizes)
    n = len(sizes)
    before = upto - sizes
    rows = np.arange(n)
    if carry_reset:
        after = np.searchsorted(upto, limit + upto, "right")
    else:
        after = np.maximum(np.searchsorted(upto, limit + before, "right"), rows + 1)
        alone = (after < n) & (before[np.minimum(after, n - 1)] == before)
        after = np.where(alone, after + 1, after)  # a row that is too large by itself stays in an empty batch
    opened, left = np.ones(n, np.int64), upto[-1] - (upto if carry_reset else before)
    for i in range(n - 1, -1, -1):
        if after[i] < n:
            opened[i] += opened[after[i]]
            left[i] = left[after[i]]
    first = int(np.searchsorted(upto, limit, "right"))
    return upto[: first + 2], opened[: first + 2], left[: first + 2]


def _entered(total: int, sizes: np.ndarray, upto: np.ndarray, limit: int, carry_reset: bool) -> int:
    """The first row that opens a batch if ``total`` tokens are in the batch before the block; as
    many as ``upto`` has if none does."""
    k = int(np.searchsorted(upto, limit - total, "right"))
    if not carry_reset and k < len(upto) and total + upto[k] - sizes[k] == 0:
        k += 1
    return k


def pack_batches(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    tokens: str,
    *,
    limit: int = MAX_TOKENS,
    carry_reset: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Greedy packing of the rows of each key, in the order of ``position``: a row that
    would exceed ``limit`` opens the next batch. Adds ``batch_no`` to keys and position.
    With ``carry_reset`` the row that opens a batch is not counted in it.

    Where a batch begins depends on all rows of its key before it, yet a key is not one task:
    rows are dealt to blocks by key and position. What was packed before a block only decides
    which row is the first to open a batch in it; from there on the block is known. So each
    block tells, for every row that may be the first, how many batches follow and what is left
    in the last. A walk over these short tables, one row a block, gives every block the batch
    it begins in, and then all blocks number their rows at once.
    """
    names = [*keys, position]
    rows = df.select(*names, F.coalesce(tokens, F.lit(0)).cast("bigint").alias("_tokens"))
    spread = rows.repartitionByRange(partitions, *names) if partitions else rows.repartitionByRange(*names)
    # written, so that the blocks are the same in both passes
    rows = staged(spread.withColumn("_block", F.spark_partition_id()))
    owner = F.to_json(F.struct(*keys)) if keys else F.lit("")
    rows = rows.withColumn("_owner", owner)

    def told(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame.sort_values([position])["_tokens"].to_numpy()
        upto, opened, left = _exits(sizes, limit, carry_reset)
        head = {"_owner": [frame["_owner"].iloc[0]], "_block": [frame["_block"].iloc[0]], "all": [int(sizes.sum())]}
        return pd.DataFrame(head | {"sizes": [sizes[: len(upto)]], "upto": [upto], "opened": [opened], "left": [left]})

    known = "_owner string, _block int, all long, sizes array<long>, upto array<long>, opened array<long>, left array<long>"
    blocks = rows.groupBy("_owner", "_block").applyInPandas(told, known)

    def enter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, batch, total = None, 1, 0
        for frame in frames:
            begins = []
            for block in frame.itertuples(index=False):
                if block[0] != at:
                    at, batch, total = block[0], 1, 0
                begins.append((batch, total))
                k = _entered(total, block.sizes, block.upto, limit, carry_reset)
                if k < len(block.upto):
                    batch, total = batch + int(block.opened[k]), int(block.left[k])
                else:
                    total += block.all
            batches, totals = zip(*begins) if begins else ((), ())
            yield frame[["_owner", "_block"]].assign(_batch=list(batches), _total=list(totals))

    begins = blocks.repartition("_owner").sortWithinPartitions("_owner", "_block")
    begins = begins.mapInPandas(enter, "_owner string, _block int, _batch long, _total long")
    schema = T.StructType([*(rows.schema[n] for n in names), T.StructField("batch_no", T.LongType())])

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, batch, total = None, 1, 0
        for frame in frames:
            numbers = []
            for place, begin, size in zip(zip(frame["_owner"], frame["_block"]), zip(frame["_batch"], frame["_total"]), frame["_tokens"]):
                if place != at:
                    at, (batch, total) = place, begin
                total += size
                if total > limit and (carry_reset or total > size):
                    batch, total = batch + 1, 0 if carry_reset else size
                numbers.append(batch)
            yield frame[names].assign(batch_no=numbers)

    walked = rows.join(begins, ["_owner", "_block"]).repartition("_owner", "_block").sortWithinPartitions("_owner", "_block", position)
    return walked.mapInPandas(number, schema)


def hash_buckets(df: DataFrame, id_column: str, source: str, dim: int) -> DataFrame:
    """Feature hashing in sparse form: ``id, bucket, tf``.

    A text's tokens are counted where they are read, so at most ``dim`` rows per
    text and task are shuffled.
    """
    return (
        df.select(id_column, F.explode(vectors.tokens(F.col(source))).alias("token"))
        .groupBy(id_column, vectors.bucket_of(F.col("token"), dim).alias("bucket"))
        .agg(F.count("*").alias("tf"))
    )


def hash_vectors(df: DataFrame, id_column: str, source: str, dim: int) -> DataFrame:
    """Feature hashing in dense form: ``id, embedding``; texts without tokens drop out.

    A text's tokens are counted in its own row; a task hashes a token once while it is among
    the latest ``HELD_TOKENS``. Vectors of one id are added up.
    """
    kind = df.schema[id_column].dataType
    schema = T.StructType([T.StructField("_id", kind), T.StructField("embedding", T.ArrayType(T.FloatType()))])
    pattern, held = text.TOKEN, HELD_TOKENS

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(pattern, re.ASCII).findall

        @lru_cache(held)
        def bucket(token: str) -> int:
            return int(md5(token.encode()).hexdigest()[:8], 16) % dim

        for batch in batches:
            kept, found = [], []
            for row, one in enumerate(batch.column(1).cast(pa.binary())):
                buckets = list(map(bucket, find(one.as_py().decode(errors="replace"))))
                if buckets:
                    kept.append(row)
                    found.append(np.bincount(buckets, minlength=dim).astype(np.float32))
            vectors_ = pa.array(found, pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), vectors_], ["_id", "embedding"])

    texts = df.where(F.col(source).isNotNull()).select(F.col(id_column).alias("_id"), F.col(source).alias("_text"))
    own = texts.mapInArrow(hashed, schema).groupBy(F.col("_id").alias(id_column)).agg(F.collect_list("embedding").alias("_all"))

    def added(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: x + y)

    total = F.aggregate(F.slice("_all", F.lit(2), F.size("_all")), F.get("_all", 0), added)
    return own.select(id_column, F.when(F.size("_all") == 1, F.get("_all", 0)).otherwise(total).alias("embedding"))


def call_provider(provider: Provider, texts: list[str], wait: float = FIRST_WAIT):
    """Vectors of ``texts`` and no error, or no vectors and what the last call said."""
    said = None
    for pause in (*PAUSES, None):
        try:
            answer = [list(map(float, vector)) for vector in provider(texts)]
        except Exception as failure:  # noqa: BLE001 - a provider may fail in any way
            said = str(failure)
        else:
            if len(answer) == len(texts):
                return answer, None
            said = f"{len(answer)} vectors for {len(texts)} texts"
        if pause is not None:
            time.sleep(pause * wait)
    return None, said


def embed(
    chunks: DataFrame,
    provider: Provider,
    *,
    limit: int = MAX_TOKENS,
    tokenizer: Callable[[Column], Column] = text.token_count,
    wait: float = FIRST_WAIT,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Results of ``provider`` for the clean chunks: ``chunk_id, batch_no, embedding, error``, and the
    ``kept`` columns of the chunk, so that who needs these works out and joins no chunk again.

    Each task packs its rows into batches of up to ``limit`` tokens and sends one
    request per batch; the number of partitions bounds the requests in flight. A
    failed batch becomes error rows and the job goes on.
    """
    work = chunks.where(is_clean()).select("chunk_id", F.col("source").alias("_text"), tokenizer(F.col("source")).alias("_tokens"), *kept)
    result = T.StructType([*_RESULT, *(chunks.schema[c] for c in kept)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[str] = []
        texts: list[str] = []
        rest: list[tuple] = []
        total, batch_no = 0, 1

        def send() -> pd.DataFrame:
            found, error = call_provider(provider, texts, wait)
            told = {"chunk_id": ids, "batch_no": batch_no, "embedding": found or [None] * len(ids), "error": error}
            return pd.DataFrame(told | dict(zip(kept, map(list, zip(*rest)))))

        for frame in frames:
            for chunk_id, source, tokens, *others in frame.itertuples(index=False, name=None):
                if ids and total + tokens > limit:
                    yield send()
                    ids, texts, rest, total, batch_no = [], [], [], 0, batch_no + 1
                ids.append(chunk_id)
                texts.append(source)
                rest.append(others)
                total += tokens
        if ids:
            yield send()

    return work.mapInPandas(run, result)


def merge_results(chunks: DataFrame, results: DataFrame) -> DataFrame:
    """Chunks with ``embedding``, or with an error where the provider gave none."""
    got = results.select(
        "chunk_id",
        F.col("embedding").alias("new_embedding"),
        F.col("error").alias("new_error"),
    )
    joined = chunks.join(got, "chunk_id", "left")
    missing = is_clean() & F.col("new_embedding").isNull()
    error = F.when(missing, F.coalesce("new_error", F.lit("no embedding")))
    kept = [c for c in chunks.columns if c not in ("errors", "embedding")]
    return joined.select(
        *kept,
        F.when(is_clean(), put_error(F.col("errors"), "embedding", error)).otherwise(F.col("errors")).alias("errors"),
        F.col("new_embedding").cast("array<float>").alias("embedding"),
    )


PROVIDERS: dict[str, Provider] = {}


def register_provider(name: str, provider: Provider) -> None:
    PROVIDERS[name.lower()] = provider


def provider_named(name: str) -> Provider:
    try:
        return PROVIDERS[name.lower()]
    except KeyError:
        raise ValueError(f"no embedding provider named {name}") from None
