import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lineloom.operators import embed, quality, query, vector_store
from tests.conftest import plan, rows


def packed_by_hand(tokens, limit, reset):
    batch, total, out = 1, 0, []
    for t in tokens:
        total += t
        if total > limit and (reset or total > t):
            batch, total = batch + 1, 0 if reset else t
        out.append(batch)
    return out


@pytest.mark.parametrize("reset", [False, True])
def test_packing_matches_the_walk(spark, reset):
    draw = random.Random(2)
    sizes = {k: [draw.choice([1, 3, 10, 30]) for _ in range(n)] for k, n in (("a", 300), ("b", 7), (None, 20))}
    data = [(k, i, t) for k, tokens in sizes.items() for i, t in enumerate(tokens)]
    df = spark.createDataFrame(data, "key string, id bigint, tokens int").repartition(3)
    got = embed.pack_batches(df, ["key"], "id", "tokens", limit=20, carry_reset=reset)
    want = [(k, i, n) for k, tokens in sizes.items() for i, n in enumerate(packed_by_hand(tokens, 20, reset))]
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("reset", [False, True])
def test_one_key_is_packed_by_many_tasks(spark, reset):
    draw = random.Random(12)
    for choices in ([0, 1, 3, 10, 30, 50], [0, 0, 0, 21], [1], [25, 0]):
        sizes = [draw.choice(choices) for _ in range(400)]
        df = spark.createDataFrame([("a", i, t) for i, t in enumerate(sizes)], "key string, id bigint, tokens int")
        got = embed.pack_batches(df, ["key"], "id", "tokens", limit=20, carry_reset=reset, partitions=16)
        assert [r.batch_no for r in got.orderBy("id").collect()] == packed_by_hand(sizes, 20, reset)
    spread = got.select(F.spark_partition_id().alias("task")).distinct().count()
    assert spread > 1 or got.rdd.getNumPartitions() == 1


def test_running_total_goes_over_all_blocks(spark):
    df = spark.range(200).select("id", (F.col("id") % 5).alias("tokens")).repartition(3)
    got = embed.running_tokens(df, "id", "tokens", partitions=9).orderBy("id").collect()
    assert [r.running_total for r in got] == [sum(i % 5 for i in range(n + 1)) for n in range(200)]


def test_running_total_over_hashed_positions(spark, monkeypatch):
    kept, stage = [], embed.staged
    monkeypatch.setattr(embed, "staged", lambda df: kept.append(stage(df)) or kept[-1])
    df = spark.range(500).select(F.xxhash64("id").alias("id"), (F.col("id") % 5).alias("tokens"))
    got = embed.running_tokens(df, "id", "tokens", partitions=8)
    sizes = [r["count"] for r in kept[0].groupBy("_block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 200, "no range holds all rows"
    want, total = [], 0
    for r in df.orderBy("id").collect():
        total += r.tokens
        want.append((r.id, r.tokens, total))
    assert [tuple(r) for r in got.orderBy("id").collect()] == want


def chunk_rows(spark, n=30):
    base = spark.range(n).select(
        F.col("id").cast("string").alias("chunk_id"), F.concat_ws(" ", F.lit("word"), F.col("id")).alias("source")
    )
    return base.withColumn("errors", quality.no_errors())


def test_provider_batches_and_merge(spark):
    def provider(texts):
        assert len(texts) <= 5
        return [[float(len(t)), 1.0] for t in texts]

    chunks = chunk_rows(spark).coalesce(1)
    results = embed.embed(chunks, provider, limit=10)
    assert results.agg(F.countDistinct("batch_no")).first()[0] == 6
    merged = quality.with_status(embed.merge_results(chunks, results))
    assert merged.where("status = 'embedded'").count() == 30


def test_failing_provider_marks_its_batch_and_the_job_goes_on(spark):
    def provider(texts):
        if any("7" in t for t in texts):
            raise RuntimeError("refused")
        return [[1.0] for _ in texts]

    chunks = chunk_rows(spark).coalesce(1)
    merged = quality.with_status(embed.merge_results(chunks, embed.embed(chunks, provider, limit=2, wait=0.0)))
    failed = {r.chunk_id: r.errors[0].error for r in merged.where("status = 'failed'").collect()}
    assert failed == {"7": "refused", "17": "refused", "27": "refused"}


def test_provider_is_tried_three_times():
    calls = []

    def provider(texts):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("later")
        return [[1.0]]

    assert embed.call_provider(provider, ["a"], wait=0.0) == ([[1.0]], None) and len(calls) == 3
    assert embed.call_provider(lambda texts: [], ["a"], wait=0.0)[1] == "0 vectors for 1 texts"


def test_provider_registry():
    embed.register_provider("Mine", len)
    assert embed.provider_named("mine") is len
    with pytest.raises(ValueError):
        embed.provider_named("other")


def test_hashed_vectors_count_every_token(spark):
    df = spark.createDataFrame([(1, "a b a, x"), (2, "z"), (3, "")], "id int, t string")
    got = {r.id: r.embedding for r in embed.hash_vectors(df, "id", "t", 16).collect()}
    assert set(got) == {1, 2} and all(len(v) == 16 for v in got.values())
    assert sum(got[1]) == 5.0 and sum(got[2]) == 1.0
    sparse = {(r.id, r.bucket): r.tf for r in embed.hash_buckets(df, "id", "t", 16).collect()}
    assert all(got[i][b] == tf for (i, b), tf in sparse.items())


def test_results_carry_what_is_kept(spark):
    texts = [(f"c{i}", "x " * (i % 7), None if i % 3 else f"n{i}", i) for i in range(40)] + [("long", "x " * 50, "far", 1)]
    chunks = quality.validate(spark.createDataFrame(texts, "chunk_id string, source string, name string, chunk_no int"), max_tokens=20)
    found = embed.embed(chunks, lambda ts: [[float(len(t))] for t in ts], limit=9, kept=["name", "source", "chunk_no"])
    joined = embed.embed(chunks, lambda ts: [[float(len(t))] for t in ts], limit=9).join(chunks.select("chunk_id", "name", "source", "chunk_no"), "chunk_id")
    assert "Join" not in plan(found)
    assert rows(found.select(*joined.columns)) == rows(joined) and found.count() == 40


def test_vectors_are_counted_in_the_row_of_their_text(spark):
    odd = "a\u00a0b \u2003 \U0001f600\U0001f600 é_é\x0b\x1c.. don't A1_b\n\r\t"
    texts = [(1, odd), (2, ""), (3, None), (4, " \n"), (5, "x " * 5000 + odd), (6, "one two"), (6, "two, three"), (None, "lost")]
    df = spark.createDataFrame(texts, "id int, t string")
    found = embed.hash_vectors(df, "id", "t", 16)
    assert plan(found).count("Exchange hashpartitioning") == 1 and "Generate" not in plan(found)
    got = {r.id: r.embedding for r in found.collect()}
    want = {}
    for r in embed.hash_buckets(df, "id", "t", 16).collect():
        want.setdefault(r.id, [0.0] * 16)[r.bucket] = float(r.tf)
    assert got == want and set(got) == {1, 5, 6, None}


def points(spark, n=200, dim=8):
    draw = np.random.default_rng(4)
    matrix = draw.normal(size=(n, dim)).round(1)
    matrix[5] = 0
    data = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)] + [(n, None)]
    return matrix, spark.createDataFrame(data, "chunk_id int, embedding array<float>")


def brute(matrix, wanted, k):
    m = matrix.astype(np.float32).astype(np.float64)
    size = np.linalg.norm(m, axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        scores = (m @ wanted) / (size * np.linalg.norm(wanted))
    ranked = sorted((-round(s, 6), i) for i, s in enumerate(scores) if size[i] > 0)
    return [i for _, i in ranked[:k]]


@pytest.mark.parametrize("point_rows, query_rows", [(2048, 512), (7, 3), (1, 1)])
def test_batch_search_is_exact_for_any_block_size(spark, point_rows, query_rows):
    """More queries than a block holds, and more blocks than meet in one key."""
    matrix, df = points(spark)
    queries = df.where("chunk_id < 12").select(F.col("chunk_id").alias("query_id"), "embedding")
    got = vector_store.search_batch(df.repartition(5), queries, 4, point_rows=point_rows, query_rows=query_rows)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.chunk_id)
    exact = matrix.astype(np.float32).astype(np.float64)
    assert found == {q: brute(matrix, exact[q], 4) for q in range(12) if q != 5}


def test_search_takes_the_top_without_a_full_sort(spark):
    matrix, df = points(spark)
    wanted = [1.0, 0.5, 0, 0, 0, -1, 0, 2]
    top = vector_store.search(df, wanted, 6)
    assert [r.chunk_id for r in top.collect()] == brute(matrix, np.array(wanted), 6)
    assert "TakeOrderedAndProject" in plan(top) and "Exchange" not in plan(top)
    with pytest.raises(ValueError):
        vector_store.search(df, [0.0] * 8)


def test_upsert_and_dimension_check(spark):
    old = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "chunk_id string, embedding array<float>")
    new = spark.createDataFrame(
        [("b", [3.0], 1), ("b", [4.0], 2), ("c", [5.0, 6.0], 1)], "chunk_id string, embedding array<float>, v int"
    )
    after = vector_store.upsert(old, new, version="v")
    assert rows(after) == [("a", [1.0]), ("b", [4.0]), ("c", [5.0, 6.0])]
    assert rows(vector_store.check_dim(after, 1).where("error is not null").select("chunk_id", "error")) == [
        ("c", "expected 1 values, got 2")
    ]


def test_only_clean_chunks_become_points_and_payload_has_seven_columns(spark):
    data = [("a", [], [1.0]), ("b", [("validation", "too large")], [1.0]), ("c", [], None)]
    df = spark.createDataFrame(data, "chunk_id string, errors array<struct<source:string,error:string>>, embedding array<float>")
    for name, kind in [("type", "string"), ("name", "string"), ("chunk_no", "int"), ("start_line", "int"), ("end_line", "int"), ("file_path", "string"), ("source", "string")]:
        df = df.withColumn(name, F.lit(None).cast(kind))
    ready = vector_store.points(df)
    assert [r.chunk_id for r in ready.collect()] == ["a"]
    hits = vector_store.search(ready, [1.0], 1)
    assert query.payloads(hits).columns == ["type", "name", "chunk_no", "start_line", "end_line", "file_path", "source"]


def test_validation_is_repeatable(spark):
    chunks = spark.createDataFrame([("a", "x " * 10), ("b", "x")], "chunk_id string, source string")
    once = quality.validate(chunks, max_tokens=9)
    twice = quality.validate(once.select("chunk_id", "source", "errors"), max_tokens=9)
    assert rows(once) == rows(twice)
    assert rows(quality.error_rows(twice)) == [("a", "validation", "chunk a too large: 10 tokens while maximum is 9")]
    assert tuple(quality.error_counts(twice).first()) == (1, 1)
    relaxed = quality.validate(once.select("chunk_id", "source", "errors"), max_tokens=10)
    assert quality.cleanup(relaxed).count() == 0


def test_tokenizer_hook(spark):
    chunks = spark.createDataFrame([("a", "one two"), ("b", "one")], "chunk_id string, source string")
    got = quality.validate(chunks, max_tokens=3, tokenizer=F.length)
    assert [r.chunk_id for r in got.where("size(errors) = 0").collect()] == ["b"]


def test_retrieval_context_for_questions_without_hits(spark):
    questions = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "query_id int, embedding array<double>")
    store = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0])], "chunk_id string, embedding array<float>")
    sources = spark.createDataFrame([("a", "A"), ("b", "B")], "chunk_id string, source string")
    assert rows(query.retrieval_context(questions, store, sources)) == [(1, "A\n---\nB"), (2, query.NO_CONTEXT)]
