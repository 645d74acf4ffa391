import random

import pytest
from pyspark.sql import functions as F

from lineloom.plans.ranges import join_covering
from lineloom.plans.scan import BLOCK, WHOLE, block_for, with_running
from tests.conftest import rows


def sequences(seed):
    """One hot group with most rows and a few small ones."""
    draw = random.Random(seed)
    out = []
    for group, size in [("hot", 300), ("a", 7), ("b", 1), ("c", 20)]:
        for i in range(size):
            out.append((group, i, draw.randint(-3, 3), draw.choice([None, None, None, i])))
    return out


def folded(data, reverse):
    found = []
    for group in {r[0] for r in data}:
        total, last = 0, None
        for _, i, step, mark in sorted((r for r in data if r[0] == group), reverse=reverse):
            found.append((group, i, total, last))
            total += step
            last = last if mark is None else mark
    return sorted(found, key=repr)


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("block", [WHOLE, 4, 37, BLOCK])
def test_running_values_match_a_fold(spark, block, reverse):
    data = sequences(block)
    df = spark.createDataFrame(data, "g string, i int, step int, mark int")
    got = with_running(
        df, ["g"], ["i"], sums={"total": F.col("step")}, lasts={"latest": F.col("mark")}, reverse=reverse, block=block
    ).select("g", "i", "total", "latest")
    assert rows(got) == folded(data, reverse)


def test_long_groups_filter_keeps_the_result(spark):
    data = sequences(5)
    sizes = {g: sum(1 for r in data if r[0] == g) for g in "a b c hot".split()}
    df = spark.createDataFrame([(*r, sizes[r[0]]) for r in data], "g string, i int, step int, mark int, n int")
    got = with_running(
        df, ["g"], ["i"], sums={"total": F.col("step")}, lasts={"latest": F.col("mark")}, block=8,
        spans_blocks=F.col("n") > 8,
    ).select("g", "i", "total", "latest")
    assert rows(got) == folded(data, False)


def test_block_is_chosen_by_the_longest_file(spark):
    assert block_for(spark.createDataFrame([(10,), (BLOCK - 1,)], "n_lines int")) == WHOLE
    assert block_for(spark.createDataFrame([(10,), (BLOCK,)], "n_lines int")) == BLOCK
    assert block_for(spark.createDataFrame([(10,)], "n_lines int"), block=7) == 7


def test_covering_join_finds_every_pair(spark):
    draw = random.Random(1)
    points = [("f", p) for p in range(0, 400, 3)]
    ranges = [("f", n, s, s + draw.randint(0, 150)) for n, s in enumerate(draw.sample(range(400), 40))]
    got = join_covering(
        spark.createDataFrame(points, "k string, p int"),
        spark.createDataFrame(ranges, "k string, id int, s int, e int"),
        ["k"], "p", "s", "e", width=16,
    ).select("p", "id")
    assert rows(got) == sorted(((p, n) for _, p in points for _, n, s, e in ranges if s <= p <= e), key=repr)
