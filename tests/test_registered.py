"""A few registered queries against DuckDB; ``tools/check.py`` runs them all."""

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from tests.conftest import plan
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["chunk_java", "chunk_py", "chunk_sql", "chunk_markup", "line_context", "trace_explain", "graph_reach", "embed_batches", "token_running", "embed_merge", "sql_join_self"])
def test_query_equals_counterpart(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got, sorted(got.columns)) == rows_of(want, sorted(got.columns))


def test_recursion_visits_every_line(spark):
    found = entry.queries()["sql_recursive"](spark, SF).toPandas().groupby("file_path")
    walks = [(sorted(w.file_line_no), sorted(w.step)) for _, w in found]
    assert walks and all(lines == list(range(1, len(lines) + 1)) and steps == list(range(len(lines))) for lines, steps in walks)
    assert max(len(lines) for lines, _ in walks) > 100


def test_flagship_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["chunk_java", "line_context", "trace_context", "graph_ast_calls", "sql_join_self"])
def test_no_cross_joins_and_no_single_partition_windows(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text and "SinglePartition" not in text
