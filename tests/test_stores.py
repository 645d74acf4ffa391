import json
import os
import re
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lineloom.operators import all_chunks, files, graph, java, lines, markup, python_source, query, sql_source
from lineloom.operators.lines import numbered_lines
from lineloom.schemas import LINE, STORED_LINE
from lineloom.sources import stores, tree
from lineloom.streaming import ingest
from lineloom.streaming.ingest import ingest_lines
from tests.conftest import files as texts
from tests.conftest import plan, rows


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


@pytest.fixture
def root(tmp_path):
    base = str(tmp_path / "proj")
    for name in ("__init__.py", ".x.py", "a.PY", "sub/b.py", "sub/c.txt", ".git/d.py", "VENV/e.py", "sub/deep/er/f.py", ".py"):
        write(f"{base}/{name}", b"x = 1\r\n")
    write(f"{base}/sub/bad.py", b"\xff\xfe")
    return base


def test_tree_keeps_hidden_files_and_prunes_directories(spark, root):
    good, bad = tree.read_tree(spark, root, ["py"], ["venv"], project_root=root)
    assert {r.file_path for r in good.collect()} == {"__init__.py", ".x.py", "a.PY", "sub/b.py", "sub/deep/er/f.py"}
    assert {r.content for r in good.collect()} == {"x = 1\n"}
    assert rows(bad) == [("sub/bad.py", "not valid UTF-8")]
    with pytest.raises(ValueError):
        tree.list_files(spark, root, [])


def test_path_predicate_agrees_with_the_walk(spark, root):
    listed = []
    for directory, _, names in os.walk(root):
        listed += [(os.path.relpath(os.path.join(directory, n), root),) for n in names]
    df = spark.createDataFrame(listed, "file_path string")
    kept = {r.file_path for r in files.scan_paths(df, [".py"], ["Venv"]).collect()}
    walked = tree.list_files(spark, root, ["py"], ["venv"])
    assert kept == {os.path.relpath(r.file_path, root) for r in walked.collect()}


def test_missing_file_is_quarantined(spark, tmp_path):
    gone = spark.createDataFrame([(str(tmp_path / "gone.py"), 1)], "file_path string, size bigint")
    good, bad = tree.decode(tree.read_contents(gone))
    assert good.count() == 0 and "No such file" in bad.first().reason


def test_trace_files(spark, tmp_path):
    write(str(tmp_path / "t" / "one.txt"), b"E\n at a.B.c(B.java:1)\n")
    assert [r.trace for r in tree.read_traces(spark, str(tmp_path / "t"))[0].collect()] == ["E\n at a.B.c(B.java:1)\n"]


def test_traces_with_hidden_names_and_addresses(spark, tmp_path):
    for name in ("_x", ".y", "z.log"):
        write(str(tmp_path / "t" / "deep" / name), name.encode())
    write(str(tmp_path / "t" / "bad"), b"\xff")
    for root in (str(tmp_path / "t"), f"file://{tmp_path}/t"):
        got, refused = tree.read_traces(spark, root)
        assert [(r.file_path, r.reason) for r in refused.collect()] == [(f"{root}/bad", "not valid UTF-8")]
        assert sorted(r.trace for r in got.collect()) == [".y", "_x", "z.log"]
        assert {r.trace_id for r in got.collect()} == {f"{root}/deep/{n}" for n in ("_x", ".y", "z.log")}


def test_directories_that_cannot_be_listed_are_reported(spark, tmp_path):
    missing = str(tmp_path / "none")
    assert [(r.file_path, r.size) for r in tree.list_files(spark, missing, ["py"]).collect()] == [(missing, None)]
    good, bad = tree.read_tree(spark, missing, ["py"])
    assert good.count() == 0 and "No such file" in bad.first().reason


def test_many_directories_share_few_tasks(spark, tmp_path):
    for i in range(90):
        write(str(tmp_path / "r" / f"d{i}" / "e" / "f.py"), b"x = 1\n")
    listed = tree.list_files(spark, str(tmp_path / "r"), ["py"])
    assert listed.count() == 90 and listed.rdd.getNumPartitions() <= 64


def test_chunk_files_without_errors_read_as_clean(spark, tmp_path):
    one = {"type": "class", "name": "A", "chunk_no": 1, "start_line": 1, "end_line": 2, "file_path": "A.java", "source": "x", "chunk_id": "i"}
    write(str(tmp_path / "chunks" / "chunk_i.json"), json.dumps(one, indent=2).encode())
    df = stores.read_chunks(spark, str(tmp_path / "chunks"), "json")
    assert df.first().errors == [] and df.first().end_line == 2
    stores.write_chunks(df, str(tmp_path / "out"))
    assert rows(stores.read_chunks(spark, str(tmp_path / "out"))) == rows(df)


def lines_of(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.concat(F.lit("id"), "id").alias("line_id"), F.lit("T").alias("parent_type"), F.lit(None).cast("string").alias("parent_method"),
        F.col("id").cast("int").alias("file_line_no"), F.lit("A.java").alias("file_path"), F.lit("s").alias("source"),
    )


def test_line_load_is_idempotent_and_reports(spark, tmp_path):
    path = str(tmp_path / "lines")
    current = stores.ensure_table(spark, path, STORED_LINE)
    assert current.count() == 0
    stores.write_lines(stores.stamped(stores.new_lines(current, lines_of(spark, 5).union(lines_of(spark, 2)))), path)
    current = stores.read_lines(spark, path)
    assert current.count() == 5 and current.where("created_at is null").count() == 0
    assert stores.new_lines(current, lines_of(spark, 8)).count() == 3
    assert rows(stores.load_report(current, lines_of(spark, 8).union(lines_of(spark, 1)))) == [("A.java", 9, 3, 6)]
    assert stores.ensure_table(spark, path, STORED_LINE).count() == 5


def test_spool_is_loaded_once(spark, tmp_path):
    spool, table, state = (str(tmp_path / n) for n in ("spool", "table", "state"))

    def spooled(name, first, last):
        entries = [
            {"line_id": f"l{i}", "parent_type": None, "parent_method": "m", "file_line_no": i, "file_path": "A", "source": "s"}
            for i in range(first, last)
        ]
        write(f"{spool}/{name}.json", json.dumps(entries, indent=2).encode())

    spooled("lines_1", 0, 4)
    ingest_lines(spark, spool, table, state).awaitTermination()
    spooled("lines_2", 2, 7)
    ingest_lines(spark, spool, table, state).awaitTermination()
    ingest_lines(spark, spool, table, state).awaitTermination()
    stored = spark.read.parquet(table)
    assert stored.count() == 7 and stored.select("line_id").distinct().count() == 7
    assert set(LINE.fieldNames()) <= set(stored.columns)


def test_many_batches_keep_few_files_and_read_their_buckets(spark, tmp_path):
    spool, table, state = (str(tmp_path / n) for n in ("spool", "table", "state"))
    # id i comes in batches i // 2 and i // 2 + 1, the second time with another text
    for number in range(19):
        ids = range(max(0, 2 * number - 2), 2 * number + 2)
        entries = [{"line_id": f"l{i}", "file_line_no": i, "file_path": "A", "source": f"{i // 2 == number}"} for i in ids]
        write(f"{spool}/lines_{number:02}.json", json.dumps(entries).encode())
        os.utime(f"{spool}/lines_{number:02}.json", (1_700_000_000 + number,) * 2)
    ingest_lines(spark, spool, table, state, buckets=3, tier=3, files_per_batch=1).awaitTermination()
    got = ingest.stored(spark, table)
    assert rows(got.select("line_id", "source")) == sorted(((f"l{i}", "True") for i in range(38)), key=repr)
    assert got.where(F.col("bucket") != ingest.bucket_of("line_id", 3)).count() == 0
    # 19 batches: two merged nine at a time, one more
    assert {r.batch for r in got.select("batch").distinct().collect()} == {8, 17, 18}
    data = [os.path.join(d, n) for d, _, names in os.walk(table) for n in names if n.endswith(".parquet")]
    assert len(data) <= 3 * 3
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan(got.where(F.col("bucket").isin([1]))))
    write(f"{tmp_path}/old/batch=0/x.parquet", b"")
    with pytest.raises(Exception, match="laid out by batch alone"):
        ingest_lines(spark, spool, str(tmp_path / "old"), str(tmp_path / "other")).awaitTermination()


def test_a_replayed_merge_gives_the_same(spark, tmp_path):
    table = str(tmp_path / "table")
    for batch in range(3):
        part = stores.stamped(lines_of(spark, 5, 5 * batch)).withColumn("bucket", ingest.bucket_of("line_id", 2))
        ingest._write(part.withColumn("batch", F.lit(batch).cast("bigint")), table)
    before = rows(ingest.stored(spark, table).drop("batch"))
    ingest._compact(spark, table, 3, 3)
    # as if stopped between writing and deleting
    ingest._write(ingest.stored(spark, table).where("file_line_no < 5").withColumn("batch", F.lit(0).cast("bigint")), table)
    ingest._compact(spark, table, 3, 3)
    assert rows(ingest.stored(spark, table).drop("batch")) == before
    assert {r.batch for r in ingest.stored(spark, table).collect()} == {2}


def test_sql_takes_queries_only(spark, tmp_path):
    views = {"lines": lines_of(spark, 5)}
    assert query.sql_query(spark, "SELECT count(*) AS n FROM lines;", views).first().n == 5
    assert query.sql_query(spark, "WITH a AS (SELECT 1 AS x) SELECT x FROM a -- note", views).first().x == 1
    for statement in (
        "DROP VIEW lines", "CREATE TABLE t (a INT)", "INSERT INTO lines SELECT * FROM lines", "SELECT 1) UNION (SELECT 2",
        "WITH a AS (SELECT * FROM lines) INSERT INTO lines SELECT * FROM a",
    ):
        with pytest.raises((PySparkException, ValueError)):
            query.sql_query(spark, statement, views).collect()


def test_like_ignores_case_and_views_show_dashes(spark):
    df = spark.createDataFrame(
        [("A", 1, None, "", "String Password;")], "file_path string, file_line_no int, parent_type string, parent_method string, source string"
    )
    assert query.lines_like(df, "%password%").count() == 1
    assert tuple(query.line_view(df).first()) == ("A", 1, "-", "-", "String Password;")


JAVA = """package p;
class A {
    void a() { log("password (x)", b(1)); int n = c(2); }
    void b(int i) {
        c(i);
    }
    void c(int i) { if (i > 0) { a(); } }
    void d() { eval("x"); }
}
"""


def elements(spark):
    lines = numbered_lines(texts(spark, A__java=JAVA), "java")
    return graph.build(lines, java.declarations(lines))


def test_graph_elements(spark):
    nodes = graph.nodes(elements(spark))
    assert {r.name for r in graph.of_kind(nodes, "method").collect()} == set("abcd")
    assert {r.name for r in graph.of_kind(nodes, "local").collect()} == {"n"}
    assert {r.code for r in graph.calls_by_code(nodes, ".*password.*").collect()} == {'log("password (x)", b(1))'}
    assert {r.code for r in graph.calls_by_name(nodes, "eval").collect()} == {'eval("x")'}
    assert graph.calls_by_code(nodes, "eval").count() == 0, "the whole code must match"
    roots = graph.of_kind(nodes, "method").where("name = 'b'")
    assert [r.code for r in graph.ast_of(nodes, roots, "call").collect()] == ["c(i)"]


WIDE = """package p;
@interface Mark { String value() default "";
    int size();
}
class A {
    int field = one(1);
    A(int a) {
        int kept = a;
        if (a > 0) { long more = a; }
    }
    static { String once = "}"; }
    void wide() {
        send(first(1),
            // a comment (
            second("(", 2));
        l0(l1(l2(l3(l4(l5(l6(l7(l8(l9(1))))))))));
        new B()
            .with(3)
            .done();
        open(4,
    }
}
interface I { int size(); }
"""


@pytest.mark.parametrize("block", [None, 3])
def test_calls_of_any_depth_over_lines_and_locals_outside_methods(spark, block):
    lines = numbered_lines(texts(spark, A__java=WIDE), "java")
    spans = java.declarations(lines, block)
    # the constructor is a method in none of the tables; elements of annotations are no methods
    assert {(r.kind, r.name) for r in spans.collect()} == {
        ("package", "p"), ("class", "A"), ("method", "wide"), ("interface", "I"), ("method", "size")}
    found = graph.build(lines, spans, block).collect()
    deep = {f"l{k}": "".join(f"l{i}(" for i in range(k, 10)) + "1" + ")" * (10 - k) for k in range(10)}
    send = 'send(first(1),\n            // a comment (\n            second("(", 2))'
    want = deep | {"one": "one(1)", "send": send, "first": "first(1)", "second": 'second("(", 2)', "B": "B()", "with": "with(3)", "done": "done()", "open": "open(4,"}
    assert {r.name: r.code for r in found if r.kind == "call"} == want
    names = {r.node_id: r.name for r in found}
    assert {(r.name, names[r.parent_id]) for r in found if r.kind == "local"} == {("kept", "<init>"), ("more", "<init>"), ("once", "<init>")}
    assert {names[r.parent_id] for r in found if r.kind == "call"} == {"<init>", "wide"}


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    links = spark.range(1, 10_001).select(F.col("id").alias("node"), (F.col("id") - 1).alias("next"))
    rounds, stage = [], graph.staged
    monkeypatch.setattr(graph, "staged", lambda df: rounds.append(1) or stage(df))
    found = graph.chains(links, spark.createDataFrame([(10_000,), (3,), (0,)], "node bigint"))
    assert len(rounds) <= 2 * 20
    assert found.groupBy("seed").agg(F.count("*").alias("n"), F.max("step").alias("s"), F.min("node").alias("l")).orderBy("seed").collect() == [
        (0, 1, 0, 0), (3, 4, 3, 0), (10_000, 10_001, 10_000, 0)]
    circle = spark.createDataFrame([(1, 2), (2, 1)], "node bigint, next bigint")
    assert graph.chains(circle, spark.createDataFrame([(1,)], "node bigint")).count() <= 4


def test_a_session_without_a_preset_folder_stages(tmp_path):
    script = (
        "from lineloom.session import local_session, shared_folder, staged, unstage; import os, sys\n"
        "spark = local_session('1', 1, *sys.argv[1:])\n"
        "df = staged(spark.range(3)); folder = shared_folder(spark)\n"
        "print('ROWS', df.count(), folder.startswith(sys.argv[1]) if sys.argv[1:] else True)\n"
        "unstage(spark); print('LEFT', os.path.exists(folder.removeprefix('file:')))"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for shared in ([], [str(tmp_path)]):
        env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
        said = subprocess.run([sys.executable, "-c", script, *shared], env=env, capture_output=True, text=True, timeout=120).stdout
        assert "ROWS 3 True" in said and "LEFT False" in said


def test_callers_callees_and_reach(spark):
    found = elements(spark)
    names = {r.node_id: r.name for r in graph.of_kind(found, "method").collect()}
    edges = graph.edges(found)
    method = lambda n: graph.of_kind(found, "method").where(F.col("name") == n)
    assert {names[r.callee] for r in graph.callees(edges, method("a")).collect()} == {"b", "c"}
    assert {names[r.caller] for r in graph.callers(edges, method("c")).collect()} == {"a", "b"}
    pairs = graph.method_calls(edges).select(F.col("caller").alias("src"), F.col("callee").alias("dst"))
    seeds = method("b").select(F.col("node_id").alias("node"))
    assert {(names[r.node], r.depth) for r in graph.reach(pairs, seeds).collect()} == {("b", 0), ("c", 1), ("a", 2)}
    assert graph.reach(pairs, seeds, max_depth=1).count() == 2


CUT_SOURCES = {
    "A.java": "package p;\n/** Doc of\n *\n * A. */\nclass A {\n  /* open { \" '\n\n  /** not new } */\n  String t = \"\"\"\n  }{ /* not one\n \"\"\";\n  int f(int a) { // it's {\n    return g(\"}\", '\"');\n  }\n}\n\n",
    "b.py": "# first\n\n'''Module\n# not \"\"\" one\n\nend'''\nimport os\n\nclass B:\n    \"\"\"It's\n    def no(self):\n    \"\"\"\n\n    def f(self):\n        return '''x\ny''' + \"it's\"\n\n\ndef g():\n    return 1\n",
    "c.py": '"""Docs that never end\n\n  here',
    "d.sql": "select 1\n  from a;  \n\n\nselect ';'\n;\n  -- note;\nupdate b\nset c = 1;;\n\n select 2;",
    "e.jsp": "<html>\n\n\n<%@ page %>\r\n text\n  <script>\n\n \nx\n</script>\n<jsp:a/>",
    "f.sql": "\n\n \n",
    "g.java": "x" * 90,
}


@pytest.mark.parametrize("part_bytes", [7, 40])
def test_files_in_parts_give_what_whole_files_give(spark, tmp_path, part_bytes):
    base = str(tmp_path / "cut")
    for name, content in CUT_SOURCES.items():
        write(f"{base}/{name}", content.encode())
    write(f"{base}/bad.py", b"x = 1\ny = 2\n" * 9 + b"\xff\n" + b"z\n" * 30)
    whole, refused = tree.read_tree(spark, base, ["java", "py", "sql", "jsp"], project_root=base)
    cut, refused_too = tree.read_tree(spark, base, ["java", "py", "sql", "jsp"], project_root=base, part_bytes=part_bytes)
    large = {name for name, content in CUT_SOURCES.items() if len(content) > part_bytes}
    assert {r.file_path for r in cut.where("parts > 1").select("file_path").distinct().collect()} == large
    assert rows(refused) == rows(refused_too) == [("bad.py", "not valid UTF-8")]
    texts = {}
    for r in sorted(cut.collect(), key=lambda r: (r.file_path, r.part)):
        texts[r.file_path] = texts.get(r.file_path, "") + r.content
    assert texts == {name: content.replace("\r\n", "\n") for name, content in CUT_SOURCES.items()}
    for language in (None, "java", "python"):
        of = {"java": "file_path LIKE '%.java'", "python": "file_path LIKE '%.py'"}.get(language, "file_path != 'f.sql'")
        assert rows(lines.numbered_lines(cut.where(of), language)) == rows(lines.numbered_lines(whole.where(of), language))
    for block in (None,) if part_bytes == 7 else (4,):
        for chunked, of in ((sql_source.statements, "sql"), (sql_source.chunks, "sql"), (markup.chunks, "jsp")):
            of = f"file_path LIKE '%.{of}'"
            assert rows(chunked(cut.where(of), block=block)) == rows(chunked(whole.where(of))) != []
    assert rows(python_source.docstrings(cut.where("file_path LIKE '%.py'"))) == rows(python_source.docstrings(whole.where("file_path LIKE '%.py'"))) != []


def test_all_chunks_of_files_in_parts(spark, tmp_path):
    base = str(tmp_path / "cut")
    for name, content in CUT_SOURCES.items():
        write(f"{base}/{name}", content.encode())
    whole, cut = (tree.read_tree(spark, base, ["java", "py", "sql", "jsp"], project_root=base, part_bytes=b)[0] for b in (None, 11))
    assert rows(all_chunks.chunk_files(cut)[0]) == rows(all_chunks.chunk_files(whole)[0]) != []


def test_a_line_longer_than_parts_is_one_line(spark, tmp_path):
    write(str(tmp_path / "l" / "a.py"), b"a = '" + b"x" * 5000 + b"'\nb = 2\n\n" + b"y" * 3000)
    got, _ = tree.read_tree(spark, str(tmp_path / "l"), ["py"], part_bytes=100)
    assert [len(r.source) for r in lines.numbered_lines(got).orderBy("line_no").collect()] == [5006, 5, 0, 3000]
