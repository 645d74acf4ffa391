"""Work that stays with the files it lies by."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineloom.operators import all_chunks, graph, java, merge, python_source, query
from lineloom.operators.lines import numbered_lines
from lineloom.session import staged, staged_by
from lineloom.sources import stores

ODD = """package a.b;
/** Outer. */
class A { int f; class B {
  /** m. */
  void m() { if (x) { run(); } } void n(int a) { go(1,
    2); }
} interface C { void q(); } }
class D { D() { int kept = 1; }
  Runnable r = () -> { int inner = seed(3); };
"""


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def by_file(spark):
    files = spark.createDataFrame([(f"f{i}", ODD * (i % 3) + "// " + str(i)) for i in range(12)], ["file_path", "content"])
    return staged(numbered_lines(files.repartition(4, "file_path"), "java"), "file_path", 4)


def rows(df):
    return sorted(map(repr, df.collect()))


def test_line_context_moves_no_line(spark):
    lines = by_file(spark)
    found = java.line_context(lines)
    assert exchanges(found) == 0
    assert rows(found) == rows(java.line_context(lines, block=4).select(*found.columns))


def test_chunks_move_no_line(spark):
    lines = by_file(spark)
    found = java.chunks(lines, limit=2)
    assert exchanges(found) == 0
    assert rows(found) == rows(java.chunks(lines, limit=2, block=4)) != []
    files = spark.createDataFrame([("short", ODD), ("long", ODD * 150)], ["file_path", "content"])
    mixed = staged(numbered_lines(files, "java"))
    assert rows(java.chunks(mixed)) == rows(java.chunks(mixed, block=64))


PYTHON = """'''Doc {i}'''
class A:
    def m(self):
        # step

        return {i}

    async def n(self):
        pass
"""


def test_chunks_of_files_move_a_text_once(spark, monkeypatch):
    moved = []
    monkeypatch.setattr(all_chunks, "staged", lambda df, *rest: moved.append(exchanges(df)) or staged(df, *rest))
    texts = [(f"f{i}.java", ODD * (i % 3)) for i in range(12)] + [(f"p{i}.py", PYTHON.format(i=i) * (i % 3)) for i in range(12)]
    # rows that come twice, too
    files = spark.createDataFrame([*texts, *texts[:3], *texts[-3:]], ["file_path", "content"])
    java_files, python_files = files.where("file_path LIKE '%.java'"), files.where("file_path LIKE '%.py'")
    found = all_chunks.java_chunks(java_files), all_chunks.python_chunks(python_files)
    assert moved == [1, 1] and [exchanges(f) for f in found] == [0, 0]
    lines = staged(numbered_lines(java_files, "java")), staged(numbered_lines(python_files, "python"))
    merged = merge.merge_small(java.chunks(lines[0], block=4), block=4).select(*found[0].columns)
    assert rows(found[0]) == rows(merged) != []
    cut = python_source.docstrings(python_files).unionByName(python_source.chunks(lines[1], block=4))
    assert rows(found[1]) == rows(cut) != []


def test_a_long_file_moves_no_chunk_of_short_ones(spark, monkeypatch):
    files = spark.createDataFrame([("short", ODD), ("long", ODD * 150)], ["file_path", "content"])
    real, merged = merge.merge_small, []
    monkeypatch.setattr(merge, "merge_small", lambda df, **how: merged.append(real(df, **how)) or merged[-1])
    found = all_chunks.java_chunks(files)
    assert len(merged) == 2 and exchanges(merged[0]) == 0
    lines = staged(numbered_lines(files, "java"))
    assert rows(found) == rows(real(java.chunks(lines, block=64), block=64).select(*found.columns))


def test_a_long_file_leaves_short_ones_in_place(spark):
    files = spark.createDataFrame([("short", ODD), ("long", ODD * 150)], ["file_path", "content"])
    lines = staged(numbered_lines(files, "java"))
    found = java.line_context(lines)
    assert rows(found) == rows(java.line_context(lines, block=64).select(*found.columns))


def test_chains_broadcast_no_ways(spark, monkeypatch):
    plans = []
    for name, real in (("staged", staged), ("staged_by", staged_by)):
        monkeypatch.setattr(graph, name, lambda df, *rest, real=real: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, *rest))
    node = F.struct(F.lit("f").alias("file"), F.col("id").alias("line"))
    before = F.struct(F.lit("f").alias("file"), (F.col("id") - 1).alias("line"))
    links = spark.range(1, 100).select(node.alias("node"), before.alias("next"))
    found = graph.chains(links, spark.range(90, 100, 3).select(node.alias("node")))
    assert sorted((r.seed.line, r.step, r.node.line) for r in found.collect()) == [
        (s, i, s - i) for s in (90, 93, 96, 99) for i in range(s + 1)
    ]
    assert sum("Broadcast" in p for p in plans) == 0


def test_graph_moves_no_line(spark, monkeypatch):
    lines = by_file(spark)
    spans = staged(java.declarations(lines), "file_path", 4)
    moved = []

    def seen(df, *rest):
        moved.append(exchanges(df))
        return staged(df, *rest)

    monkeypatch.setattr(graph, "staged", seen)
    built = graph.build(lines, spans, keep=lambda df: seen(df, "file_path", 4))
    # only the starts that elements outside methods share come together
    assert moved == [0, 0] and exchanges(built) == 1
    assert rows(built) == rows(graph.build(lines, spans, block=4).select(*built.columns))


def test_loads_move_a_line_once(spark):
    kept = query.stored_lines(staged(java.line_context(by_file(spark)), "file_path", 4))
    stored = kept.where("file_line_no % 2 = 0").unionByName(kept.where("file_line_no = 2"))
    twice = kept.where("file_path <> 'f1'").unionByName(kept.where("file_line_no < 5"))
    loaded = stores.new_lines(stored, twice, within="file_path")
    report = stores.load_report(stored, twice, within="file_path")
    assert exchanges(loaded) <= 1 and exchanges(report) <= 1
    assert rows(loaded) == rows(stores.new_lines(stored, twice)) != []
    assert rows(report) == rows(stores.load_report(stored, twice))


def test_edges_move_names_only(spark, monkeypatch):
    text = "package {p};\nclass {c} {{\n  {c}() {{ a(); }}\n  void a() {{ b(1); B.far(); gone(); near(2); }}\n  void b(int x) {{ new D(); A.b(); a(a()); }}\n  {more}\n}}\n"
    many = [("f|A", "p", "A", "void far() {}"), ("fB", "p", "B", "void far() {} void near(int y) {}"), ("fC", "q", "C", "void near(int y) {}"), ("fD", "r", "D", "")]
    files = spark.createDataFrame([(f, text.format(p=p, c=c, more=more)) for f, p, c, more in many], ["file_path", "content"])
    lines = staged(numbered_lines(files.repartition(4, "file_path"), "java"), "file_path", 4)
    elements = staged(graph.build(lines, java_spans(lines)).repartition(4, "file_path"), "file_path", 4)
    moved = []
    monkeypatch.setattr(graph, "staged", lambda df, *rest: moved.append(df._jdf.queryExecution().executedPlan().toString()) or staged(df, *rest))
    found = graph.edges(elements)
    # what is found beyond a file is sent to where the elements lie
    assert "Exchange hashpartitioning" not in moved[-1] and exchanges(found.where("kind <> 'TARGET'")) == 0
    few = rows(found)
    monkeypatch.setattr(graph, "FEW", 0)
    assert rows(graph.edges(elements)) == few

    # by the rules, one by one
    nodes = elements.collect()
    known = lambda e: e.parent_id.split("|")[-1] if e.name == "<init>" else e.name
    methods = [(e.node_id, e.parent_id.split("|")[-1], e.file_path, e.package or "", known(e)) for e in nodes if e.kind == "method"]
    pairs = set()
    for e in nodes:
        if e.kind != "call":
            continue
        same = [m for m in methods if m[4] == e.name]
        for scope in ([m for m in same if e.receiver and m[1] == e.receiver], [m for m in same if m[2] == e.file_path], [m for m in same if m[3] == (e.package or "")], same):
            if scope:
                pairs |= {(e.parent_id, e.node_id, m[0]) for m in scope}
                break
    assert pairs and {tuple(r) for r in graph.method_calls(found).collect()} == pairs
    assert {c.split("|")[-1] for _, c, _ in pairs} == {"a", "b", "far", "near", "D"}

    told = {n: c.alias(n) for n, c in graph.place_of(F.col("node_id")).items()}
    read = elements.select(*told.values())
    assert rows(read) == rows(elements.select("file_path", "line_number", "name"))
    assert {r.kind for r in elements.where(graph.is_method(F.col("node_id"))).collect()} == {"method"}


def java_spans(lines):
    return staged(java.declarations(lines))


def test_texts_are_cut_once_and_parents_told_once_a_piece(spark):
    content = F.concat(F.lit("class A"), "id", F.lit(" {\n  void m() {\n  }\n}\n"))
    files = spark.range(3).select(F.concat(F.lit("A"), "id").alias("file_path"), content.alias("content"))
    lines = numbered_lines(files, "java")
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == 1
    found = java.line_context(staged_by(lines, "file_path", 2))
    above_join = found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "parent_type" in found.columns and "array_join" not in above_join
    got = {(r.file_path, r.line_no, r.parent_type, r.parent_method) for r in found.collect()}
    assert got == {(f"A{i}", n, f"A{i}", "m" if n in (2, 3) else None) for i in range(3) for n in range(1, 5)}
