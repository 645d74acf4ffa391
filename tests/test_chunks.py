import ast
import random
import re

import pytest
from pyspark.sql import functions as F

from lineloom.functions import text
from lineloom.operators import all_chunks, java, markup, merge, python_source, segment, sql_source
from lineloom.operators.lines import numbered_lines
from tests.conftest import files, plan, rows

LONG_PYTHON = (
    "def tally(rows):\n    seen = {}\n"
    + "".join(f"    seen[{i}] = rows.get({i}, 0) + {i % 7}\n" for i in range(120))
    + "\n" * 90
    + "    # what is left\n    for key in rows:\n        seen.setdefault(key, 1)\n    return seen\n"
)
LONG_JAVA = (
    "public class Ledger {\n    long total(long[] entries) {\n        long sum = 0;\n"
    + "".join(f"        sum += entries[{i}] * rate({i});\n" for i in range(190))
    + "        return sum;\n    }\n}\n"
)
SCRIPT = """
-- stock of a shop
CREATE VIEW stock AS
SELECT item, count(*) AS n
FROM deliveries
GROUP BY item;

-- two corrections
UPDATE deliveries SET n = 3 WHERE item = 'cup';
DELETE FROM deliveries WHERE n = 0;

-- what remains
SELECT item FROM stock;
"""
PYTHON = '''# lead
"""Doc
of "module"

"""
import os

@deco(
  1)
class A(B):
    """x"""
    y = [1,
2]
    def m(self,
          a=")"):
        """multi
    low indent
        """
        if a: # c
            return {
    1: 2}
        # trailing comment

    async def t(self):
        pass
    def s(self): return 1
    z = 1 + \\
2
def f():
    x = "def g():"
    def inner():
        return '#'
    return inner
# end
'''
JAVA = """package a.b;

import x.y;

/** Doc of A { */
@Service("}")
public class A<T extends Map<String, List<T>>> extends B {
    private int[] x = {1,2};
    /**
     * Doc of m
     */
    // not doc
    public static <T> List<T> m(int a,
        int b) throws E
    {
        for (int i = 0; i < 3; i++) { call("{", '{', '"'); }
        Runnable r = new Runnable() {
            public void run() { go(); }
        };
        if (a) { foo(); } else if (b) { return bar(x); }
    }
    public A(int z) { init(); }
    interface I { void abs(int q); int k() ; }
    /**
     * Doc of em
     */
    enum E { P, Q; void em() { } }
}
class Z { void one() { } }
"""


def judged(source):
    kinds = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)
    return sorted((n.name, n.lineno, n.end_lineno) for n in ast.walk(ast.parse(source)) if isinstance(n, kinds))


@pytest.mark.parametrize("block", [None, 4])
@pytest.mark.parametrize("source", [PYTHON, LONG_PYTHON])
def test_python_spans_are_those_of_the_parser(spark, source, block):
    lines = numbered_lines(files(spark, a__py=source), "python")
    got = python_source.declarations(lines, block).select("name", "span_start", "span_end")
    assert rows(got) == judged(source)


def test_python_types_and_docstring(spark):
    chunks = rows(all_chunks.python_chunks(files(spark, a__py=PYTHON)).select("type", "name", "start_line", "end_line"))
    assert ("docstring", None, 2, 5) in chunks
    assert ("unknown", "t", 24, 25) in chunks and ("class", "A", 10, 28) in chunks


@pytest.mark.parametrize(
    "source, found",
    [
        ('"""Doc"""\nx = 1\n', True), ("'d'; x = 1", True), ("# c\n\nr'''a\n\nb'''\n", True), ('"""  """\n', False),
        ('x = """Doc"""\n', False), ('"""Doc""".strip()\n', False), ("", False), ("# only\n", False),
    ],
)
def test_docstring_only_where_the_parser_has_one(spark, source, found):
    assert bool(ast.get_docstring(ast.parse(source))) is found
    assert (python_source.docstrings(files(spark, a__py=source)).count() == 1) is found


def test_long_python_function_is_split(spark):
    found = python_source.chunks(numbered_lines(files(spark, a__py=LONG_PYTHON), "python")).collect()
    assert len(found) > 1 and {r.name for r in found} == {"tally"}
    assert sorted(r.chunk_no for r in found) == list(range(1, len(found) + 1))


def test_long_java_method_is_split(spark):
    found = java.chunks(numbered_lines(files(spark, A__java=LONG_JAVA), "java")).collect()
    pieces = [r for r in found if r.type == "function"]
    assert len(pieces) > 1 and {r.name for r in pieces} == {"total"}
    assert max(r.end_line - r.start_line + 1 for r in found) <= 80


@pytest.mark.parametrize("block", [None, 4])
def test_java_spans(spark, block):
    lines = numbered_lines(files(spark, A__java=JAVA), "java")
    got = rows(java.declarations(lines, block).select("kind", "name", "span_start", "span_end", "doc_start", "doc_end"))
    assert got == sorted(
        [
            ("package", "a.b", 1, 29, None, None), ("class", "A", 6, 28, 5, 5), ("method", "m", 13, 21, None, None),
            ("method", "run", 18, 18, None, None), ("interface", "I", 23, 23, None, None),
            ("method", "abs", 23, 23, None, None), ("method", "k", 23, 23, None, None), ("enum", "E", 27, 27, 24, 26),
            ("method", "em", 27, 27, None, None), ("class", "Z", 29, 29, None, None), ("method", "one", 29, 29, None, None),
        ],
        key=repr,
    )


@pytest.mark.parametrize("block", [None, 4])
def test_java_context(spark, block):
    lines = numbered_lines(files(spark, A__java=JAVA), "java")
    got = {r.source.strip(): (r.parent_type, r.parent_method) for r in java.line_context(lines, block=block).collect()}
    assert got["import x.y;"] == (None, None)
    assert got["/** Doc of A { */"] == ("a.b.A", None)
    assert got["private int[] x = {1,2};"] == ("a.b.A", None)
    assert got["* Doc of m"] == ("a.b.A", None), "a line comment stands between"
    assert got["int b) throws E"] == ("a.b.A", "m")
    assert got["public void run() { go(); }"] == ("a.b.A", "run")
    assert got["public A(int z) { init(); }"] == ("a.b.A", None)
    assert got["* Doc of em"] == ("a.b.A.E", None)
    assert got["interface I { void abs(int q); int k() ; }"] == ("a.b.A.I", "k")
    assert got["class Z { void one() { } }"] == ("a.b.Z", "one")


def test_files_without_package_or_text(spark):
    two = files(spark, A__java="class A {\n}\n", B__java="")
    assert rows(java.line_context(numbered_lines(two, "java")).select("file_path", "line_no", "parent_type")) == [
        ("A.java", 1, "A"), ("A.java", 2, "A"),
    ]


def test_sql_statements_with_true_lines(spark):
    got = rows(sql_source.chunks(files(spark, a__sql=SCRIPT)).select("start_line", "end_line", "name", "chunk_no"))
    assert [(a, b) for a, b, *_ in got] == sorted([(2, 6), (8, 9), (10, 10), (12, 13)], key=repr)
    whole = sql_source.chunks(files(spark, a__sql=SCRIPT), split_statements=False).collect()
    assert len(whole) == 1 and whole[0].start_line == 2


@pytest.mark.parametrize("block", [None, 8])
def test_big_sql_script(spark, block):
    inserts = "".join(
        ("-- next\n\n" if i % 10 == 0 else "") + f"INSERT INTO t VALUES ({i});\n" for i in range(100)
    )
    union = " UNION ALL\n".join(f"SELECT {i}" for i in range(99)) + ";\n"
    script = "CREATE TABLE t (\n  id INT\n);\n\n" + inserts + union
    got = sql_source.chunks(files(spark, big__sql=script), block=block).collect()
    assert len(got) == 103 and any("part" in r.name for r in got)
    assert max(r.chunk_no for r in got) == 2
    lines = script.split("\n")
    for r in got:
        assert lines[r.start_line - 1].startswith(r.source.split("\n")[0])


def test_markup_boundaries(spark):
    page = files(spark, a__jsp="<p>\n\n\n\nx\n<% a\n <!-- b\n</p>")
    got = rows(markup.chunks(page, block=2).select("chunk_no", "start_line", "end_line", "source"))
    assert got == [(1, 1, 2, "<p>\n\n"), (2, 3, 3, "\n"), (3, 4, 5, "\nx\n"), (4, 6, 6, "<% a\n"), (5, 7, 8, " <!-- b\n</p>")]
    assert markup.chunks(page, tag_boundaries=False).count() == 3


def split_by_hand(lines, mark, limit):
    pieces, buffer = [], []
    for line in lines:
        buffer.append(line)
        if len(buffer) >= limit or not line.strip() or line.strip().startswith(mark):
            pieces.append(buffer)
            buffer = []
    return pieces + ([buffer] if buffer else [])


@pytest.mark.parametrize("block", [None, 3])
def test_pieces_match_the_buffer_walk_and_tile_the_span(spark, block):
    draw = random.Random(3)
    spans = {f"f{n}": [draw.choice(["", "  # c", "x", "y", "z = 1"]) for _ in range(draw.randint(1, 40))] for n in range(60)}
    data = [(f, len(ls), 1, i + 1, s) for f, ls in spans.items() for i, s in enumerate(ls)]
    df = spark.createDataFrame(data, "file_path string, n_lines int, span_start int, line_no int, source string")
    got = segment.segment_lines(df, ["file_path"], "#", limit=5, block=block)
    want = []
    for f, ls in spans.items():
        at = 1
        for n, piece in enumerate(split_by_hand(ls, "#", 5)):
            want.append((f, n + 1, at, at + len(piece) - 1, "\n".join(piece)))
            at += len(piece)
    assert rows(got.select("file_path", "chunk_no", "piece_start", "piece_end", "source")) == sorted(want, key=repr)


def merged_by_hand(chunks):
    kept = []
    for kind, source in chunks:
        if kind in ("empty", "trivial_comment"):
            continue
        if kept and kind in ("brace", "tiny"):
            kept[-1] = kept[-1].rstrip() + "\n" + source
        elif kind != "brace":
            kept.append(source)
    return kept


@pytest.mark.parametrize("block", [0, 3])
def test_merge_matches_the_walk(spark, block):
    draw = random.Random(9)
    texts = {"brace": "  }  ", "tiny": "a;\nb;  \n", "trivial_comment": "// c", "empty": "  ", "normal": "a;\nb;\nc;\n "}
    data, want = [], []
    for n in range(40):
        kinds = [draw.choice(list(texts)) for _ in range(draw.randint(1, 12))]
        data += [(f"f{n}", "class", "N", 1, i, i, texts[k], i, 0) for i, k in enumerate(kinds)]
        want += [(f"f{n}", s) for s in merged_by_hand([(k, texts[k]) for k in kinds])]
    df = spark.createDataFrame(
        data,
        "file_path string, type string, name string, chunk_no int, start_line int, end_line int, source string, span_start int, place int",
    )
    assert rows(merge.merge_small(df, block=block).select("file_path", "source")) == sorted(want, key=repr)


def test_one_huge_class_is_merged_by_many_tasks(spark):
    draw = random.Random(3)
    texts = {"brace": "}", "tiny": "a;\nb;  ", "normal": "a;\nb;\nc;\n ", "trivial_comment": "// c"}
    kinds = ["normal"] + [draw.choice(["tiny", "brace", "tiny", "trivial_comment"]) for _ in range(900)] + ["normal"] * 3
    sources = [texts[k].replace("a", f"a{i}") for i, k in enumerate(kinds)]
    # all pieces of one span, but for a span inside it that begins at its start, too
    data = [("f", "class", "N", i, 2 * i, 2 * i + 1, s, 1, int(i > 700)) for i, s in enumerate(sources)]
    df = spark.createDataFrame(
        data,
        "file_path string, type string, name string, chunk_no int, start_line int, end_line int, source string, span_start int, place int",
    ).repartition(4)
    got = merge.merge_small(df, block=8).orderBy("start_line").collect()
    assert [r.source for r in got] == merged_by_hand(list(zip(kinds, sources)))
    assert (got[0].start_line, got[0].chunk_no, got[1].start_line) == (0, 0, 2 * 901)
    assert got[0].end_line == 2 * max(i for i, k in enumerate(kinds[:901]) if k != "trivial_comment") + 1
    # texts are joined by block of lines first, and only then by merged chunk
    assert re.search(r"hashpartitioning\([^)]*merged_no[^)]*place[^)]*_groupingexpression", plan(merge.merge_small(df, block=8)))


@pytest.mark.parametrize(
    "source, expected",
    [
        ("", ("empty", 0)), (" \n\t", ("empty", 0)), (" };\n", ("brace", 1)), ("{;", ("brace", 1)), ("// a\n/* b", ("trivial_comment", 2)),
        ("// a\n// b\n// c", ("tiny", 0)), ("a;\n// b\nc;", ("tiny", 2)), ("/* a\n* b\n*/", ("normal", 3)), ("a\nb\n\nc", ("normal", 3)),
    ],
)
def test_content_class(spark, source, expected):
    df = spark.createDataFrame([(source,)], "s string").select(text.content_class(F.col("s")).alias("c")).select("c.*")
    assert tuple(df.first()) == expected


def test_all_languages_and_refusals(spark):
    mixed = files(spark, a__PY="def f():\n    pass\n", b__java=LONG_JAVA, c__tsql="SELECT 1;\n", d__JSP="<p>\n", e__txt="x")
    chunks, refused = all_chunks.chunk_files(mixed)
    assert {r.file_path for r in chunks.collect()} == {"a.PY", "b.java", "c.tsql", "d.JSP"}
    assert rows(refused) == [("e.txt", "nothing chunks files of type .txt")]


def test_line_ends_and_empty_texts(spark):
    got = numbered_lines(files(spark, a="a\r\nb\rc\n\n", b="", c="x"))
    assert rows(got.select("file_path", "line_no", "source")) == [
        ("a", 1, "a"), ("a", 2, "b"), ("a", 3, "c"), ("a", 4, ""), ("c", 1, "x"),
    ]
