from pyspark.sql import functions as F

from lineloom.operators import trace
from lineloom.session import staged
from tests.conftest import plan, rows

TRACE = """
        shop.stock.MissingItemException: no cup left
            at shop.stock.Shelf.take(Shelf.java:57)
            at jdk.base/java.util.ArrayList.forEach(Native Method)
            at net.web.Chain$Link.pass(Chain.java:104)
            at shop.stock.Cart.<init>(Cart.java:9)
            at shop.stock.Cart.lambda$fill$2(Cart.java:12)
            at net.web.Loop.turn(Loop.java:8)
"""


def traces(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "trace_id int, trace string")


def test_parse_trace(spark):
    got = [tuple(r) for r in trace.frames(traces(spark, TRACE), ["shop."]).orderBy("frame_no").collect()]
    assert got == [
        (0, 1, "shop.stock.Shelf", "take", "Shelf.java", 57, True),
        (0, 2, "net.web.Chain$Link", "pass", "Chain.java", 104, False),
        (0, 3, "net.web.Loop", "turn", "Loop.java", 8, False),
    ]


def test_root_frame(spark):
    user = " at lib.Foo.a(Foo.java:1)\n at my.Svc.go(Svc.java:42)\n at lib.Bar.b(Bar.java:10)"
    none = " at lib.Foo.a(Foo.java:1)\n at lib.Bar.b(Bar.java:10)"
    got = trace.with_root(traces(spark, user, none, "no frames"), ["my."]).select("trace_id", "root.class", "root.line")
    assert rows(got) == [(0, "my.Svc", 42), (1, "lib.Foo", 1), (2, None, None)]


def stored(spark):
    data = [("A.java", "p.A.In", "m", n, f"line {n}") for n in range(1, 60)]
    data += [("A.java", "p.A.In", "k", n, f"other {n}") for n in range(60, 70)]
    return spark.createDataFrame(data, "file_path string, parent_type string, parent_method string, file_line_no int, source string")


def test_explain(spark):
    text = "X\n at p.A$In.m(A.java:7)\n"
    three = traces(spark, text, text, "none", " at q.B.m(B.java:7)")
    got = {r.trace_id: r for r in trace.explain(three, stored(spark), ["p."], 3).collect()}
    assert [got[i].status for i in range(4)] == ["ok", "ok", "no_frames", "no_context"]
    assert got[2].prompt is None and got[3].prompt is None
    assert "   4: line 4\n   5: line 5" in got[0].prompt and "  10: line 10\n\n---" in got[0].prompt
    assert "line 3\n" not in got[0].prompt and "line 11" not in got[0].prompt
    assert got[0].prompt.startswith("You're a senior") and got[0].prompt.endswith("do next?")


def test_context_stays_in_the_method_and_can_keep_dollars(spark):
    lookups = spark.createDataFrame([("p.A$In", "m", 58)], "class string, method string, line int")
    found = trace.method_context(lookups, stored(spark), 5).select(F.explode("context.lines.line_no")).collect()
    assert [r[0] for r in found] == [53, 54, 55, 56, 57, 58, 59]
    assert trace.method_context(lookups, stored(spark), 5, nested_dots=False).count() == 0


def test_context_join_is_an_equi_join(spark):
    lookups = spark.createDataFrame([("p.A.In", "m", 58)], "class string, method string, line int")
    text = plan(trace.method_context(lookups, stored(spark)))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_a_method_that_many_files_declare(spark):
    data = [(f"F{i:03}.java", "p.A", "m", n, f"line {n}" if i % 3 else f"own {i % 5}") for i in range(300) for n in (4, 5, 30)]
    schema = "file_path string, parent_type string, parent_method string, file_line_no int, source string"
    lines = spark.createDataFrame(data, schema).repartition(4)
    lookups = spark.createDataFrame([("p.A", "m", 5), ("p.A", "m", 5), ("p.A", "m", 40)], "class string, method string, line int")
    found = trace.method_context(lookups, lines, 3)
    around = sorted((n, s, f) for f, _, _, n, s in data if 2 <= n <= 8)
    (one,) = found.collect()
    assert one.context.file_path == around[0][2]
    assert [(r.line_no, r.source) for r in one.context.lines] == [(n, s) for n, s, _ in around]
    # equal lines are counted in tasks of their own before they meet in one context
    assert "partial_count" in plan(found) and plan(found).count("hashpartitioning(class") >= 2


def test_lines_and_traces_move_once(spark):
    data = [(f"f{i}", f"p.C{i}", "m", n, f"{i} line {n}") for i in range(20) for n in range(1, 400)]
    data += [(f"g{i}", "p.Twice", "m", n, f"{i} line {n}") for i in range(3) for n in range(9)]
    schema = "file_path string, parent_type string, parent_method string, file_line_no int, source string"
    lines = spark.createDataFrame(data, schema)
    lines = staged(lines.repartition(4, "file_path"), "file_path", 4)
    frames = [f" at p.C{i % 25}.m(C.java:{i % 450})" for i in range(900)] + [f" at p.Twice.m(T.java:{i})" for i in range(30)]
    rooted = trace.with_root(traces(spark, *frames, "none", " at p.C1.k(C.java:5)"), ["p."])
    contexts = trace.method_context(rooted.select("root.class", "root.method", "root.line"), lines)
    key = ["class", "method", "line"]
    before = rooted.select("trace_id", "root.*").join(contexts, key, "left").select("trace_id", "context")
    found = trace.with_context(rooted, lines)
    assert rows(found.select("trace_id", "context")) == rows(before)
    once = trace.with_context(rooted, lines.where("parent_type <> 'p.Twice'"))
    assert plan(once).count("Exchange ") == 2
