"""Code-like inputs derived row by row from the given tables.

Every file's text comes from one table row by expressions alone, so building it
needs no shuffle and every input grows with its table. The oracle side builds the
same lines as rows, with the structure in columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.operators import graph, java, query
from lineloom.operators.lines import numbered_lines
from lineloom.session import spread, staged

USER_PREFIXES = ["app."]
HASH_DIM = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def java_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Java file per customer: a class, methods with comments, some long, an inner class
    with calls over two lines and ten levels, an annotation type."""
    head = """array(
        concat('package app.g', k % 25, ';'), '', concat('/** Customer ', k, '. */'),
        concat('public class C', k, ' {'))"""
    note = """if((k + j) % 2 = 0,
        array('    /**', concat('     * Step ', j, ' of } ', seg, '.'), '     */'), array())"""
    size = "if((k + j) % 40 = 0, 100, 1 + (k * 7 + j * 3) % 13)"
    line = """case
        when i % 30 = 0 then concat('        // note ', i)
        when i % 17 = 0 then ''
        when i % 11 = 5 then concat('        int v', i, ' = a;')
        when i % 9 = 4 then concat('        m', (j + 1) % nm, '(i);')
        else concat('        use(p', (k * i + j) % 97, ', "{");') end"""
    method = f"""concat({note},
        array(concat('    public int m', j, '(int a) {{')),
        transform(sequence(1L, {size}), i -> {line}),
        array('    }}'), if((k + j) % 3 = 0, array(''), array()))"""
    inner = """if(k % 4 = 0, array('    static class In {', '        void x() {',
        '            run();', '            send(first(1),',
        '                second("(", 2));', '            l0(l1(l2(l3(l4(l5(l6(l7(l8(l9(1))))))))));',
        '        }', '    }'), array())"""
    marks = """if(k % 4 = 1, array('@interface Mark {', '    String value() default "";',
        '    int size();', '}'), array())"""
    return (
        table(spark, sf_dir, "customer")
        .select(
            F.col("c_custkey").alias("k"),
            F.col("c_mktsegment").alias("seg"),
            F.expr("1 + c_custkey % 5").alias("nm"),
        )
        .select(
            F.concat(F.lit("src/C"), "k", F.lit(".java")).alias("file_path"),
            F.expr(
                f"""array_join(concat({head}, flatten(transform(sequence(0L, nm - 1), j -> {method})),
                {inner}, array('}}'), {marks}), '\n')"""
            ).alias("content"),
        )
    )


def service_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Java file per supplier: calls in a field, a static block and a constructor, an
    overload, calls into the next supplier's class, and locals outside methods."""
    lines = """array(concat('package svc.p', k % 10, ';'), concat('public class S', k, ' {'),
        concat('    private int start = seed(', k, ');'), '    static { boot(); }', concat('    S', k, '() {'),
        concat('        prepare(a(b(c(d(', k, ')))));'), '    }', '    void open(int a) {',
        concat('        new S', k + 1, '().serve(a);'), '    }', '    void open(long b) {', '        close();', '    }',
        '    void serve(int a) {', '        open(a);', concat('        only', k + 1, '();'), '    }',
        concat('    void only', k, '() {'), '    }', '    void close() {', '    }',
        concat('    S', k, '(int a) {'), '        int kept = a;', '        if (a > 0) { long more = a; }', '    }',
        '    static {', '        String once = "}";', '    }', '    int field = 1;',
        '    Runnable later = () -> { int inner = 1; };', '}')"""
    return (
        table(spark, sf_dir, "supplier")
        .select(F.col("s_suppkey").alias("k"))
        .select(F.concat(F.lit("svc/S"), "k", F.lit(".java")).alias("file_path"), F.expr(f"array_join({lines}, '\n')").alias("content"))
    )


def python_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python file per part: docstring, class, methods, nested and async functions."""
    head = """concat(
        if(k % 3 = 0, array(concat('# part ', k)), array(concat('\"\"\"Part ', k), concat(kind, ' notes.'), '\"\"\"')),
        array('', 'import os', '', concat('class P', k, ':')))"""
    size = "if((k + j) % 30 = 0, 120, 1 + (k * 5 + j) % 9)"
    line = """case
        when i % 20 = 0 then concat('        # step ', i)
        when i % 13 = 0 then ''
        else concat('        x = \"def {', i, '}:\"') end"""
    method = f"""concat(
        if((k + j) % 3 = 0, array('    @staticmethod'), array()),
        if(j % 2 = 0, array(concat('    def m', j, '(self,'), concat('        a=', j, '):')),
                      array(concat('    def m', j, '(self):'))),
        transform(sequence(1L, {size}), i -> {line}),
        if((k + j) % 5 = 0, array('        def inner():', concat('            return ', j)), array()),
        array('        return x', ''))"""
    tail = """array('async def tail():', '    \"\"\"Doc', 'of tail\"\"\"', '    await go()')"""
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").alias("k"), F.col("p_type").alias("kind"))
        .select(
            F.concat(F.lit("lib/p"), "k", F.lit(".py")).alias("file_path"),
            F.expr(
                f"""array_join(concat({head},
                flatten(transform(sequence(0L, k % 4), j -> {method})), {tail}), '\n')"""
            ).alias("content"),
        )
    )


def sql_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL script per customer: short statements, for some a long one, an open end."""
    one = """concat('-- customer ', k, '\nUPDATE t', j, '\n  SET v = ', k * j, '\nWHERE id = ', k, ';',
        if(j % 2 = 0, '  \n\n', '\n'))"""
    big = """if(k % 50 = 0, concat(array_join(transform(sequence(1L, 99L), i ->
        if(i % 25 = 0, concat('-- row ', i), concat('SELECT ', i, ' UNION ALL'))), '\n'), ';\n'), '')"""
    return (
        table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("k"))
        .select(
            F.concat(F.lit("db/s"), "k", F.lit(".sql")).alias("file_path"),
            F.expr(
                f"""concat('\n', array_join(transform(sequence(0L, k % 4), j -> {one}), ''), {big},
                if(k % 2 = 1, 'SELECT 1', ''))"""
            ).alias("content"),
        )
    )


def markup_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages with a line end between tags."""
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("web/"), "page_id", F.lit(".jsp")).alias("file_path"),
        F.regexp_replace("html", "><", ">\n<").alias("content"),
    )


def talk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per conversation turn: the role as a comment line, the text, a blank line."""
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("talk/"), "conv_id", F.lit("/"), "turn").alias("file_path"),
        F.concat(F.lit("# "), "role", F.lit("\n"), "text", F.lit("\n\n")).alias("content"),
    )


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path per document under plain, hidden and excluded directories."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr(
            """concat('/repo/', case when doc_id % 7 = 0 then '.git/' when doc_id % 5 = 0 then 'Venv/' else 'src/' end,
            source, '/', case when doc_id % 11 = 0 then '.' else '' end, doc_id,
            case lang when 'en' then '.py' when 'fr' then '.java' when 'de' then '.sql' when 'es' then '.JSP' else '.txt' end)"""
        ).alias("file_path"),
    )


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trace per order: a library frame, a frame in a Java input file, a library frame.

    Every 10th order has no user frame, every 25th names an unknown method, every
    33rd has no frames.
    """
    frames = """concat('java.lang.IllegalStateException: order ', o, '\n\tat java.util.List.forEach(List.java:',
        10 + o % 90, ')\n\tat ', if(o % 10 = 0, 'ext', 'app'), '.g', k % 25, '.C', k, '.',
        if(o % 25 = 0, 'zz', 'm0'), '(C', k, '.java:', line, ')\n\tat org.lib.Run.go(Run.java:7)\n')"""
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("o"), F.col("o_custkey").alias("k"))
        .withColumn(
            "line",
            F.expr("5 + if(k % 2 = 0, 3, 0) + 1 + o % if(k % 40 = 0, 100, 1 + (k * 7) % 13)"),
        )
        .select(
            F.col("o").alias("trace_id"),
            F.expr(f"if(o % 33 = 0, concat('Exception in order ', o), {frames})").alias("trace"),
        )
    )


# Indexes of this session: built once, then queried, as an index is.
_INDEXES: dict[tuple, DataFrame] = {}


def kept(name: str, spark: SparkSession, sf_dir: str, build: Callable[..., DataFrame], rows_of: str | None = None) -> DataFrame:
    """The index of that name; with ``rows_of``, the table whose rows are the files, in buckets of
    ``file_path``, whose number ``build`` is given."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _INDEXES:
        if rows_of is None:
            _INDEXES[key] = staged(build())
        else:
            n = buckets(spark, sf_dir, rows_of)
            _INDEXES[key] = staged(build(n), "file_path", n)
    return _INDEXES[key]


def forget() -> None:
    """Drop the indexes, so that the next query builds what it needs."""
    _INDEXES.clear()


# Files, of some 50 lines each, in a bucket of a table that lies by file.
FILES_A_BUCKET = 4_096


def buckets(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Buckets for the files that the rows of a table give: as many as cores, at least."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet").count()
    return max(spark.sparkContext.defaultParallelism, -(-rows // FILES_A_BUCKET))


def dealt(files: DataFrame, n: int) -> DataFrame:
    """Files in their buckets, in order there, so that later sorts of their lines find them sorted."""
    return files.repartition(n, "file_path").sortWithinPartitions("file_path")


def java_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the Java inputs, in buckets of files."""
    return kept("java_lines", spark, sf_dir, lambda n: numbered_lines(dealt(java_files(spark, sf_dir), n), "java"), "customer")


def python_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept("python_lines", spark, sf_dir, lambda: numbered_lines(python_files(spark, sf_dir), "python"))


def line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ``lines`` table of the Java inputs. Ids are hashes of the stored columns, worked
    out where they are read."""
    return query.stored_lines(
        kept("line_table", spark, sf_dir, lambda n: java.line_context(java_lines(spark, sf_dir)), "customer")
    )


def elements_of(lines: DataFrame, n: int) -> DataFrame:
    def by_file(df: DataFrame) -> DataFrame:
        return staged(df, "file_path", n)

    return graph.build(lines, by_file(java.declarations(lines)), keep=by_file)


def graph_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(n: int) -> DataFrame:
        return elements_of(java_lines(spark, sf_dir), n)

    return kept("graph_elements", spark, sf_dir, build, "customer")


def service_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(n: int) -> DataFrame:
        lines = staged(numbered_lines(dealt(service_files(spark, sf_dir), n), "java"), "file_path", n)
        return elements_of(lines, n)

    return kept("service_elements", spark, sf_dir, build, "supplier")
