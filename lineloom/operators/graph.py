"""The code graph as node and edge tables, and questions over it.

Nodes: ``file``, ``typeDecl``, ``method``, ``call``, ``local``. Calls and locals outside methods, in
constructors, field initialisers and static blocks, belong to a method ``<init>`` of their
type. Edges: ``AST`` from an element to the elements directly inside it; ``CALL`` from a call
to a symbol; ``TARGET`` from a symbol to every method it may stand for. A symbol is a name in
the narrowest scope that declares it: the receiver's type if the text names one, the file,
the package, all files. So a name that is everywhere costs an edge per call and an edge per
method, and never their product.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineloom.functions import text
from lineloom.operators.spans import match_closes
from lineloom.plans.ranges import join_covering, join_innermost
from lineloom.plans.scan import by_length, with_running
from lineloom.session import staged, staged_by

# Words that look like calls and are not.
NOT_CALLS = ("if", "for", "while", "switch", "catch", "synchronized", "return", "try", "super", "this", "new", "assert")

Keep = Callable[[DataFrame], DataFrame]

# Links in a bucket of a table that lies by node.
LINKS_A_BUCKET = 250_000

# Names that calls look for beyond their file, at most, where every task gets them all.
FEW = 50_000

# Text up to each parenthesis, and the name of a call that one opens.
_PAREN = r"[^()]*[()]"
_OPENS = r"(?<![\w$@])([A-Za-z_$][\w$]*)\s*\($"
# What stands before a call: ``new``, an annotation, or a type as its receiver.
_NEW = r"\bnew\s+(?:[\w$]+\s*\.\s*)*$"
_ANNOTATION = r"@[\w$.]*$"
_RECEIVER = r"\b([A-Z][\w$]*)\s*(?:\([^()]*\)\s*)?\.\s*$"
_STATEMENT = r"[^{};]*[{};]|[^{};]+"
_LOCAL = (
    r"^\s*(?:final\s+)?(?!(?:return|throw|new|else|case|package|import|goto|assert|yield)\b)"
    r"[A-Za-z_$][\w.$]*(?:<[^=;()]*>)?(?:\[\])*\s+([A-Za-z_$][\w$]*)(?=\s*(?:=[^=]|;))"
)


def node_id(kind: str, *parts: str) -> Column:
    return F.concat_ws("|", F.lit(kind), *[F.col(p).cast("string") for p in parts])


def _calls(lines: DataFrame, block: int, short: bool, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """Every name before a parenthesis, with the text from it to the matching parenthesis:
    ``file_path, line_no, item`` and ``kind, name, code, receiver, fresh, level``.

    Parentheses are counted along the file's blanked code, through all lines and at any
    depth. A parenthesis that is never closed ends with its line. Calls of one line and of
    several come apart: a join would not see that a union of both lies by file.
    """
    pieces = F.regexp_extract_all("code", F.lit(_PAREN), F.lit(0))
    ends = F.aggregate(
        "pieces",
        F.array().cast("array<int>"),
        lambda acc, p: F.array_append(acc, F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + F.length(p)),
    )

    def event(p: Column, i: Column) -> Column:
        called = F.regexp_extract(p, _OPENS, 0)
        # what stands before the name, from two parentheses before it on
        near = [F.coalesce(F.get("pieces", i - k), F.lit("")) for k in (2, 1)]
        before = F.concat(*near, F.substr(p, F.lit(1), F.length(p) - F.length(called)))
        end, name = F.get("ends", i), F.regexp_extract(p, _OPENS, 1)
        is_call = (called != "") & ~name.isin(*NOT_CALLS) & ~before.rlike(_ANNOTATION)
        call = F.struct(
            name.alias("name"),
            (end - F.length(called) + 1).alias("begin"),
            F.regexp_extract(before, _RECEIVER, 1).alias("receiver"),
            before.rlike(_NEW).alias("fresh"),
            F.col("source").alias("text"),
        )
        return F.struct(p.endswith("(").alias("opens"), end.alias("end"), F.when(is_call, call).alias("call"))

    events = (
        lines.where(F.col("code").contains("(") | F.col("code").contains(")"))
        .select("file_path", "n_lines", "line_no", "source", pieces.alias("pieces"))
        .withColumn("ends", ends)
        .select("file_path", "n_lines", "line_no", F.posexplode(F.transform("pieces", event)).alias("place", "e"))
        .select("file_path", "n_lines", "line_no", "place", "e.*")
    )
    step = F.when(F.col("opens"), 1).otherwise(-1)
    events = with_running(
        events, ["file_path"], ["line_no", "place"], sums={"depth": step}, block=block, spans_blocks=F.col("n_lines") >= block
    )
    opened = F.when(F.col("call").isNotNull(), F.struct("line_no", "place", "call.*"))
    closed = F.when(~F.col("opens"), F.struct(F.col("line_no").alias("line"), "end"))
    events = events.select(
        "file_path",
        "n_lines",
        F.when(F.col("opens"), F.col("depth")).otherwise(F.col("depth") - 1).alias("level"),
        "line_no",
        "place",
        opened.alias("opened"),
        closed.alias("closed_at"),
    ).where(F.col("opened").isNotNull() | F.col("closed_at").isNotNull())
    calls = keep(match_closes(events, block).withColumn("last_line", F.coalesce("close.line", "line_no")).drop("n_lines"))

    def part(at: Column, source: str) -> Column:
        first = F.when(at == F.col("line_no"), F.col("begin")).otherwise(F.lit(1))
        last = F.when(at == F.col("last_line"), F.col("close.end"))
        return F.substr(F.col(source), first, F.coalesce(last, F.length(source)) - first + 1)

    texts = lines.select("file_path", F.col("line_no").alias("at"), "source")
    own = ["file_path", "line_no", "place", "name", "receiver", "fresh"]
    # The line that a call begins on came with it.
    alone = calls.where(F.col("last_line") == F.col("line_no")).select(*own, part(F.col("line_no"), "text").alias("code"))
    # A call over several lines is one text, as long as the call.
    over = calls.where(F.col("last_line") > F.col("line_no")).drop("text")
    if short:
        of_call = texts.withColumnRenamed("file_path", "_file").hint("merge")
        met = over.join(of_call, (F.col("file_path") == F.col("_file")) & F.col("at").between(F.col("line_no"), F.col("last_line")))
    else:
        met = over.withColumn("at", F.explode(F.sequence("line_no", "last_line"))).join(texts, ["file_path", "at"])
    whole = met.groupBy(*own).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", part(F.col("at"), "source").alias("t")))), lambda p: p["t"]), "\n").alias("code")
    )
    item = F.struct(F.lit("call").alias("kind"), "name", "code", "receiver", "fresh", F.lit(0).cast("bigint").alias("level"))
    return tuple(part.select("file_path", "line_no", F.col("place").alias("item"), item.alias("e")) for part in (alone, whole))


def _locals(lines: DataFrame, block: int) -> DataFrame:
    """What looks like the declaration of a variable, as rows like those of ``_calls``; ``level``
    is the depth of braces around it."""
    pieces = F.regexp_extract_all("code", F.lit(_STATEMENT), F.lit(0))
    step = F.when(F.col("piece").endswith("{"), 1).when(F.col("piece").endswith("}"), -1).otherwise(0)
    found = (
        lines.select("file_path", "n_lines", "line_no", "source", F.posexplode(pieces).alias("item", "piece"))
        .withColumns({"name": F.regexp_extract("piece", _LOCAL, 1), "step": step})
        .where((F.col("name") != "") | (F.col("step") != 0))
        .select("file_path", "n_lines", "line_no", "item", "name", "step", F.when(F.col("name") != "", text.strip(F.col("source"))).alias("code"))
    )
    found = with_running(
        found, ["file_path"], ["line_no", "item"], sums={"level": F.col("step")}, block=block, spans_blocks=F.col("n_lines") >= block
    )
    return found.where(F.col("name") != "").select(
        "file_path",
        "line_no",
        "item",
        F.struct(F.lit("local").alias("kind"), "name", "code", F.lit("").alias("receiver"), F.lit(False).alias("fresh"), F.col("level").cast("bigint").alias("level")).alias("e"),
    )


def build(lines: DataFrame, spans: DataFrame, block: int | None = None, keep: Keep = staged) -> DataFrame:
    """Elements of the code with the element around each: one row per node.

    ``node_id, kind, name, code, file_path, line_number, line_end, parent_id``, and of
    calls the ``receiver`` type, of all the ``package``; locals are those inside methods,
    constructors and initialisers. ``lines`` carries ``code``; ``spans`` are the
    declarations of the same lines. What lies by file stays there, as far as files are short;
    ``keep`` stages a table like ``lines``, by file where these lie so.
    """
    return by_length(lines, spans, block, lambda *of: _build(*of, keep))


def _build(lines: DataFrame, spans: DataFrame, block: int, short: bool, keep: Keep) -> DataFrame:
    packages = spans.where(F.col("kind") == "package").groupBy("file_path").agg(F.min_by("name", "span_start").alias("package")).hint("merge")
    declared = spans.where(F.col("kind") != "package").select(
        "file_path",
        F.when(F.col("kind") == "method", "method").otherwise("typeDecl").alias("kind"),
        "name",
        "span_start",
        "place",
        "span_end",
        "end_place",
        "level",
    ).withColumn(
        "node_id",
        F.concat_ws("|", "kind", "file_path", F.col("span_start").cast("string"), F.col("place").cast("string"), "name"),
    ).join(packages, "file_path", "left")
    around = declared.select(
        "file_path",
        F.col("span_start").alias("a_start"),
        F.col("span_end").alias("a_end"),
        F.struct(
            F.col("span_start").alias("s"),
            F.col("place").alias("p"),
            F.col("node_id").alias("id"),
            F.col("kind").alias("k"),
            F.col("name").alias("n"),
            F.col("level").alias("l"),
            "package",
        ).alias("a"),
    )
    file_id = node_id("file", "file_path")

    # Declarations, each with the latest declaration that begins before it and reaches it.
    width = {"width": None} if short else {}
    nested = join_covering(declared, around, ["file_path"], "span_start", "a_start", "a_end", how="left", **width)
    earlier = (F.col("a.s") < F.col("span_start")) | ((F.col("a.s") == F.col("span_start")) & (F.col("a.p") < F.col("place")))
    declarations = nested.groupBy("_at", *declared.columns).agg(
        F.max(F.when(earlier, F.col("a")))["id"].alias("outer_id")
    ).select(
        "node_id",
        "kind",
        "name",
        F.col("name").alias("code"),
        "file_path",
        F.col("span_start").alias("line_number"),
        F.col("span_end").alias("line_end"),
        F.coalesce("outer_id", file_id).alias("parent_id"),
        "package",
    )

    # Calls and locals, each with the innermost declaration around their line.
    found = (*_calls(lines, block, short, keep), _locals(lines, block))
    if short:

        def told(on: Column) -> dict[str, Column]:
            return {"a": F.array_max(F.transform(on, lambda r: F.struct(*[r["a"][n].alias(n) for n in ("s", "p", "id", "k", "n", "l", "package")], r["a_end"].alias("a_end"))))}

        met = [join_innermost(f, around, "file_path", "line_no", "a_start", "a_end", told) for f in found]
        placed = met[0].unionByName(met[1]).unionByName(met[2])
    else:
        items = found[0].unionByName(found[1]).unionByName(found[2])
        met = join_covering(items, around, ["file_path"], "line_no", "a_start", "a_end")
        placed = met.groupBy("file_path", "_at", "line_no", "item", "e").agg(F.max(F.struct("a.*", "a_end")).alias("a"))
    outside = F.col("a.k") != "method"
    call = F.col("e.kind") == "call"
    # The header of a method, and of a constructor, is no call.
    header = F.when(outside, (F.col("e.name") == F.col("a.n")) & ~F.col("e.fresh")).otherwise(
        (F.col("a.s") == F.col("line_no")) & (F.col("e.name") == F.col("a.n"))
    )
    init_id = F.concat_ws("|", F.lit("init"), "file_path", F.col("a.s").cast("string"), F.col("a.p").cast("string"), F.col("a.n"))
    # Written once: read as elements, and for the starts that elements outside methods need.
    inner = staged(
        # In a type's own body a declaration is a field; deeper, it is a constructor's or initialiser's.
        placed.where((call & ~header) | (~call & (~outside | (F.col("e.level") > F.col("a.l") + 1))))
    )
    elements = inner.select(
        F.concat_ws("|", F.col("e.kind"), "file_path", F.col("line_no").cast("string"), F.col("item").cast("string"), F.col("e.name")).alias("node_id"),
        "e.kind",
        "e.name",
        "e.code",
        "file_path",
        F.col("line_no").alias("line_number"),
        F.col("line_no").alias("line_end"),
        F.when(outside, init_id).otherwise(F.col("a.id")).alias("parent_id"),
        "e.receiver",
        "a.package",
    )
    starts = inner.where(outside).groupBy("file_path", "a").agg(F.lit(1)).select(
        init_id.alias("node_id"),
        F.lit("method").alias("kind"),
        F.lit("<init>").alias("name"),
        F.lit("<init>").alias("code"),
        "file_path",
        F.col("a.s").alias("line_number"),
        F.col("a.a_end").alias("line_end"),
        F.col("a.id").alias("parent_id"),
        "a.package",
    )
    files = lines.where(F.col("line_no") == 1).join(packages, "file_path", "left").select(
        file_id.alias("node_id"),
        F.lit("file").alias("kind"),
        F.col("file_path").alias("name"),
        F.col("file_path").alias("code"),
        "file_path",
        F.lit(1).alias("line_number"),
        F.col("n_lines").alias("line_end"),
        F.lit(None).cast("string").alias("parent_id"),
        "package",
    )
    declared_nodes = files.unionByName(declarations).unionByName(starts).withColumn("receiver", F.lit(""))
    return declared_nodes.unionByName(elements)


def nodes(elements: DataFrame) -> DataFrame:
    return elements.drop("parent_id", "receiver", "package")


def _symbol(scope: str, place: Column | None, name: Column) -> Column:
    return F.concat_ws("|", F.lit("symbol"), F.lit(scope), F.lit("") if place is None else place, name)


def edges(elements: DataFrame) -> DataFrame:
    """``src, dst, kind``: ``AST`` by containment, ``CALL`` and ``TARGET`` by name; ``inside`` is the
    element directly around the ``src`` of a ``CALL``.

    A call goes to one symbol, that of the narrowest scope with a method of the name; the
    symbol goes to all methods of its scope and name, overloads included. ``new T()`` goes
    to the ``<init>`` of ``T``. What a file declares itself is found where its elements lie;
    of the other calls only the distinct names move.
    """
    no_one = F.lit(None).cast("string").alias("inside")
    ast = elements.where(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("src"), F.col("node_id").alias("dst"), F.lit("AST").alias("kind"), no_one
    )
    is_call = F.col("kind") == "call"
    owner = F.substring_index("parent_id", "|", -1)
    by_name = Window.partitionBy("file_path", "known")
    found = (
        elements.where(F.col("kind").isin("method", "call"))
        .select(
            "node_id",
            "kind",
            "file_path",
            "parent_id",
            F.when(is_call, F.col("receiver")).otherwise(owner).alias("type"),
            F.coalesce("package", F.lit("")).alias("package"),
            F.when(F.col("name") == "<init>", owner).otherwise(F.col("name")).alias("known"),
        )
        .withColumn("in_file", F.max(~is_call).over(by_name))
    )
    scopes = {
        "type": F.when(F.col("type") != "", _symbol("type", F.col("type"), F.col("known"))),
        "package": F.when(~is_call | ~F.col("in_file"), _symbol("package", F.col("package"), F.col("known"))),
        "any": F.when(~is_call | ~F.col("in_file"), _symbol("any", None, F.col("known"))),
    }
    asks = ["kind", "type", "package", "known", "in_file"]
    targets = found.where(~is_call).select(F.col("node_id").alias("dst"), F.explode(F.array(*scopes.values())).alias("src"))
    asked = found.where(is_call & ((F.col("type") != "") | ~F.col("in_file"))).groupBy(*asks).agg(F.lit(1))
    wanted = asked.select(*asks, F.posexplode(F.array(*scopes.values())).alias("scope", "symbol")).where(F.col("symbol").isNotNull())
    symbols = targets.select(F.col("src").alias("symbol")).distinct()
    beyond = staged(wanted.join(symbols, "symbol").groupBy(*asks).agg(F.min_by("symbol", "scope").alias("symbol")))
    n = beyond.count()
    own = _symbol("file", F.col("file_path"), F.col("known"))
    symbol = F.when(F.col("in_file"), own)
    if n:
        found = found.join(beyond.hint("broadcast" if n <= FEW else "merge"), asks, "left")
        symbol = F.coalesce("symbol", symbol)
    named = found.withColumn("symbol", F.when(is_call, symbol)).withColumn("used", F.max(F.col("symbol") == own).over(by_name))
    linked = staged(
        named.select("kind", "node_id", "parent_id", F.when(is_call, F.col("symbol")).when(F.col("used"), own).alias("symbol")).where(
            F.col("symbol").isNotNull()
        )
    )
    calls = linked.where(is_call).select(
        F.col("node_id").alias("src"), F.col("symbol").alias("dst"), F.lit("CALL").alias("kind"), F.col("parent_id").alias("inside")
    )
    target = [F.lit("TARGET").alias("kind"), no_one]
    told = ast.unionByName(calls).unionByName(linked.where(~is_call).select(F.col("symbol").alias("src"), F.col("node_id").alias("dst"), *target))
    if n == 0:
        return told
    used = beyond.select(F.col("symbol").alias("src")).distinct()
    return told.unionByName(targets.join(used, "src", "left_semi").select("src", "dst", *target))


def place_of(node: Column) -> dict[str, Column]:
    """``file_path, line_number, name`` of a node, read off its id. Only the path may hold the
    mark between the parts."""
    is_file = node.startswith("file|")
    path = F.regexp_extract(node, r"(?s)^\w+\|(.*)\|\d+\|\d+\|[^|]*$", 1)
    line = F.regexp_extract(node, r"\|(\d+)\|\d+\|[^|]*$", 1)
    of_file = F.substr(node, F.lit(len("file|") + 1))
    return {
        "file_path": F.when(is_file, of_file).otherwise(path),
        "line_number": F.when(is_file, F.lit(1)).otherwise(line.try_cast("int")),
        "name": F.when(is_file, of_file).when(node.startswith("init|"), "<init>").otherwise(F.substring_index(node, "|", -1)),
    }


def is_method(node: Column) -> Column:
    return node.startswith("method|") | node.startswith("init|")


def of_kind(graph_nodes: DataFrame, kind: str) -> DataFrame:
    return graph_nodes.where(F.col("kind") == kind)


def calls_by_code(graph_nodes: DataFrame, pattern: str) -> DataFrame:
    """Calls whose whole code matches ``pattern``."""
    return of_kind(graph_nodes, "call").where(text.full_match(F.col("code"), pattern))


def calls_by_name(graph_nodes: DataFrame, name: str) -> DataFrame:
    return of_kind(graph_nodes, "call").where(F.col("name") == name)


def _of(graph_edges: DataFrame, kind: str, src: str, dst: str) -> DataFrame:
    return graph_edges.where(F.col("kind") == kind).select(F.col("src").alias(src), F.col("dst").alias(dst))


def call_targets(graph_edges: DataFrame) -> DataFrame:
    """``src, dst``: a call and a method it may go to."""
    return _of(graph_edges, "CALL", "src", "symbol").join(_of(graph_edges, "TARGET", "symbol", "dst"), "symbol").select("src", "dst")


def _called(graph_edges: DataFrame, method: str) -> DataFrame:
    """A call, the method directly around it and its symbol."""
    return graph_edges.where(F.col("kind") == "CALL").select(F.col("src").alias("call"), F.col("inside").alias(method), F.col("dst").alias("symbol"))


def call_steps(graph_edges: DataFrame) -> DataFrame:
    """``src, dst``: from a method to the symbols it calls, and from a symbol to its
    methods. Two steps are one call, and no pair of caller and callee is spelt out."""
    called = _called(graph_edges, "src").select("src", F.col("symbol").alias("dst"))
    return called.unionByName(_of(graph_edges, "TARGET", "src", "dst")).distinct()


def method_calls(graph_edges: DataFrame) -> DataFrame:
    """``caller, call, callee`` ids: a method, a call directly inside it, a method it may go to."""
    return _called(graph_edges, "caller").join(_of(graph_edges, "TARGET", "symbol", "callee"), "symbol").select("caller", "call", "callee")


def callees(graph_edges: DataFrame, methods: DataFrame) -> DataFrame:
    """Distinct ``node_id, callee`` of the given methods (``node_id``), which are looked up first."""
    called = _called(graph_edges, "node_id").select("node_id", "symbol").distinct()
    symbols = called.join(methods.select("node_id"), "node_id", "left_semi")
    return symbols.join(_of(graph_edges, "TARGET", "symbol", "callee"), "symbol").select("node_id", "callee").distinct()


def callers(graph_edges: DataFrame, methods: DataFrame) -> DataFrame:
    """Distinct ``node_id, caller`` of the given methods (``node_id``), which are looked up first."""
    symbols = _of(graph_edges, "TARGET", "symbol", "node_id").join(methods.select("node_id"), "node_id", "left_semi")
    inside = _called(graph_edges, "caller").select("symbol", "caller").distinct()
    return symbols.join(inside, "symbol").select("node_id", "caller").distinct()


def ast_of(graph_nodes: DataFrame, roots: DataFrame, kind: str | None = None) -> DataFrame:
    """Nodes at any depth inside ``roots``, found by line containment: ``root_id`` and the node.

    Only the files of the roots are read on.
    """
    ranges = roots.select(
        "file_path",
        F.col("node_id").alias("root_id"),
        F.col("line_number").alias("r_start"),
        F.col("line_end").alias("r_end"),
    )
    inside = graph_nodes if kind is None else of_kind(graph_nodes, kind)
    return join_covering(inside, ranges, ["file_path"], "line_number", "r_start", "r_end").where(
        (F.col("node_id") != F.col("root_id")) & (F.col("line_end") <= F.col("r_end"))
    )


def reach(pairs: DataFrame, seeds: DataFrame, max_depth: int | None = None, per_origin: bool = False) -> DataFrame:
    """Everything reachable from the seeds: ``node, depth`` with the least depth.

    ``pairs`` holds ``src, dst``; ``seeds`` holds ``node``. With ``per_origin`` each seed is
    followed by itself, and ``origin`` says which: as many rows as pairs of seed and node.
    A round joins only the nodes found in the round before; each round is written out,
    so lineage stays flat and a lost executor costs one round. The driver sees only
    whether a round is empty.
    """
    step = staged(pairs.select("src", "dst").distinct())
    own = ["origin", "node"] if per_origin else ["node"]
    begin = seeds.select(*([F.col("node").alias("origin")] if per_origin else []), "node").distinct()
    frontier = staged(begin.withColumn("depth", F.lit(0)))
    seen, depth = frontier, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        found = (
            frontier.join(step, frontier["node"] == step["src"])
            .select(*own[:-1], F.col("dst").alias("node"))
            .distinct()
            .join(seen, own, "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        frontier = staged(found)
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def chains(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Every node on the way from each seed: ``seed, node, step``.

    ``links`` holds ``node, next``, at most one row for a node; ``seeds`` holds ``node``. Steps are
    doubled: a round carries all found so far as far ahead as they reach, so rounds grow
    with the logarithm of the longest way. On a circle it stops after as many steps as there
    are links. Links lie in buckets of their node, so a round moves them once, and no side is
    broadcast: staged ways take little room on disk and much in memory.
    """
    jump = staged(links.select("node", "next"))
    most = jump.count()
    buckets = max(jump.sparkSession.sparkContext.defaultParallelism, -(-most // LINKS_A_BUCKET))

    def dealt(links: DataFrame) -> DataFrame:
        return staged_by(links, "node", buckets)

    jump = dealt(jump)
    found = staged(seeds.select(F.col("node").alias("seed"), "node").distinct().withColumn("step", F.lit(0).cast("bigint")))
    reached = 1
    while reached <= most:
        ahead = staged(found.join(jump.hint("merge"), "node").select("seed", F.col("next").alias("node"), (F.col("step") + reached).alias("step")))
        if ahead.isEmpty():
            break
        found = found.unionByName(ahead)
        further = jump.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        jump = dealt(jump.join(further.hint("merge"), "next").select("node", F.col("beyond").alias("next")))
        reached *= 2
    return found
