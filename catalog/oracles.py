"""DuckDB counterparts of the registered queries."""

from __future__ import annotations

from catalog import duck_inputs as D
from catalog.queries import BATCH_LIMIT, COUNTED, SEARCH_TEXT, SMALL_LIMIT, SQL_TEXTS, TOKEN_LIMIT, WANTED_COUNTS

TOKEN = r"[A-Za-z0-9_]+|[^\sA-Za-z0-9_]"
NL = "chr(10)"
BLANKS = "' ' || chr(9) || chr(10) || chr(13)"


def w1(lines: str, spans: str, keys: str, mark: str, limit: int, drop_blank: bool) -> str:
    """Pieces of spans: a running count of closing lines, then every ``limit`` lines."""
    blank = f"WHERE trim(source, {BLANKS}) <> ''" if drop_blank else ""
    return f"""
w1_in AS (SELECT {keys}, l.line_no, l.source, (s.span_end - s.span_start < {limit}) AS short,
    CASE WHEN trim(l.source, {BLANKS}) = '' OR starts_with(ltrim(l.source, {BLANKS}), '{mark}') THEN 1 ELSE 0 END AS brk
  FROM {spans} s JOIN {lines} l ON s.file_path = l.file_path AND l.line_no BETWEEN s.span_start AND s.span_end),
w1_seg AS (SELECT *, CASE WHEN short THEN 0 ELSE coalesce(sum(brk) OVER (PARTITION BY {keys} ORDER BY line_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS seg FROM w1_in s),
w1_pos AS (SELECT *, CASE WHEN short THEN 0 ELSE (row_number() OVER (PARTITION BY {keys}, seg ORDER BY line_no) - 1) // {limit} END AS pos
  FROM w1_seg s),
w1_all AS (SELECT {keys}, min(line_no) AS start_line, max(line_no) AS end_line,
    string_agg(source, {NL} ORDER BY line_no) AS source FROM w1_pos s GROUP BY {keys}, seg, pos),
w1 AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY start_line) AS chunk_no FROM w1_all s {blank})"""


SPAN = "s.file_path, s.type, s.name, s.span_start, s.span_end"
CHUNK = "file_path, type, name, chunk_no, start_line, end_line, source"


def java_pieces(limit: int, spans: str = "jspans") -> str:
    return D.JAVA + "," + w1("jlines", spans, SPAN, "//", limit, True)


def python_pieces(limit: int, spans: str = "pspans") -> str:
    return D.PYTHON + "," + w1("plines", spans, SPAN, "#", limit, False)


def classed(source: str, relation: str) -> str:
    """Adds ``ls`` (stripped non-blank lines), then the class and its count."""
    return f"""
cl_in AS (SELECT *, list_filter(list_transform(string_split({source}, {NL}), lambda x: trim(x, {BLANKS})), lambda x: x <> '') AS ls FROM {relation}),
cl AS (SELECT * EXCLUDE (ls),
  CASE WHEN len(ls) = 0 THEN 'empty'
       WHEN trim({source}, {BLANKS}) IN ('}}', '}};', '{{', '{{;') THEN 'brace'
       WHEN len(ls) <= 2 AND len(list_filter(ls, lambda x: NOT (starts_with(x, '//') OR starts_with(x, '/*')))) = 0 THEN 'trivial_comment'
       WHEN len(list_filter(ls, lambda x: NOT starts_with(x, '//'))) < 3 THEN 'tiny' ELSE 'normal' END AS content_class,
  CASE WHEN len(ls) = 0 THEN 0
       WHEN trim({source}, {BLANKS}) IN ('}}', '}};', '{{', '{{;') THEN 1
       WHEN len(ls) <= 2 AND len(list_filter(ls, lambda x: NOT (starts_with(x, '//') OR starts_with(x, '/*')))) = 0 THEN len(ls)
       ELSE len(list_filter(ls, lambda x: NOT starts_with(x, '//'))) END AS line_count
  FROM cl_in)"""


def folded(keys: str, order: str, relation: str) -> str:
    """Merge groups by walking each sequence row by row."""
    on = " AND ".join(f"n.{k} = f.{k}" for k in keys.split(", "))
    return f"""
fold_in AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {relation}
  WHERE content_class NOT IN ('empty', 'trivial_comment')),
fold(rn, {keys}, grp, met, kept) AS (
  SELECT rn, {keys}, CASE WHEN content_class = 'normal' THEN 1 ELSE 0 END, content_class <> 'brace', content_class <> 'brace'
    FROM fold_in WHERE rn = 1
  UNION ALL
  SELECT n.rn, {", ".join("n." + k for k in keys.split(", "))}, CASE WHEN n.content_class = 'normal' THEN f.grp + 1 ELSE f.grp END,
    f.met OR n.content_class <> 'brace', f.met OR n.content_class <> 'brace'
    FROM fold f JOIN fold_in n ON {on} AND n.rn = f.rn + 1),
folded AS (SELECT i.*, f.grp AS merged_no FROM fold_in i JOIN fold f ON {on.replace("n.", "i.")} AND i.rn = f.rn WHERE f.kept)"""


def merged_java(limit: int) -> str:
    """Merged Java chunks as relation ``merged``."""
    return (
        java_pieces(limit)
        + ","
        + classed("source", "w1")
        + ","
        + folded("file_path", "span_start, start_line", "cl")
        + f""",
ranked AS (SELECT *, max(rn) OVER (PARTITION BY file_path, merged_no) AS last_rn FROM folded),
merged AS (SELECT file_path, arg_min(type, rn) AS type, arg_min(name, rn) AS name, arg_min(chunk_no, rn) AS chunk_no,
    arg_min(start_line, rn) AS start_line, max(end_line) AS end_line,
    string_agg(CASE WHEN rn < last_rn THEN rtrim(source, {BLANKS}) ELSE source END, {NL} ORDER BY rn) AS source
  FROM ranked GROUP BY file_path, merged_no)"""
    )


DOCSTRINGS = f"""SELECT file_path, 'docstring' AS type, NULL::VARCHAR AS name, 1::BIGINT AS chunk_no, min(line_no) AS start_line,
    max(line_no) AS end_line, string_agg(source, {NL} ORDER BY line_no) AS source
  FROM plines WHERE sec = 0 AND sub = 1 GROUP BY file_path"""

SQL_CHUNKS = (
    D.SQL
    + ","
    + "{pieces}"
    + f""", sspans AS (SELECT file_path, j, start_line AS span_start, end_line AS span_end FROM sstmt)"""
)


def sql_chunks(limit: int) -> str:
    """Relation ``sqlchunks``."""
    spans = "sspans AS (SELECT file_path, j, start_line AS span_start, end_line AS span_end FROM sstmt)"
    pieces = w1("slines", "sspans", "s.file_path, s.j, s.span_start, s.span_end", "--", limit, False)
    return f"""{D.SQL}, {spans}, {pieces},
sqlchunks AS (SELECT file_path, 'sql_statement' AS type, 'statement_part_' || chunk_no AS name, chunk_no, start_line, end_line, source FROM w1)"""


MARKUP_CHUNKS = f"""{D.MARKUP},
mcount AS (SELECT file_path, count(*) AS n FROM mlines GROUP BY file_path),
mmark AS (SELECT l.file_path, l.line_no, l.source || CASE WHEN l.line_no < c.n THEN {NL} ELSE '' END AS source,
    CASE WHEN l.line_no > 1 AND (regexp_matches(lower(l.source), '^\\s*<(%|jsp:|custom:|script|!--)')
      OR (trim(l.source, {BLANKS}) = '' AND trim(lag(l.source) OVER (PARTITION BY l.file_path ORDER BY l.line_no), {BLANKS}) = '')) THEN 1 ELSE 0 END AS b
  FROM mlines l JOIN mcount c ON l.file_path = c.file_path WHERE NOT (l.line_no = c.n AND l.source = '')),
mno AS (SELECT *, 1 + sum(b) OVER (PARTITION BY file_path ORDER BY line_no) AS chunk_no FROM mmark),
mchunks AS (SELECT file_path, 'jsp' AS type, NULL::VARCHAR AS name, chunk_no::BIGINT AS chunk_no, min(line_no) AS start_line,
    max(line_no) AS end_line, string_agg(source, '' ORDER BY line_no) AS source FROM mno GROUP BY file_path, chunk_no)"""

TALK_SPANS = "tspans AS (SELECT file_path, 1 AS span_start, max(line_no) AS span_end FROM tlines GROUP BY file_path)"
TALK_PIECES = D.TALK + "," + TALK_SPANS + "," + w1(
    "tlines", "tspans", "s.file_path, s.span_start, 1000000 AS span_end", "#", SMALL_LIMIT, False
).replace("s.file_path, s.span_start, 1000000 AS span_end", "s.file_path, s.span_start").replace(
    f"(s.span_end - s.span_start < {SMALL_LIMIT}) AS short", "false AS short"
)

DOCS = f"""docs AS (SELECT doc_id, doc_id::VARCHAR AS chunk_id, text AS source,
    len(regexp_extract_all(text, '{TOKEN}')) AS token_count FROM documents)"""
DOC_ERROR = (
    f"CASE WHEN token_count > {TOKEN_LIMIT} THEN 'chunk ' || chunk_id || ' too large: ' || token_count"
    f" || ' tokens while maximum is {TOKEN_LIMIT}' END"
)
VALID = f"{DOCS}, {classed('source', 'docs')}, valid AS (SELECT *, {DOC_ERROR} AS error FROM cl)"

HASH = f"""hash AS (SELECT doc_id, ('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS bucket, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{TOKEN}')) AS t FROM documents) GROUP BY 1, 2),
norms AS (SELECT doc_id, sqrt(sum(tf * tf)::DOUBLE) AS size FROM hash GROUP BY doc_id)"""

CONTEXT = f"""{D.JAVA}, {D.TRACES},
hit AS (SELECT r.trace_id, r.class, r.method, r.file, r.line, l.line_no, l.source, l.file_path, l.parent_type, l.parent_method
  FROM troot r JOIN jctx l ON l.parent_type = r.class AND l.parent_method = r.method AND l.line_no BETWEEN r.line - 10 AND r.line + 10),
ctx AS (SELECT trace_id, min(file_path) AS file_path, min(parent_type) AS parent_type, min(parent_method) AS parent_method,
    count(*) AS n, min(line_no) AS first_line, string_agg(source, {NL} ORDER BY line_no) AS code,
    string_agg(lpad(line_no::VARCHAR, 4, ' ') || ': ' || source, {NL} ORDER BY line_no) AS shown FROM hit GROUP BY trace_id),
asked AS (SELECT r.trace_id, r.class, x.trace_id IS NOT NULL AS found, CASE WHEN x.trace_id IS NOT NULL THEN
  'You''re a senior software engineer helping to diagnose Java stacktraces.' || {NL} || {NL}
  || 'Below is a Java exception stacktrace, along with the relevant source code from the application. Please explain what most likely caused the exception in plain language. If possible, also suggest how a developer should begin debugging it.'
  || {NL} || {NL} || '---' || {NL} || {NL} || 'Stacktrace:' || {NL} || trim(r.trace, {BLANKS}) || {NL} || {NL}
  || 'Failing Frame:' || {NL} || '- Class: ' || r.class || {NL} || '- Method: ' || r.method || {NL} || '- File: ' || r.file || {NL}
  || '- Line: ' || r.line || {NL} || {NL} || 'Code Around Line ' || r.line || ':' || {NL} || x.shown || {NL} || {NL} || '---' || {NL} || {NL}
  || 'Explain:' || {NL} || '1. What is most likely happening at this line?' || {NL} || '2. Why might it cause an error?' || {NL}
  || '3. What should the developer check or do next?' END AS prompt
  FROM troot r LEFT JOIN ctx x ON r.trace_id = x.trace_id)"""

# Calls as the Java inputs are built: text without indent and semicolon.
CALLS = """jcalls AS (
  SELECT file_path, k, j, 'm' || j AS method, line_no, replace(trim(source), ';', '') AS code,
    regexp_extract(source, '([A-Za-z0-9]+)\\(', 1) AS name FROM jlines
    WHERE sec = 1 AND sub = 2 AND regexp_matches(source, '^ *(use|m[0-9])')
  UNION ALL SELECT file_path, k, 0, 'x', line_no, code, regexp_extract(code, '([a-z0-9]+)', 1) FROM jlines,
    (VALUES (2, 'run()'), (3, 'send(first(1),' || chr(10) || '                second("(", 2))'), (3, 'first(1)'), (4, 'second("(", 2)')) AS t(place, code)
    WHERE sec = 2 AND i = place
  UNION ALL SELECT file_path, k, 0, 'x', line_no, string_agg('l' || v, '(' ORDER BY v) || '(1' || repeat(')', 10 - u), 'l' || u FROM jlines,
    range(10) AS a(u), range(10) AS b(v) WHERE sec = 2 AND i = 5 AND v >= u GROUP BY file_path, k, line_no, u)"""
GRAPH = f"""{D.JAVA}, {CALLS},
jlocals AS (SELECT file_path, 'm' || j AS method, line_no, 'v' || i AS name, trim(source) AS code FROM jlines
  WHERE sec = 1 AND sub = 2 AND regexp_matches(source, '^ *int v')),
jnodes AS (
  SELECT 'file' AS kind, file_path AS name, file_path AS code, file_path, 1::BIGINT AS line_number, max(line_no) AS line_end FROM jlines GROUP BY file_path
  UNION ALL SELECT CASE type WHEN 'class' THEN 'typeDecl' ELSE 'method' END, name, name, file_path, span_start, span_end FROM jspans
  UNION ALL SELECT 'call', name, code, file_path, line_no, line_no FROM jcalls
  UNION ALL SELECT 'local', name, code, file_path, line_no, line_no FROM jlocals),
jpairs AS (SELECT DISTINCT file_path, method, name AS callee FROM jcalls WHERE name LIKE 'm%')"""


# Calls of a supplier's file: caller and its line, step to the supplier called, callee and its line.
SERVICES = """spairs AS (
  SELECT 'svc/S' || s.s_suppkey || '.java' AS file_path, method, line_number::BIGINT AS line_number, 'svc/S' || t.s_suppkey || '.java' AS callee_file,
    replace(callee, 'K', t.s_suppkey::VARCHAR) AS callee_name, callee_line::BIGINT AS callee_line
  FROM supplier AS s, (VALUES ('open', 8, 1, '<init>', 2), ('open', 8, 1, 'serve', 14), ('open', 11, 0, 'close', 20), ('serve', 14, 0, 'open', 8),
    ('serve', 14, 0, 'open', 11), ('serve', 14, 1, 'onlyK', 18)) AS c(method, line_number, ahead, callee, callee_line)
  JOIN supplier AS t ON t.s_suppkey = s.s_suppkey + c.ahead
  -- the last has no class after it: its call of serve stays in its file
  UNION ALL SELECT 'svc/S' || max(s_suppkey) || '.java', 'open', 8, 'svc/S' || max(s_suppkey) || '.java', 'serve', 14 FROM supplier)"""


def _queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["path_scan"] = f"""WITH {D.PATHS} SELECT doc_id, substr(file_path, 7) AS file_path, regexp_extract(lower(file_path), '(\\.[a-z]+)$', 1) AS ext
      FROM paths WHERE file_path NOT LIKE '%/.git/%' AND file_path NOT LIKE '%/Venv/%'
        AND regexp_extract(lower(file_path), '(\\.[a-z]+)$', 1) IN ('.py', '.java', '.sql', '.jsp')"""
    q["lang_dispatch"] = f"""WITH {D.PATHS}, e AS (SELECT doc_id, regexp_extract(lower(file_path), '(\\.[a-z]+)$', 1) AS ext FROM paths),
      d AS (SELECT doc_id, ext, CASE ext WHEN '.py' THEN 'python' WHEN '.java' THEN 'java' WHEN '.sql' THEN 'sql' WHEN '.jsp' THEN 'jsp' END AS chunker FROM e)
      SELECT doc_id, chunker, CASE WHEN chunker = 'java' THEN 'java' END AS line_extractor,
        CASE WHEN chunker IS NULL THEN 'nothing chunks files of type ' || ext END AS reason FROM d"""
    q["line_explode"] = f"""SELECT doc_id, generate_subscripts(string_split(t, {NL}), 1) AS line_no, unnest(string_split(t, {NL})) AS source
      FROM (SELECT doc_id, regexp_replace(text, '\\n$', '') AS t FROM documents WHERE text <> '')"""
    q["line_context"] = f"WITH {D.JAVA} SELECT file_path, line_no, source, parent_type, parent_method FROM jctx"
    q["line_package"] = "SELECT 'src/C' || c_custkey || '.java' AS file_path, 'app.g' || (c_custkey % 25) AS package FROM customer"
    q["line_javadoc"] = f"""WITH {D.JAVA} SELECT file_path, line_no, parent_type, parent_method FROM jctx
      WHERE (sec = 0 AND sub = 2) OR (sec = 1 AND sub = 0)"""
    line_id = "sha256('line|' || file_path || '|' || file_line_no || '|' || source)"
    q["lines_load"] = f"""WITH {D.JAVA} SELECT {line_id} AS line_id, parent_type, parent_method, file_line_no, file_path, source
      FROM lines WHERE parent_method IS NOT NULL"""
    q["load_counts"] = f"""WITH {D.JAVA} SELECT file_path, count(*) AS offered, count(parent_method) AS loaded,
      count(*) - count(parent_method) AS rejected FROM lines GROUP BY file_path"""

    q["chunk_java"] = f"WITH {java_pieces(80)} SELECT {CHUNK} FROM w1"
    long_java = "jlong AS (SELECT * FROM jspans WHERE span_end - span_start >= 80)"
    q["chunk_java_split"] = (
        f"WITH {D.JAVA}, {long_java}, {w1('jlines', 'jlong', SPAN, '//', 80, True)} SELECT {CHUNK} FROM w1"
    )
    q["chunk_merge"] = f"WITH RECURSIVE {merged_java(SMALL_LIMIT)} SELECT {CHUNK} FROM merged"
    q["chunk_merge_runs"] = f"""WITH RECURSIVE ev AS (SELECT user_id, event_id, CASE event_type WHEN 'error' THEN 'brace'
        WHEN 'view' THEN 'tiny' WHEN 'click' THEN 'trivial_comment' ELSE 'normal' END AS content_class FROM events),
      {folded('user_id', 'event_id', 'ev')} SELECT user_id, event_id, merged_no::BIGINT AS merged_no FROM folded"""
    q["chunk_py"] = f"WITH {python_pieces(80)} SELECT {CHUNK} FROM w1"
    long_py = "plong AS (SELECT * FROM pspans WHERE span_end - span_start >= 80)"
    q["chunk_py_split"] = (
        f"WITH {D.PYTHON}, {long_py}, {w1('plines', 'plong', SPAN, '#', 80, False)} SELECT {CHUNK} FROM w1"
    )
    q["chunk_py_docstring"] = f"WITH {D.PYTHON} {DOCSTRINGS}"
    q["chunk_sql"] = f"WITH {sql_chunks(80)} SELECT {CHUNK} FROM sqlchunks"
    q["chunk_sql_split"] = f"WITH {sql_chunks(3)} SELECT {CHUNK} FROM sqlchunks"
    q["chunk_markup"] = f"WITH {MARKUP_CHUNKS} SELECT {CHUNK} FROM mchunks"
    q["chunk_all"] = f"""SELECT {CHUNK} FROM (WITH RECURSIVE {merged_java(80)} SELECT {CHUNK} FROM merged)
      UNION ALL SELECT {CHUNK} FROM (WITH {python_pieces(80)} SELECT {CHUNK} FROM w1 UNION ALL SELECT {CHUNK} FROM ({DOCSTRINGS}))
      UNION ALL SELECT {CHUNK} FROM (WITH {sql_chunks(80)} SELECT {CHUNK} FROM sqlchunks)
      UNION ALL SELECT {CHUNK} FROM (WITH {MARKUP_CHUNKS} SELECT {CHUNK} FROM mchunks)"""
    q["chunk_segment"] = f"""WITH {TALK_PIECES} SELECT file_path, chunk_no, start_line AS piece_start, end_line AS piece_end, source FROM w1"""
    q["chunk_ids"] = f"""WITH {TALK_PIECES} SELECT file_path, chunk_no,
      sha256(file_path || '|talk||' || chunk_no || '|' || start_line || '|' || end_line || '|' || source) AS chunk_id FROM w1"""
    q["chunk_classify"] = f"""WITH {java_pieces(SMALL_LIMIT)}, {classed('source', 'w1')}
      SELECT file_path, name, start_line, end_line, content_class, line_count::BIGINT AS line_count FROM cl"""

    q["chunk_validate"] = f"""WITH {VALID} SELECT chunk_id, token_count, content_class, line_count::BIGINT AS line_count, error FROM valid"""
    q["chunk_validate_summary"] = f"""WITH {VALID} SELECT count(*) FILTER (error IS NULL) AS ok, count(error) AS over_limit,
      count(*) FILTER (content_class = 'empty') AS empty, count(*) FILTER (content_class = 'brace') AS brace,
      count(*) FILTER (content_class = 'trivial_comment') AS trivial_comment, count(*) FILTER (content_class = 'tiny') AS tiny,
      count(*) FILTER (content_class = 'normal') AS normal FROM valid"""
    q["chunk_error_report"] = f"WITH {VALID} SELECT count(*) FILTER (error IS NULL) AS correct, count(error) AS with_errors FROM valid"
    q["chunk_cleanup"] = f"WITH {VALID} SELECT chunk_id, token_count FROM valid WHERE error IS NOT NULL"
    q["error_json"] = f"""WITH {VALID} SELECT chunk_id, '[{{"source":"validation","error":"' || error || '"}}]' AS errors_json,
      1::BIGINT AS n, error FROM valid WHERE error IS NOT NULL"""
    q["token_count"] = f"WITH {DOCS} SELECT doc_id, token_count AS tokens FROM docs"
    q["token_running"] = f"""WITH {DOCS} SELECT doc_id, (sum(token_count) OVER (ORDER BY doc_id))::BIGINT AS running_total FROM docs"""

    q["trace_frames"] = f"""WITH {D.TRACES}
      SELECT trace_id, 1::BIGINT AS frame_no, 'java.util.List' AS class, 'forEach' AS method, 'List.java' AS file, 10 + o % 90 AS line, false AS is_user_code FROM tr WHERE framed
      UNION ALL SELECT trace_id, 2, cls, method, 'C' || k || '.java', line, has_user FROM tr WHERE framed
      UNION ALL SELECT trace_id, 3, 'org.lib.Run', 'go', 'Run.java', 7, false FROM tr WHERE framed"""
    q["trace_root"] = f"""WITH {D.TRACES} SELECT r.trace_id, r.class, r.method, r.file, coalesce(r.line, 0) AS line,
      t.framed AND t.has_user AS is_user_code FROM troot r JOIN tr t ON r.trace_id = t.trace_id"""
    q["trace_context"] = f"WITH {CONTEXT} SELECT trace_id, file_path, parent_type, parent_method, n, first_line, code FROM ctx"
    q["trace_unmatched"] = f"""WITH {CONTEXT} SELECT trace_id, class, method FROM troot
      WHERE class IS NOT NULL AND trace_id NOT IN (SELECT trace_id FROM ctx)"""
    q["trace_prompt"] = f"WITH {CONTEXT} SELECT trace_id, prompt FROM asked WHERE found"
    q["trace_explain"] = f"""WITH {CONTEXT} SELECT trace_id, CASE WHEN class IS NULL THEN 'no_frames' WHEN NOT found THEN 'no_context' ELSE 'ok' END AS status,
      class, prompt FROM asked"""

    q["embed_batches"] = f"""WITH RECURSIVE {DOCS},
      seq AS (SELECT docs.doc_id, token_count AS t, documents.source AS origin, row_number() OVER (PARTITION BY documents.source ORDER BY docs.doc_id) AS rn
        FROM docs JOIN documents USING (doc_id)),
      walk(origin, rn, doc_id, batch_no, total) AS (
        SELECT origin, rn, doc_id, 1::BIGINT, t FROM seq WHERE rn = 1
        UNION ALL SELECT s.origin, s.rn, s.doc_id,
          CASE WHEN w.total + s.t > {BATCH_LIMIT} AND w.total > 0 THEN w.batch_no + 1 ELSE w.batch_no END,
          CASE WHEN w.total + s.t > {BATCH_LIMIT} AND w.total > 0 THEN s.t ELSE w.total + s.t END
        FROM walk w JOIN seq s ON s.origin = w.origin AND s.rn = w.rn + 1)
      SELECT origin, doc_id, batch_no FROM walk"""
    q["embed_hash"] = f"WITH {HASH} SELECT doc_id, bucket, tf FROM hash"
    chars = ", ".join(f"CASE WHEN ok THEN (length(source) - length(replace(source, '{c}', '')))::DOUBLE END AS {n}" for n, c in COUNTED.items())
    q["embed_merge"] = f"""WITH {DOCS}, v AS (SELECT *, token_count <= 8192 AS ok FROM docs)
      SELECT chunk_id, CASE WHEN ok THEN 'embedded' ELSE 'failed' END AS status,
        CASE WHEN NOT ok THEN 'chunk ' || chunk_id || ' too large: ' || token_count || ' tokens while maximum is 8192' END AS error,
        CASE WHEN ok THEN length(source)::DOUBLE END AS size, {chars} FROM v"""
    cos = "list_inner_product(p.v, w.v) / (sqrt(list_inner_product(p.v, p.v)) * sqrt(list_inner_product(w.v, w.v)))"
    vec = "p AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
    q["vector_search"] = f"""WITH {vec}, w AS (SELECT v FROM p ORDER BY vec_id LIMIT 1)
      SELECT p.vec_id, round({cos}, 6) AS score, p.label::BIGINT AS label FROM p, w ORDER BY score DESC, vec_id LIMIT 10"""
    q["vector_search_batch"] = f"""WITH {vec},
      parts AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM p),
      means AS (SELECT label, i, avg(x) AS x FROM parts GROUP BY label, i),
      w AS (SELECT label::BIGINT AS query_id, list(x ORDER BY i) AS v FROM means GROUP BY label),
      s AS (SELECT w.query_id, p.vec_id, round({cos}, 6) AS score FROM p, w),
      r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
      SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
    q["vector_upsert"] = """SELECT vec_id, label::BIGINT AS label, round(CASE WHEN label = 0 THEN -(embedding[1]::DOUBLE) ELSE embedding[1]::DOUBLE END, 6) AS first_value,
        len(embedding) AS dim FROM embeddings
      UNION ALL SELECT vec_id + 1000000, label, round(embedding[1]::DOUBLE, 6), len(embedding) FROM embeddings WHERE label = 1"""
    q["vector_dim_check"] = "SELECT vec_id, 'expected 64 values, got 32' AS error FROM embeddings WHERE label = 2"
    q["semantic_search"] = f"""WITH {HASH},
      qh AS (SELECT ('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS bucket, count(*) AS tf
        FROM (SELECT unnest(regexp_extract_all('{SEARCH_TEXT}', '{TOKEN}')) AS t) GROUP BY 1),
      dots AS (SELECT h.doc_id, sum(h.tf * qh.tf)::DOUBLE AS dot FROM hash h JOIN qh ON h.bucket = qh.bucket GROUP BY h.doc_id)
      SELECT n.doc_id, round(coalesce(d.dot, 0) / (n.size * (SELECT sqrt(sum(tf * tf)::DOUBLE) FROM qh)), 6) AS score
      FROM norms n LEFT JOIN dots d ON n.doc_id = d.doc_id ORDER BY score DESC, doc_id LIMIT 10"""
    counts = ", ".join(f"length(source) - length(replace(source, '{c}', ''))" for c in COUNTED.values())
    q["index_search"] = f"""WITH {java_pieces(80)},
      c AS (SELECT *, [length(source), {counts}]::FLOAT[]::DOUBLE[] AS v, {WANTED_COUNTS}::DOUBLE[] AS w,
        sha256(file_path || '|' || type || '|' || coalesce(name, '') || '|' || chunk_no || '|' || start_line || '|' || end_line || '|' || source) AS chunk_id FROM w1),
      p AS (SELECT *, list_inner_product(v, v) AS size FROM c WHERE len(regexp_extract_all(source, '{TOKEN}')) <= 8192)
      SELECT chunk_id, round(list_inner_product(v, w) / (sqrt(size) * sqrt(list_inner_product(w, w))), 6) AS score, {CHUNK} FROM p
      WHERE size > 0 ORDER BY score DESC, chunk_id LIMIT 10"""
    q["retrieval_context"] = f"""WITH {HASH},
      qh AS (SELECT item_id, ('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS bucket, count(*) AS tf
        FROM (SELECT item_id, unnest(regexp_extract_all(text, '{TOKEN}')) AS t FROM benchmark) GROUP BY 1, 2),
      qn AS (SELECT item_id, sqrt(sum(tf * tf)::DOUBLE) AS size FROM qh GROUP BY item_id),
      dots AS (SELECT q.item_id, h.doc_id, sum(h.tf * q.tf)::DOUBLE AS dot FROM hash h JOIN qh q ON h.bucket = q.bucket GROUP BY 1, 2),
      s AS (SELECT q.item_id, n.doc_id, round(coalesce(d.dot, 0) / (n.size * q.size), 6) AS score
        FROM qn q CROSS JOIN norms n LEFT JOIN dots d ON d.item_id = q.item_id AND d.doc_id = n.doc_id),
      r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
      SELECT r.item_id AS query_id, string_agg(x.text, chr(10) || '---' || chr(10) ORDER BY r.rank) AS context
      FROM r JOIN documents x ON x.doc_id = r.doc_id WHERE rank <= 5 GROUP BY r.item_id"""
    q["view_chunks"] = f"""WITH {MARKUP_CHUNKS} SELECT file_path, chunk_no, start_line || ' - ' || end_line AS lines, type, '-' AS name,
      CASE WHEN source = '' THEN '-' ELSE source END AS source FROM mchunks"""

    q["graph_build"] = f"WITH {GRAPH} SELECT kind, name, code, file_path, line_number, line_end FROM jnodes"
    q["graph_edges"] = f"""WITH {GRAPH}
      SELECT 'AST' AS kind, file_path, file_path AS src_name, name AS dst_name, span_start AS dst_line FROM jspans WHERE type = 'class' AND name <> 'In'
      UNION ALL SELECT 'AST', file_path, 'C' || k, name, span_start FROM jspans WHERE name = 'In' OR name LIKE 'm%'
      UNION ALL SELECT 'AST', file_path, 'In', name, span_start FROM jspans WHERE name = 'x'
      UNION ALL SELECT 'AST', file_path, method, name, line_no FROM jcalls
      UNION ALL SELECT 'AST', file_path, method, name, line_no FROM jlocals
      UNION ALL SELECT 'CALL', c.file_path, c.name, s.name, s.span_start FROM jcalls c
        JOIN jspans s ON s.file_path = c.file_path AND s.name = c.name AND s.type = 'function'"""
    q["graph_methods"] = f"WITH {D.JAVA} SELECT file_path, name, span_start AS line_number FROM jspans WHERE type = 'function'"
    q["graph_types"] = f"WITH {D.JAVA} SELECT file_path, name, span_start AS line_number FROM jspans WHERE type = 'class'"
    q["graph_files"] = f"WITH {D.JAVA} SELECT file_path AS name, max(line_no) AS line_end FROM jlines GROUP BY file_path"
    q["graph_locals"] = f"WITH {GRAPH} SELECT file_path, name, code, line_no AS line_number FROM jlocals"
    q["graph_calls_by_code"] = f"""WITH {GRAPH} SELECT file_path, code, line_no AS line_number FROM jcalls
      WHERE regexp_full_match(code, '.*p1[0-9], "\\{{.*')"""
    q["graph_calls_by_name"] = f"WITH {GRAPH} SELECT file_path, code, line_no AS line_number FROM jcalls WHERE name = 'run'"
    q["graph_callers"] = f"WITH {GRAPH} SELECT file_path, callee AS method, method AS caller_name FROM jpairs WHERE callee = 'm1'"
    q["graph_callees"] = f"WITH {GRAPH} SELECT file_path, method, callee AS callee_name FROM jpairs WHERE method = 'm0'"
    q["graph_ast_calls"] = f"WITH {GRAPH} SELECT file_path, line_no AS line_number, code FROM jcalls WHERE method = 'm0'"
    q["graph_reach"] = f"""WITH RECURSIVE {GRAPH},
      walk(file_path, name, depth) AS (
        SELECT file_path, name, 0 FROM jspans WHERE name = 'm0'
        -- a shortest chain of calls passes no method twice
        UNION SELECT w.file_path, p.callee, w.depth + 1 FROM walk w JOIN jpairs p ON p.file_path = w.file_path AND p.method = w.name
        WHERE w.depth < (SELECT max(n) FROM (SELECT count(*) AS n FROM jspans GROUP BY file_path)))
      SELECT file_path, name, min(depth)::BIGINT AS depth FROM walk GROUP BY file_path, name"""
    q["graph_outside_calls"] = """SELECT 'svc/S' || s_suppkey || '.java' AS file_path, name, replace(code, 'K', s_suppkey::VARCHAR) AS code, line_number::BIGINT AS line_number
      FROM supplier, (VALUES ('seed', 'seed(K)', 3), ('boot', 'boot()', 4), ('prepare', 'prepare(a(b(c(d(K)))))', 6), ('a', 'a(b(c(d(K))))', 6),
        ('b', 'b(c(d(K)))', 6), ('c', 'c(d(K))', 6), ('d', 'd(K)', 6)) AS t(name, code, line_number)"""
    q["graph_outside_locals"] = """SELECT 'svc/S' || s_suppkey || '.java' AS file_path, name, code, line_number::BIGINT AS line_number, parent
      FROM supplier, (VALUES ('kept', 'int kept = a;', 23, '<init>'), ('more', 'if (a > 0) { long more = a; }', 24, '<init>'),
        ('once', 'String once = "}";', 27, '<init>'), ('inner', 'Runnable later = () -> { int inner = 1; };', 30, '<init>')) AS t(name, code, line_number, parent)"""
    q["graph_cross_calls"] = f"WITH {SERVICES} SELECT * FROM spairs"
    q["ansi_strip"] = "SELECT page_id, url || ' ' || html AS reply FROM pages"

    q["view_lines"] = f"""WITH {D.JAVA} SELECT file_path, file_line_no, coalesce(parent_type, '-') AS parent_type,
      coalesce(parent_method, '-') AS parent_method, CASE WHEN source = '' THEN '-' ELSE source END AS source FROM lines"""
    q["lines_by_file"] = f"WITH {D.JAVA} SELECT * FROM lines WHERE file_path = 'src/C7.java'"
    q["lines_by_method"] = f"WITH {D.JAVA} SELECT * FROM lines WHERE parent_method = 'x'"
    q["lines_like"] = f"WITH {D.JAVA} SELECT * FROM lines WHERE source ILIKE '%PUBLIC%1%'"
    for name, statement in SQL_TEXTS.items():
        # read more than once by some: worked out once
        q[name] = f"WITH {D.JAVA.replace('lines AS (SELECT parent_type', 'lines AS MATERIALIZED (SELECT parent_type')} SELECT * FROM ({statement})"
    # apart from the query's text: the method of the next line by a window
    q["sql_join_self"] = f"""WITH {D.JAVA} SELECT file_path, file_line_no, here, after FROM (
      SELECT file_path, file_line_no, parent_method AS here, lead(parent_method) OVER (PARTITION BY file_path ORDER BY file_line_no) AS after FROM lines)
      WHERE here <> after"""
    q["sql_listagg"] = f"""WITH {D.JAVA} SELECT parent_type, string_agg(parent_method, ',' ORDER BY first_line) AS methods
      FROM (SELECT parent_type, parent_method, min(file_line_no) AS first_line FROM lines WHERE parent_method IS NOT NULL
            GROUP BY parent_type, parent_method) GROUP BY parent_type"""
    q["sql_recursive"] = f"""WITH RECURSIVE {D.JAVA}, up AS (
        SELECT file_path, span_start AS file_line_no, 0::BIGINT AS step FROM jspans WHERE name = 'x'
        UNION ALL SELECT file_path, file_line_no - 1, step + 1 FROM up WHERE file_line_no > 1)
      SELECT * FROM up"""
    return q


ORACLES = _queries()
