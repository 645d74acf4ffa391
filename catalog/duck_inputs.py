"""The inputs of ``catalog.inputs`` as DuckDB common table expressions.

Lines are built as rows here, so spans follow from row numbers, not from parsing.
"""

JAVA = """
jm AS (SELECT c_custkey AS k, c_mktsegment AS seg, 1 + c_custkey % 5 AS nm,
              unnest(range(0, 1 + c_custkey % 5)) AS j FROM customer),
jm2 AS (SELECT *, CASE WHEN (k + j) % 40 = 0 THEN 100 ELSE 1 + (k * 7 + j * 3) % 13 END AS bl FROM jm),
jraw AS (
  SELECT c_custkey AS k, 0 AS sec, 0 AS j, 0 AS sub, 0 AS i, 'package app.g' || (c_custkey % 25) || ';' AS source FROM customer
  UNION ALL SELECT c_custkey, 0, 0, 1, 0, '' FROM customer
  UNION ALL SELECT c_custkey, 0, 0, 2, 0, '/** Customer ' || c_custkey || '. */' FROM customer
  UNION ALL SELECT c_custkey, 0, 0, 3, 0, 'public class C' || c_custkey || ' {' FROM customer
  UNION ALL SELECT k, 1, j, 0, t.i, CASE t.i WHEN 0 THEN '    /**' WHEN 1 THEN '     * Step ' || j || ' of } ' || seg || '.' ELSE '     */' END
    FROM jm2, (SELECT unnest(range(0, 3)) AS i) t WHERE (k + j) % 2 = 0
  UNION ALL SELECT k, 1, j, 1, 0, '    public int m' || j || '(int a) {' FROM jm2
  UNION ALL SELECT k, 1, j, 2, i, CASE
      WHEN i % 30 = 0 THEN '        // note ' || i
      WHEN i % 17 = 0 THEN ''
      WHEN i % 11 = 5 THEN '        int v' || i || ' = a;'
      WHEN i % 9 = 4 THEN '        m' || ((j + 1) % nm) || '(i);'
      ELSE '        use(p' || ((k * i + j) % 97) || ', "{");' END
    FROM (SELECT *, unnest(range(1, bl + 1)) AS i FROM jm2)
  UNION ALL SELECT k, 1, j, 3, 0, '    }' FROM jm2
  UNION ALL SELECT k, 1, j, 4, 0, '' FROM jm2 WHERE (k + j) % 3 = 0
  UNION ALL SELECT c_custkey, 2, 0, 0, t.i, CASE t.i WHEN 0 THEN '    static class In {' WHEN 1 THEN '        void x() {'
      WHEN 2 THEN '            run();' WHEN 3 THEN '            send(first(1),' WHEN 4 THEN '                second("(", 2));'
      WHEN 5 THEN '            l0(l1(l2(l3(l4(l5(l6(l7(l8(l9(1))))))))));' WHEN 6 THEN '        }' ELSE '    }' END
    FROM customer, (SELECT unnest(range(0, 8)) AS i) t WHERE c_custkey % 4 = 0
  UNION ALL SELECT c_custkey, 3, 0, 0, 0, '}' FROM customer
  UNION ALL SELECT c_custkey, 4, 0, 0, t.i, CASE t.i WHEN 0 THEN '@interface Mark {' WHEN 1 THEN '    String value() default "";'
      WHEN 2 THEN '    int size();' ELSE '}' END FROM customer, (SELECT unnest(range(0, 4)) AS i) t WHERE c_custkey % 4 = 1),
jlines AS (SELECT 'src/C' || k || '.java' AS file_path,
    row_number() OVER (PARTITION BY k ORDER BY sec, j, sub, i) AS line_no, * FROM jraw),
jspans AS (
  SELECT file_path, k, 'class' AS type, 'C' || k AS name, min(line_no) FILTER (sec = 0 AND sub = 3) AS span_start, max(line_no) FILTER (sec < 4) AS span_end
    FROM jlines GROUP BY file_path, k
  UNION ALL SELECT file_path, k, 'function', 'm' || j, min(line_no) FILTER (sub = 1), max(line_no) FILTER (sub = 3)
    FROM jlines WHERE sec = 1 GROUP BY file_path, k, j
  UNION ALL SELECT file_path, k, 'class', 'In', min(line_no), max(line_no) FROM jlines WHERE sec = 2 GROUP BY file_path, k
  UNION ALL SELECT file_path, k, 'function', 'x', min(line_no) FILTER (i = 1), max(line_no) FILTER (i = 6)
    FROM jlines WHERE sec = 2 GROUP BY file_path, k),
jctx AS (SELECT file_path, line_no, source, sec, sub, i, j, k,
    CASE WHEN sec = 0 AND sub < 2 OR sec = 4 THEN NULL
         WHEN sec = 2 THEN 'app.g' || (k % 25) || '.C' || k || '.In'
         ELSE 'app.g' || (k % 25) || '.C' || k END AS parent_type,
    CASE WHEN sec = 1 AND sub < 4 THEN 'm' || j WHEN sec = 2 AND i BETWEEN 1 AND 6 THEN 'x' END AS parent_method
  FROM jlines),
lines AS (SELECT parent_type, parent_method, line_no AS file_line_no, file_path, source FROM jctx)
"""

PYTHON = """
pm AS (SELECT p_partkey AS k, unnest(range(0, p_partkey % 4 + 1)) AS j FROM part),
pm2 AS (SELECT *, CASE WHEN (k + j) % 30 = 0 THEN 120 ELSE 1 + (k * 5 + j) % 9 END AS bl FROM pm),
praw AS (
  SELECT p_partkey AS k, 0 AS sec, 0 AS j, 0 AS sub, 0 AS i, '# part ' || p_partkey AS source FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT p_partkey, 0, 0, 1, t.i, CASE t.i WHEN 0 THEN '\"\"\"Part ' || p_partkey WHEN 1 THEN p_type || ' notes.' ELSE '\"\"\"' END
    FROM part, (SELECT unnest(range(0, 3)) AS i) t WHERE p_partkey % 3 <> 0
  UNION ALL SELECT p_partkey, 0, 0, 2, 0, '' FROM part
  UNION ALL SELECT p_partkey, 0, 0, 3, 0, 'import os' FROM part
  UNION ALL SELECT p_partkey, 0, 0, 4, 0, '' FROM part
  UNION ALL SELECT p_partkey, 0, 0, 5, 0, 'class P' || p_partkey || ':' FROM part
  UNION ALL SELECT k, 1, j, 0, 0, '    @staticmethod' FROM pm2 WHERE (k + j) % 3 = 0
  UNION ALL SELECT k, 1, j, 1, 0, CASE WHEN j % 2 = 0 THEN '    def m' || j || '(self,' ELSE '    def m' || j || '(self):' END FROM pm2
  UNION ALL SELECT k, 1, j, 1, 1, '        a=' || j || '):' FROM pm2 WHERE j % 2 = 0
  UNION ALL SELECT k, 1, j, 2, i, CASE WHEN i % 20 = 0 THEN '        # step ' || i WHEN i % 13 = 0 THEN ''
      ELSE '        x = "def {' || i || '}:"' END
    FROM (SELECT *, unnest(range(1, bl + 1)) AS i FROM pm2)
  UNION ALL SELECT k, 1, j, 3, 0, '        def inner():' FROM pm2 WHERE (k + j) % 5 = 0
  UNION ALL SELECT k, 1, j, 3, 1, '            return ' || j FROM pm2 WHERE (k + j) % 5 = 0
  UNION ALL SELECT k, 1, j, 4, 0, '        return x' FROM pm2
  UNION ALL SELECT k, 1, j, 5, 0, '' FROM pm2
  UNION ALL SELECT p_partkey, 2, 0, 0, t.i, CASE t.i WHEN 0 THEN 'async def tail():' WHEN 1 THEN '    \"\"\"Doc' WHEN 2 THEN 'of tail\"\"\"' ELSE '    await go()' END
    FROM part, (SELECT unnest(range(0, 4)) AS i) t),
plines AS (SELECT 'lib/p' || k || '.py' AS file_path,
    row_number() OVER (PARTITION BY k ORDER BY sec, j, sub, i) AS line_no, * FROM praw),
pspans AS (
  SELECT file_path, 'class' AS type, 'P' || k AS name, min(line_no) FILTER (sec = 0 AND sub = 5) AS span_start,
      max(line_no) FILTER (sec = 1 AND sub = 4) AS span_end FROM plines GROUP BY file_path, k
  UNION ALL SELECT file_path, 'function', 'm' || j, min(line_no) FILTER (sub = 1), max(line_no) FILTER (sub = 4)
    FROM plines WHERE sec = 1 GROUP BY file_path, k, j
  UNION ALL SELECT file_path, 'function', 'inner', min(line_no), max(line_no) FROM plines WHERE sec = 1 AND sub = 3 GROUP BY file_path, k, j
  UNION ALL SELECT file_path, 'unknown', 'tail', min(line_no), max(line_no) FROM plines WHERE sec = 2 GROUP BY file_path, k)
"""

SQL = """
sm AS (SELECT c_custkey AS k, unnest(range(0, c_custkey % 4 + 1)) AS j FROM customer),
sraw AS (
  SELECT c_custkey AS k, -1 AS j, 0 AS i, '' AS source FROM customer
  UNION ALL SELECT k, j, 0, '-- customer ' || k FROM sm
  UNION ALL SELECT k, j, 1, 'UPDATE t' || j FROM sm
  UNION ALL SELECT k, j, 2, '  SET v = ' || (k * j) FROM sm
  UNION ALL SELECT k, j, 3, 'WHERE id = ' || k FROM sm
  UNION ALL SELECT k, j, 4, '' FROM sm WHERE j % 2 = 0
  UNION ALL SELECT c_custkey, 10, t.i, CASE WHEN t.i % 25 = 0 THEN '-- row ' || t.i ELSE 'SELECT ' || t.i || ' UNION ALL' END
    FROM customer, (SELECT unnest(range(1, 100)) AS i) t WHERE c_custkey % 50 = 0
  UNION ALL SELECT c_custkey, 20, 0, 'SELECT 1' FROM customer WHERE c_custkey % 2 = 1),
slines AS (SELECT 'db/s' || k || '.sql' AS file_path, row_number() OVER (PARTITION BY k ORDER BY j, i) AS line_no, * FROM sraw),
sstmt AS (SELECT file_path, j, min(line_no) AS start_line, max(line_no) AS end_line, string_agg(source, chr(10) ORDER BY i) AS source
  FROM slines WHERE j >= 0 AND NOT (j < 10 AND i = 4) GROUP BY file_path, j)
"""

MARKUP = """
mfiles AS (SELECT 'web/' || page_id || '.jsp' AS file_path, regexp_replace(html, '><', '>' || chr(10) || '<', 'g') AS content FROM pages),
mlines AS (SELECT file_path, content, unnest(string_split(content, chr(10))) AS source,
    generate_subscripts(string_split(content, chr(10)), 1) AS line_no FROM mfiles)
"""

TALK = """
tfiles AS (SELECT 'talk/' || conv_id || '/' || turn AS file_path, '# ' || role || chr(10) || text || chr(10) AS content FROM conversations),
tlines AS (SELECT file_path, unnest(string_split(content, chr(10))) AS source,
    generate_subscripts(string_split(content, chr(10)), 1) AS line_no FROM tfiles)
"""

PATHS = """
paths AS (SELECT doc_id, '/repo/' || CASE WHEN doc_id % 7 = 0 THEN '.git/' WHEN doc_id % 5 = 0 THEN 'Venv/' ELSE 'src/' END
  || source || '/' || CASE WHEN doc_id % 11 = 0 THEN '.' ELSE '' END || doc_id ||
  CASE lang WHEN 'en' THEN '.py' WHEN 'fr' THEN '.java' WHEN 'de' THEN '.sql' WHEN 'es' THEN '.JSP' ELSE '.txt' END AS file_path FROM documents)
"""

# Columns a trace is made of, without its text.
TRACES = """
tr AS (SELECT o_orderkey AS trace_id, o_orderkey AS o, o_custkey AS k,
    5 + CASE WHEN o_custkey % 2 = 0 THEN 3 ELSE 0 END + 1
      + o_orderkey % CASE WHEN o_custkey % 40 = 0 THEN 100 ELSE 1 + (o_custkey * 7) % 13 END AS line,
    CASE WHEN o_orderkey % 25 = 0 THEN 'zz' ELSE 'm0' END AS method,
    CASE WHEN o_orderkey % 10 = 0 THEN 'ext' ELSE 'app' END || '.g' || (o_custkey % 25) || '.C' || o_custkey AS cls,
    o_orderkey % 33 <> 0 AS framed, o_orderkey % 10 <> 0 AS has_user FROM orders),
trtext AS (SELECT *, CASE WHEN framed THEN 'java.lang.IllegalStateException: order ' || o || chr(10) || chr(9)
    || 'at java.util.List.forEach(List.java:' || (10 + o % 90) || ')' || chr(10) || chr(9)
    || 'at ' || cls || '.' || method || '(C' || k || '.java:' || line || ')' || chr(10) || chr(9)
    || 'at org.lib.Run.go(Run.java:7)' || chr(10) ELSE 'Exception in order ' || o END AS trace FROM tr),
troot AS (SELECT trace_id, trace,
    CASE WHEN NOT framed THEN NULL WHEN has_user THEN cls ELSE 'java.util.List' END AS class,
    CASE WHEN NOT framed THEN NULL WHEN has_user THEN method ELSE 'forEach' END AS method,
    CASE WHEN NOT framed THEN NULL WHEN has_user THEN 'C' || k || '.java' ELSE 'List.java' END AS file,
    CASE WHEN NOT framed THEN NULL WHEN has_user THEN line ELSE 10 + o % 90 END AS line FROM trtext)
"""
