"""Registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.llm import (
    bpe,
    decontamination,
    fill_in_middle,
    license_scan,
    main_text,
    near_duplicates,
    quality_mil,
    secret_scan,
    source_mix,
    spelling,
    suffix_tree,
    toxicity,
    vector_file,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _joined(values) -> F.Column:
    return F.array_join(values, ",")


def near_duplicate_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(_table(spark, sf_dir, "documents"))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    def told(spans) -> F.Column:
        return _joined(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))

    base = F.filter("spans", lambda s: s.kind.isin([r.kind for r in secret_scan.BASE]))
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(told(base), 256).alias("base_sha256"),
        told("spans").alias("spans"),
    )


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(_joined("items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    decoded = tokenizer.decode(tokenizer.encode(_table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(_joined(F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scores(_table(spark, sf_dir, "documents"))


def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(_table(spark, sf_dir, "pages"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_file.top_k(_table(spark, sf_dir, "embeddings"), every=50, k=5)


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_labels(_table(spark, sf_dir, "documents"))
    labels = F.array_union("base.label", "detections.label")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        _joined(F.array_sort(F.array_distinct("base.label"))).alias("base_labels"),
        _joined(F.array_sort(labels)).alias("labels"),
        "score",
    )


def fill_in_middle_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.restored(fill_in_middle.transformed(_table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")
    )


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mixed(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingle AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS s
            FROM doc, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS u(i) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle AS a JOIN shingle AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pair JOIN size AS p ON p.doc_id = x JOIN size AS q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
step AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, s.y FROM reach AS r JOIN step AS s ON s.x = r.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least_id AS component_id, d.doc_id = least_id AS kept
FROM documents AS d JOIN (SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id) USING (doc_id) LEFT JOIN size USING (doc_id)
"""

DECONTAMINATE = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
cut AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS key
        FROM item, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS u(i) WHERE len(w) > 0),
doc AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
place AS (SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS key
          FROM doc, (SELECT DISTINCT k FROM cut) AS sizes, unnest(range(1, len(w) - k + 2)) AS u(i)),
found AS (SELECT doc_id, i, k, item_id FROM place JOIN cut USING (k, key)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT DISTINCT doc_id, i, k FROM found), unnest(range(i, i + k)) AS v(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS told
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(told, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

EXACT_TOP_K = """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
         FROM whole AS q JOIN whole AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pair) WHERE rank <= 5
"""

FILL_IN_MIDDLE = """
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (SELECT doc_id, text, t, len(t) AS n, ('0x' || h[1:8])::BIGINT % (len(t) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(t) + 1) AS c2,
               ('0x' || h[17:24])::BIGINT % 100 AS r3, ('0x' || h[25:32])::BIGINT % 100 AS r4
        FROM (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t FROM doc)),
part AS (SELECT doc_id, text, n, array_to_string(t[1 : least(c1, c2)], '') AS p, array_to_string(t[least(c1, c2) + 1 : greatest(c1, c2)], '') AS m,
                array_to_string(t[greatest(c1, c2) + 1 : n], '') AS s,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r3 >= 90 THEN 'plain'
                     WHEN r4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM part
"""

SPELLING = f"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) ORDER BY i) AS t
                       FROM range(256) AS r(i)),
run AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS told, count(*) AS k
        FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
byte AS (SELECT run, k, list_transform(range(1, strlen(told) * 2, 2), lambda i: ('0x' || substring(hex(encode(told)), i, 2))::BIGINT) AS b FROM run),
hashed AS (SELECT run, k, xor(list_reduce(b, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM byte, crc),
word AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n
         FROM (SELECT k, CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
         WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
short AS MATERIALIZED (SELECT word, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM word, unnest(range(1, length(word) + 1)) AS u(i)),
less AS (SELECT DISTINCT w.word AS a, s.word AS b FROM word AS w JOIN short AS s ON w.word = s.rest),
near AS (SELECT a.word AS a, b.word AS b FROM short AS a JOIN short AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION ALL SELECT a, b FROM less UNION ALL SELECT b, a FROM less),
best AS (SELECT a AS word, b, m, row_number() OVER (PARTITION BY a ORDER BY m DESC, b) AS place, count(*) OVER (PARTITION BY a) AS n_near
         FROM (SELECT near.a, near.b, word.n AS m FROM near JOIN word ON word.word = near.b)),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN b END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n
           FROM word AS w LEFT JOIN best ON best.word = w.word AND place = 1),
walk(word, root, up) AS (SELECT word, word, form FROM formed UNION ALL SELECT k.word, f.word, f.form FROM walk AS k JOIN formed AS f ON f.word = k.up)
SELECT f.word, f.form, k.root, f.n, f.n_near, f.form_n FROM formed AS f JOIN walk AS k ON k.word = f.word AND k.up IS NULL
"""

SOURCE_MIX = r"""
WITH doc AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                    greatest(0.1, least(1.0, coalesce(CAST(length(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS DOUBLE) / nullif(length(text), 0), 0) / 0.75)) AS weight,
                    (('0x' || sha256('mix:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:13])::BIGINT + 0.5::DOUBLE) / 4503599627370496 AS u FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM doc GROUP BY source),
filled AS (SELECT *, 150 * sum(source_size) OVER () - 100 * coalesce(sum(2 * source_size) OVER b, 0) AS left_, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS sharing
           FROM src WINDOW b AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_open AS (SELECT left_, sharing FROM filled WHERE 200.0::DOUBLE * source_size * sharing > w * left_ ORDER BY 2 * source_size / w, source NULLS LAST LIMIT 1),
aim AS (SELECT source, source_size, CAST(CASE WHEN 200.0::DOUBLE * source_size * f.sharing <= w * f.left_ OR o.left_ IS NULL THEN 2 * source_size
               ELSE CAST(w * o.left_ AS DOUBLE) / CAST(100 * o.sharing AS DOUBLE) END AS DOUBLE) AS target FROM filled AS f LEFT JOIN first_open AS o ON true),
goal AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM aim),
placed AS (SELECT doc_id, d.source, size, source_size, target, copies, CAST(floor(target - copies * source_size) AS BIGINT) AS rest,
                  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / weight, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
           FROM doc AS d JOIN goal AS g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, size, source_size, target, copies, CAST(copies * size + greatest(0, least(size, rest - earlier)) AS BIGINT) AS taken FROM placed
"""

QUERIES = {
    "op1_near_duplicates": near_duplicate_components,
    "op2_secret_scan": secrets,
    "op3_decontamination": decontaminate,
    "op4_bpe": bpe_round_trip,
    "op5_suffix_tree": suffix_tree_scores,
    "op6_toxicity": toxic_scores,
    "op7_main_text": page_texts,
    "op8_quality": quality_scores,
    "op9_exact_top_k": exact_top_k,
    "op10_license_scan": licenses,
    "op11_fill_in_middle": fill_in_middle_texts,
    "op12_spelling_variants": spelling_variants,
    "op13_source_mix": source_mixture,
    "pipeline": pipeline,
}
ORACLES = {
    "op1_near_duplicates": NEAR_DUPLICATES,
    "op3_decontamination": DECONTAMINATE,
    "op9_exact_top_k": EXACT_TOP_K,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op12_spelling_variants": SPELLING,
    "op13_source_mix": SOURCE_MIX,
}
