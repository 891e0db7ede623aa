"""Registered queries of the training-data operators, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (fingerprint, importance, licenses, lm, minhash, mixing, packing, passages, pii, quality, tokencount,
                          topk, variants)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file lies; the operators take any path."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


ORACLE["op7_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


@query
def op8_top_k(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


ORACLE["op8_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, unnest(e) AS a, generate_subscripts(e, 1) AS d FROM v WHERE vec_id % 50 = 0),
c AS (SELECT vec_id, unnest(e) AS b, generate_subscripts(e, 1) AS d FROM v),
s AS (SELECT query_id, vec_id, CAST(sum(a * b) AS BIGINT) AS score FROM q JOIN c USING (d)
      WHERE query_id <> vec_id GROUP BY 1, 2)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@query
def op9_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op3_mixing(spark, sf_dir):
    return mixing.taken_words(_table(spark, sf_dir, "documents"))


PSEUDONYM_KEY = "spark.tillroll.pseudonymKey"


def pseudonym_key(spark: SparkSession) -> bytes:
    """The key in the session's setting ``PSEUDONYM_KEY``; where it is unset, a random one for this session."""
    if not spark.conf.get(PSEUDONYM_KEY, None):
        spark.conf.set(PSEUDONYM_KEY, secrets.token_hex(32))
    return spark.conf.get(PSEUDONYM_KEY).encode()


@query
def op6_pseudonyms(spark, sf_dir):
    return pii.pseudonymised(_table(spark, sf_dir, "documents"), pseudonym_key(spark)).select(
        "doc_id", "text", "pii", F.size("pii").cast("long").alias("n_values"))


@query
def op10_token_counts(spark, sf_dir):
    return tokencount.document_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def quality_model(spark, sf_dir):
    """The quality classifier, fitted on the labelled documents outside the held-out third."""
    labels = _table(spark, sf_dir, "labels").where("crc32(string(doc_id)) % 3 <> 1")
    return quality.train(_table(spark, sf_dir, "documents"), labels.select("doc_id", F.col("quality").alias("label")))


@query
def op5_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return quality.scored(docs, quality_model(spark, sf_dir)).select(
        "doc_id", F.expr("coalesce(crc32(string(doc_id)) % 3 = 1, false)").alias("held_out"), "score", "predicted")


@query
def op2_lm_scores(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = F.expr("coalesce(crc32(string(doc_id)) % 5 = 1, false)")
    model, counts = lm.train(docs.where(~held_out))
    return lm.scored(docs, model, counts).withColumn("held_out", held_out)


@query
def op4_fingerprints(spark, sf_dir):
    return fingerprint.edited_fingerprints(_table(spark, sf_dir, "documents"))


@query
def op1_repeated_passages(spark, sf_dir):
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


@query
def op11_license_scans(spark, sf_dir):
    return licenses.digest(licenses.scanned(_table(spark, sf_dir, "documents")))


# the 256 steps of a CRC-32 over one byte
_CRC_STEPS = """steps AS (
  SELECT list(v ORDER BY i) AS crc_of FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
    FROM range(256) r(i)))"""


@query
def op12_spelling_variants(spark, sf_dir):
    return variants.spelling_variants(_table(spark, sf_dir, "documents"), drop=31)


ORACLE["op12_spelling_variants"] = r"""
WITH RECURSIVE """ + _CRC_STEPS + r""",
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[a-zÀ-ÿ]+')) AS w
  FROM documents WHERE text IS NOT NULL),
per AS (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 7 GROUP BY ALL),
bytes AS (
  SELECT doc_id, w, n, list_transform(range(len(h) // 2), lambda i: CAST(('0x' || h[2 * i + 1:2 * i + 2]) AS BIGINT)) AS b
  FROM (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS h FROM per)),
hashed AS (
  SELECT w, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, crc_of[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM bytes, steps),
misspelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n
  FROM hashed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM misspelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
links AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON w.word = c.cut
  UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON w.word = c.cut),
ranked AS (
  SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place
  FROM links),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
         CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN (SELECT word, n_near, other, other_n FROM ranked WHERE place = 1) USING (word)),
paths AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT p.word, f.form FROM paths p JOIN forms f ON f.word = p.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, p.root, f.n, f.n_near, f.form_n
FROM forms f JOIN paths p USING (word) JOIN forms e ON e.word = p.root WHERE e.form IS NULL
"""


@query
def op13_importance_resampling(spark, sf_dir):
    return importance.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


ORACLE["op13_importance_resampling"] = r"""
WITH """ + _CRC_STEPS + r""",
words AS (
  SELECT kind, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT 'raw' AS kind, doc_id AS id, text FROM documents
        UNION ALL SELECT 'target', item_id, text FROM benchmark)),
per AS (SELECT kind, id, w, count(*) AS n FROM words GROUP BY ALL),
bytes AS (
  SELECT w, list_transform(range(len(h) // 2), lambda i: CAST(('0x' || h[2 * i + 1:2 * i + 2]) AS BIGINT)) AS b
  FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words))),
buckets AS (
  SELECT w, xor(list_reduce(b, lambda c, x: xor(c >> 8, crc_of[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM bytes, steps),
tallies AS (
  SELECT b AS bucket, coalesce(sum(n) FILTER (kind = 'raw'), 0) AS s, coalesce(sum(n) FILTER (kind = 'target'), 0) AS t
  FROM range(10000) r(b) LEFT JOIN (SELECT bucket, kind, n FROM per JOIN buckets USING (w)) ON bucket = b GROUP BY b),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE)
                                      / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM tallies),
weights AS (
  SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * g) AS BIGINT) AS weight
  FROM per JOIN buckets USING (w) JOIN gain USING (bucket) WHERE kind = 'raw' GROUP BY id),
scores AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || sha256('2024:' || doc_id)[1:8]) AS BIGINT) + 0.5)
                                                          / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights ON id = doc_id),
places AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS long_enough
  FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * long_enough // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (doc_id)
"""
