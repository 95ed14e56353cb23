"""The registered queries of the operators and the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontam, exact_dedup, langid, lm_score, ngram_join, oph_dedup, packing, pii, source_audit, token_store,
               toxicity, vector_codes, warc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_masked_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op2_minhash_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), n=5, similarity=0.8)


def op3_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                  end_id=0, capacity=2048)


def op4_keyed_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents"), key="a production key comes from a secret store")


def op5_progressive_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), with_digest=True)


def op6_positional_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, slack=2)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated", "n_near_items")


def op7_ranked_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op8_compression_distance_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op9_boundary_chain_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_output_code_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op11_densified_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oph_dedup.near_copies(table(spark, sf_dir, "documents"), n=3, share=(85, 100))


def op12_translate_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"), least_docs=10, top=10)


def op13_hadamard_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"), "embedding", parts=4, entries=256, rounds=4)


QUERIES = {f.__name__: f for f in (
    op1_masked_pseudo_likelihood, op2_minhash_ngram_join, op3_best_two_fit_packing, op4_keyed_pii_surrogates, op5_progressive_exact_dedup, op6_positional_index_decontamination,
    op7_ranked_token_store, op8_compression_distance_toxicity, op9_boundary_chain_warc, op10_output_code_language_id, op11_densified_minhash_dedup, op12_translate_source_audit,
    op13_hadamard_vector_codes)}

def vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """DuckDB SQL of op13: plain squared distances, every part against every entry."""
    ctes = [f"""
kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS row, * FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(NOT isfinite(x), true))) = 0)),
pieces AS (
  SELECT row, p AS part, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS piece
  FROM kept, range({parts}) AS r(p)),
b0 AS (SELECT part, row AS e, piece FROM pieces WHERE row < {entries})"""]
    for k in range(rounds + 1):
        ctes.append(f"""
a{k} AS MATERIALIZED (
  SELECT row, p.part, min({{'d': list_sum(list_transform(list_zip(p.piece, b.piece), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}}) AS best
  FROM pieces p JOIN b{k} b ON p.part = b.part GROUP BY row, p.part)""")
        if k < rounds:
            ctes.append(f"""
s{k} AS (
  SELECT part, e, pos, sum(x) AS s, count(*) AS n
  FROM (SELECT a.part, a.best.e AS e, unnest(piece) AS x, generate_subscripts(piece, 1) AS pos
        FROM a{k} a JOIN pieces p ON p.row = a.row AND p.part = a.part) GROUP BY ALL),
b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.e, coalesce(n.piece, b.piece) AS piece FROM b{k} b
  LEFT JOIN (SELECT part, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS piece FROM s{k} GROUP BY part, e) n
  ON n.part = b.part AND n.e = b.e)""")
    return f"""
WITH {",".join(ctes)},
c AS (
  SELECT row, string_agg(format('{{:02x}}', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY row),
h AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, e, pos)) AS codebooks_sha256
  FROM (SELECT part, e, unnest(piece) AS x, generate_subscripts(piece, 1) AS pos FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN c USING (row), h
"""


ORACLE_SQL = {
    "op13_hadamard_vector_codes": vector_codes_sql(),
    "op5_progressive_exact_dedup": """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id NULLS LAST) AS place,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t),
k AS (SELECT text_sha256, doc_id AS keep_id FROM r WHERE place = 1)
SELECT r.doc_id, k.keep_id, r.group_size, r.doc_id IS NOT DISTINCT FROM k.keep_id AS kept, text_sha256
FROM r JOIN k USING (text_sha256)
""",
    "op9_boundary_chain_warc": """
WITH t AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS stands FROM t)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31)
              + 1 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM stands THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM stands THEN stands END AS refers_to
FROM h
""",
    "op11_densified_minhash_dedup": r"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT row, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS grams
  FROM t),
c AS (SELECT min(row) AS class, min(doc_id) AS least, len(grams) AS n, grams FROM s WHERE len(grams) > 0 GROUP BY grams),
g AS (SELECT class, n, unnest(grams) AS gram FROM c),
e AS (
  SELECT a.class AS x, b.class AS y FROM g a JOIN g b ON a.gram = b.gram AND a.class <> b.class
  WHERE least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 85
  GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r AS (SELECT class AS x, class AS y FROM c UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
k AS (SELECT r.x AS class, min(c.least) AS component_id FROM r JOIN c ON r.y = c.class GROUP BY r.x)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, CASE WHEN len(s.grams) = 0 THEN s.doc_id ELSE k.component_id END AS component_id,
       s.doc_id IS NOT DISTINCT FROM (CASE WHEN len(s.grams) = 0 THEN s.doc_id ELSE k.component_id END) AS kept
FROM s LEFT JOIN c ON s.grams = c.grams LEFT JOIN k ON k.class = c.class
""",
    "op12_translate_source_audit": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
o AS (SELECT row, lang, source, unnest(w) AS term FROM d),
l AS (SELECT lang, term, count(*) AS in_lang FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
gs AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY ALL),
m AS (SELECT gs.lang, gs.source, l.term, coalesce(x.n, 0) AS n, l.in_lang FROM gs JOIN l USING (lang)
      LEFT JOIN x ON x.lang = gs.lang AND x.source = gs.source AND x.term = l.term),
u AS (
  SELECT *, 1 + CAST(1000000000 AS HUGEINT) * (n + 2)
              // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p,
         1 + CAST(1000000000 AS HUGEINT) * (in_lang + 2)
              // (sum(in_lang) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS q
  FROM m),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM u a JOIN u b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM gs a JOIN gs b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM u WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
  FROM (SELECT * FROM every UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
}
