"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from batchgate.llm import (
    exact_dedup,
    hadamard_codes,
    hnsw,
    language_mixture,
    license_scan,
    lm_scoring,
    ngram_join,
    packing,
    prefix_table,
    simhash,
    span_alignment,
    token_store,
    warc,
)
from batchgate.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_scoring.score(table(spark, sf_dir, "documents"), good)


def op2_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_zip_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc.write_packages(table(spark, sf_dir, "pages"))
    return warc.read_packages(spark, packages).drop("url")


def op4_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"), size=3, part=90, whole=100)


def op5_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixture.identify(table(spark, sf_dir, "documents"))


def op7_perfect_hash_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = token_store.write_store(
        table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json")
    )
    return token_store.read_store(spark, store).withColumnRenamed("_key", "doc_id").drop("occurrence")


def op8_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
),
d AS (
  SELECT page_id, octet_length(b) AS n, sha1(b) AS h, max(page_id) OVER (PARTITION BY b) AS best FROM p
)
SELECT page_id,
       n AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + (((('0x' || substr(h, 1 + 5 * (i // 4), 5))::INT >> (5 * (3 - i % 4))) & 31)), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM d
"""

OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id,
         list_filter(
           regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x20\x09-\x0D]+'),
           lambda x: x <> '') AS ws
  FROM documents
),
s AS (
  SELECT doc_id,
         CASE WHEN len(ws) = 0 THEN []
              WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
              ELSE list_distinct(list_transform(range(1, len(ws) - 1),
                     lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh
  FROM w
),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM s
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, len(s.sh) AS n_shingles, min(r.y) AS component_id
FROM s JOIN reach r ON s.doc_id = r.x GROUP BY s.doc_id, len(s.sh)
"""

OP9_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n
"""


# One round of the codebooks: parts take their nearest entry, entries become floored means.
_OP11_NEAREST = """
nearest{r} AS (
  SELECT vec_id, n.p, any_value(n.x) AS x,
         min({{'d': list_sum(list_transform(list_zip(n.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'k': b.k}}) AS m
  FROM parts n JOIN book{r} b ON n.p = b.p
  GROUP BY vec_id, n.p
)"""
_OP11_ROUND = _OP11_NEAREST + """,
sums{r} AS (
  SELECT p, k, list(CAST(floor(s / c) AS BIGINT) ORDER BY i) AS x
  FROM (SELECT p, m.k AS k, i, sum(x[i])::DOUBLE AS s, count(*) AS c
        FROM nearest{r}, width, range(1, 1 + w) t(i) GROUP BY p, m.k, i)
  GROUP BY p, k
),
book{n} AS (
  SELECT b.p, b.k, coalesce(s.x, b.x) AS x FROM book{r} b LEFT JOIN sums{r} s ON b.p = s.p AND b.k = s.k
)"""
OP11_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
width AS (SELECT max(len(v)) // 16 AS w FROM kept),
parts AS (
  SELECT vec_id, p, v[p * w + 1 : p * w + w] AS x FROM kept, width, range(16) r(p)
),
book0 AS (
  SELECT p, k, x
  FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM kept ORDER BY vec_id LIMIT 64)
  USING (vec_id)
),
{_OP11_ROUND.format(r=0, n=1)},
{_OP11_ROUND.format(r=1, n=2)},
{_OP11_NEAREST.format(r=2)},
codes AS (
  SELECT vec_id, string_agg(printf('%02x', m.k), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM nearest2 GROUP BY vec_id
),
digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id), digest
"""


def op10_prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_table.round_trip(
        table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model")
    )


def op11_hadamard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hadamard_codes.encode(table(spark, sf_dir, "embeddings"))


def op12_span_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_alignment.align(
        table(spark, sf_dir, "documents"),
        tokenizer_file("byte_bpe_50k.json"),
        tokenizer_file("piece_bpe_32k.model"),
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"), size=3, radius=2)


def queries() -> dict[str, Query]:
    return {
        "op1_cross_entropy_difference": op1_cross_entropy_difference,
        "op2_license_index": op2_license_index,
        "op3_zip_packages": op3_zip_packages,
        "op4_signature_tree_join": op4_signature_tree_join,
        "op5_hnsw": op5_hnsw,
        "op6_language_mixture": op6_language_mixture,
        "op7_perfect_hash_store": op7_perfect_hash_store,
        "op8_histogram_packing": op8_histogram_packing,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_prefix_table": op10_prefix_table,
        "op11_hadamard_codes": op11_hadamard_codes,
        "op12_span_alignment": op12_span_alignment,
        "op13_simhash": op13_simhash,
    }


def oracle_sql() -> dict[str, str]:
    templates = license_scan.TEMPLATES
    op2_sql = license_scan.scan_sql(templates, license_scan.listed_postings(templates))
    return {
        "op2_license_index": op2_sql,
        "op3_zip_packages": OP3_SQL,
        "op4_signature_tree_join": OP4_SQL,
        "op9_exact_dedup": OP9_SQL,
        "op11_hadamard_codes": OP11_SQL,
    }
