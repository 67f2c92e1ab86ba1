"""The operators on the given tables, by query name, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm import bpe, katz, licenses, merkle, mixing, near, quality, sharding, substrings, topk, toxicity, variants, warc
from feira.llm.tables import table
from feira.sources.scratch import new_path

RANKS = "byte_bpe_50k.tiktoken"


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(table(spark, folder, "documents"), digest=True)


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents").select("doc_id", "text")).drop("text")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = warc.round_trip(table(spark, folder, "pages"), new_path(spark, "warc"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    return katz.scores(table(spark, folder, "documents"))


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents"))


def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mixed(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return sharding.digest(sharding.write_shards(docs, new_path(spark, "shards")))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe.digest(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_classes(table(spark, folder, "documents"))


def op10_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("q_id") % 100 == 0)


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variants(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    job.__name__: job
    for job in (
        op1_substring_dedup,
        op2_quality_rules,
        op3_warc,
        op4_katz_backoff,
        op5_licenses,
        op6_source_mix,
        op7_shards,
        op8_byte_bpe,
        op9_near_dedup,
        op10_exact_top_k,
        op11_toxicity,
        op12_merkle_manifest,
        op13_spelling_variants,
    )
}

SUBSTRING_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS w FROM places),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS first FROM windows) AS f
  WHERE doc_id > first
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM later),
lost AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
singles AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (
  SELECT s.doc_id, string_agg(s.w, ' ' ORDER BY s.p) AS words
  FROM singles AS s LEFT JOIN gone AS g ON g.doc_id = s.doc_id AND g.p = s.p
  WHERE g.p IS NULL GROUP BY s.doc_id
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(l.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.words, '')) AS kept_sha256
FROM d LEFT JOIN lost AS l USING (doc_id) LEFT JOIN kept AS k USING (doc_id)"""
WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS digest FROM pages
),
h AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS head FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM h"""
TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS c FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
terms AS (SELECT vec_id, unnest(c) AS x, unnest(range(1, len(c) + 1)) AS t FROM v),
scores AS (
  SELECT q.vec_id AS query_id, d.vec_id, sum(q.x * d.x)::BIGINT AS score
  FROM terms AS q JOIN terms AS d ON q.t = d.t AND q.vec_id <> d.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY ALL
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) AS r
WHERE rank <= 10"""
ORACLE: dict[str, str] = {
    "op1_substring_dedup": SUBSTRING_SQL,
    "op2_quality_rules": quality.ORACLE,
    "op3_warc": WARC_SQL,
    "op10_exact_top_k": TOP_K_SQL,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_spelling_variants": variants.ORACLE,
}
