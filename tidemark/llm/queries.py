"""The registered queries of this subpackage: each applies its operator, with
production parameters, to the whole table, and derives the digest columns of
its contract from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (exact_dedup, html_extract, importance, language_id, license_scan, mixing, near_dup, packing,
                          pieces, sharding, token_counts, topk_search, vector_codes)
from tidemark.session import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.replicate(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.round("rate", 6).alias("rate"), F.col("copies").cast("int").alias("copies"),
                        F.col("copy").cast("int").alias("copy"), "shuffle_key",
                        F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.document_licences(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=16)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_classes(table(spark, sf_dir, "documents"))


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode_decode(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                        F.sha2("ends", 256).alias("spans_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_exact_dedup, op3_language_id, op4_mixing, op5_html_extraction, op6_license_scan, op7_sharding,
    op8_token_counts, op9_near_dedup, op10_topk_search, op11_importance_resampling, op12_piece_encoding,
    op13_vector_codes)}

ORACLES = {
    "op2_exact_dedup": """
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS text,
             regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents)
WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)""",
    "op4_mixing": mixing.ORACLE_SQL,
    "op11_importance_resampling": importance.ORACLE_SQL,
    "op13_vector_codes": vector_codes.ORACLE_SQL,
    "op10_topk_search": """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM valid q JOIN valid c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10""",
}
