"""The registered queries of the training-data operators and their DuckDB twins.

Each query reads its whole table, applies one operator with production parameters
and derives the contract's columns from the operator's output."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from streakflow.llm import bpe_codec, decontaminate, exact_dedup, html_extract, jaccard_join, ns_clusters, packing, shard_ring, suffix_dedup, token_align, token_count, toxicity, url_filter

from streakflow.llm.ns_clusters_sql import rounds_sql


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_codec.encode(_table(spark, sf_dir, "documents"), decoded="decoded")
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=100)
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = html_extract.main_text(pages, html_extract.fit(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(_table(spark, sf_dir, "pages"), url_filter.SITE_RULES + url_filter.PATTERN_RULES)
    return judged.select("page_id", "host", "path", F.when(F.col("rule_rank") == 1, F.col("rule")).alias("rule"), "verdict")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op8_shard_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_ring.shard_documents(_table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_count.count_tokens(_table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), width=4, threshold=85)


def op11_ns_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ns_clusters.clustered(_table(spark, sf_dir, "embeddings"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_html_text": op4_html_text,
    "op5_url_filter": op5_url_filter,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_shard_ring": op8_shard_ring,
    "op9_token_count": op9_token_count,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_ns_clusters": op11_ns_clusters,
    "op12_packing": op12_packing,
    "op13_token_align": op13_token_align,
}

ORACLE: dict[str, str] = {
    "op11_ns_clusters": rounds_sql(),
    "op5_url_filter": r"""
        WITH rules(host_rule, path_rule, verdict) AS (VALUES
                ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail
                 FROM pages),
        cut AS (SELECT page_id, translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                          'abcdefghijklmnopqrstuvwxyz') AS host,
                       regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        fits AS (SELECT c.*, host_rule || path_rule AS rule, r.verdict,
                        row_number() OVER (PARTITION BY page_id ORDER BY length(host_rule || path_rule) DESC) AS place
                 FROM cut c LEFT JOIN rules r
                 ON (c.host = host_rule OR ends_with(c.host, '.' || host_rule)) AND starts_with(c.path, path_rule))
        SELECT page_id, host, path, rule,
               coalesce(verdict, CASE WHEN regexp_matches(host || path,
                   '(^|[^A-Za-z0-9])(adult|casino|pills|porn|viagra|xxx)($|[^A-Za-z0-9])') THEN 'block' ELSE 'allow' END) AS verdict
        FROM fits WHERE place = 1""",
    "op6_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(body) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY body)""",
}
