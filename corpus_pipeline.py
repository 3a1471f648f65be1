"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written
as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streakflow.llm import bpe_codec, decontaminate, exact_dedup, jaccard_join, toxicity
from streakflow.llm.common import cut, small_side, text_of


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), out="__toxicity")
    return scored.where("__toxicity < 0.5").select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by five-word shingles at a similarity of 0.8, the row with
    the smallest id. A row is known by its id and text hash, so a repeated id takes no
    other text along; a null id comes after all others, and of rows with one id the
    smaller hash is kept. Rows that repeat an id and its text are one row."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(text_of("text")).alias("hash"))
    groups = jaccard_join.jaccard_components(docs.select(row.alias("row"), "text"), id_col="row", width=5, threshold=80)
    gone = groups.where(~F.col("row").eqNullSafe(F.col("component_id"))).select(
        F.col("row.id").alias("__gone"), F.col("row.hash").alias("__hash")).distinct()
    gone = small_side(gone)
    keyed = docs.withColumn("__own", F.xxhash64(text_of("text")))
    return keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["__gone"]) & (keyed["__own"] == gone["__hash"]), "left_anti").drop("__own")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents into which a benchmark item has leaked."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids, and the digest of what the ids decode to."""
    coded = bpe_codec.encode(docs, decoded="decoded")
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("byte_bpe", tokenize),
]

#: No SQL: a trained classifier and BPE merges stand in the way (tested by brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
