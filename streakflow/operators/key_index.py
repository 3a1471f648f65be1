"""Key index of the merge: which dates a key has rows on, without reading the fact.

A narrow table (key, date), filed under a bucket of the key's hash and sorted by key. A merge
appends its keys before it writes the fact, and nothing is ever taken out, so at every moment,
also after a crash, the index names every date on which a key lies (and perhaps a date that it
has left: that date is then rewritten with the rows it has). A batch that comes again appends
its keys again; ``compact`` removes what is there twice.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streakflow.config import checkpoint_dir
from streakflow.sources import sinks

BUCKETS = 256


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _narrow(rows: DataFrame, key: str, date_col: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).select(key, date_col).distinct().withColumn("bucket", bucket_of(key))


def _write(rows: DataFrame, path: str, key: str, mode: str) -> None:
    rows.repartition("bucket").sortWithinPartitions("bucket", key).write.mode(mode) \
        .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def add_keys(rows: DataFrame, path: str, key: str = "idempotency_key", date_col: str = "event_date") -> None:
    """Files the keys of ``rows`` (null keys are never looked up, so they are left out)."""
    _write(_narrow(rows, key, date_col), path, key, "append")


def dates_of(batch: DataFrame, path: str, key: str = "idempotency_key", date_col: str = "event_date") -> DataFrame:
    """The dates on which keys of ``batch`` have rows. Only the batch's buckets are read."""
    keys = batch.where(F.col(key).isNotNull()).select(key).distinct().withColumn("bucket", bucket_of(key))
    buckets = [r.bucket for r in keys.select("bucket").distinct().toLocalIterator()]  # at most BUCKETS numbers
    index = batch.sparkSession.read.parquet(path).where(F.col("bucket").isin(buckets))
    return index.join(keys, ["bucket", key], "left_semi").select(date_col).distinct()


def compact(spark: SparkSession, path: str, key: str = "idempotency_key") -> None:
    """Rewrites every bucket without repeated rows; run twice, it changes nothing more."""
    checkpoint_dir(spark)
    _write(spark.read.parquet(path).distinct().checkpoint(eager=True), path, key, "overwrite")


def exists(spark: SparkSession, path: str) -> bool:
    return sinks.table_exists(spark, path)
