"""Curated lake -> warehouse tables and views (A10, A11, A13, D12,
E4-E6, E11).

The fact table is Parquet partitioned by ``event_date``. A refresh stages
one curated date, merges it by idempotency key and reads and rewrites only the
affected dates: the staged date plus the dates of replaced rows (a re-sent
key may move between dates), which the key index beside the fact names. The merged partitions are checkpointed before
the overwrite because the plan reads the table it replaces.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from streakflow import schemas
from streakflow.config import checkpoint_dir
from streakflow.operators import key_index, quality, warehouse
from streakflow.sources import readers, sinks


@dataclass
class Views:
    weekly_streak_stats: DataFrame
    streak_distribution: DataFrame
    event_type_performance: DataFrame
    checks: DataFrame


def refresh_fact(spark: SparkSession, curated_events_path: str, fact_path: str, event_date, loaded_at) -> DataFrame:
    """Merge one curated date into the fact table; returns the staged rows."""
    checkpoint_dir(spark)
    stg = readers.stage_partition(spark.read.parquet(curated_events_path), event_date, loaded_at)
    index = f"{fact_path.rstrip('/')}_keys"
    if sinks.table_exists(spark, fact_path):
        fact = spark.read.parquet(fact_path).select(*schemas.FACT_BP_EVENTS.fieldNames())
        if not key_index.exists(spark, index):  # a fact from before the index
            key_index.add_keys(fact, index)
        dates = stg.select("event_date").unionByName(key_index.dates_of(stg, index)).distinct().checkpoint(eager=True)
        affected = [r.event_date for r in dates.toLocalIterator()]  # no more than the table has partitions
        merged = warehouse.merge_by_key(fact.where(F.col("event_date").isin(affected)), stg)
    else:
        dates = stg.select("event_date").distinct()
        merged = warehouse.merge_by_key(stg.limit(0), stg)
    merged = merged.checkpoint(eager=True)
    key_index.add_keys(stg, index)  # before the fact: the index may name too many dates, never too few
    # a key that moved may leave its old date without rows
    sinks.rewrite_partitions(merged, dates, fact_path)
    return stg


def snapshot(state: DataFrame, dim_path: str, as_of_date, loaded_at) -> None:
    """Write the streak snapshot of one date (overwrites that date)."""
    snap = readers.snapshot_streaks(state, as_of_date, loaded_at)
    sinks.write_partitioned(snap, dim_path, partition_col="snapshot_date")


def views(spark: SparkSession, fact: DataFrame, summaries: DataFrame, dim_user_streaks: DataFrame,
          round_to: int | None = None) -> Views:
    """E4-E6 over the warehouse tables and the E11 checks, also registered
    as temp views for SQL use."""
    fact.createOrReplaceTempView("fact_bp_events")
    summaries.createOrReplaceTempView("fact_daily_summaries")
    dim_user_streaks.createOrReplaceTempView("dim_user_streaks")
    checks = quality.dq_checks(
        quality.schema_check(fact, "fact_bp_events", schemas.FACT_BP_EVENTS),
        quality.non_empty(fact, "fact_bp_events"),
        quality.key_unique(fact, "fact_bp_events", ["idempotency_key"]),
        quality.key_unique(summaries, "fact_daily_summaries", ["user_id", "event_date"]),
        quality.key_unique(dim_user_streaks, "dim_user_streaks", ["user_id", "snapshot_date"]),
    )
    return Views(
        warehouse.weekly_streak_stats(summaries, round_to),
        warehouse.streak_distribution(dim_user_streaks, round_to),
        warehouse.event_type_performance(fact),
        checks,
    )
