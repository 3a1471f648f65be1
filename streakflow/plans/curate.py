"""Raw -> curated batch (events, daily summaries, anomalies, metrics).

The reference recomputes the same lineage for up to ten actions. Here the
deduplicated and flagged branch is computed once (persisted), counts ride
along as ``observe`` metrics, and the three writes are the only actions.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from streakflow.config import DEFAULT_LIMITS, Limits, checkpoint_dir
from streakflow.operators import dedup, rollups, validate
from streakflow.sources import readers, sinks, versions


@dataclass
class Curated:
    flagged: DataFrame      # deduplicated, typed, with is_anomalous
    events: DataFrame       # clean and enriched
    summaries: DataFrame
    anomalies: DataFrame


def curate(raw: DataFrame, dim: DataFrame, limits: Limits = DEFAULT_LIMITS) -> Curated:
    """A1 -> B1 -> D1 -> B10 -> B9 -> D5 -> E1 as one lazy plan."""
    kept = validate.drop_null_keys(raw)
    deduped = dedup.dedup_first(kept, "idempotency_key", ("created_at", "event_id"))
    return of_flagged(validate.flag_point_range(validate.enforce_types(deduped), limits), dim)


def of_flagged(flagged: DataFrame, dim: DataFrame) -> Curated:
    """The tables that follow from the flagged rows (of a plan or of a written table)."""
    clean, anomalies = validate.split_anomalous(flagged)
    events = dedup.enrich(clean, dim)
    summaries = rollups.daily_summaries(clean, dim)
    return Curated(flagged, events, summaries, anomalies)


def quality_funnel(raw: DataFrame, dim: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Row counts raw -> deduplicated -> anomaly-free -> enriched (no driver-side
    counting). What the later stages count is written once, two columns wide."""
    flagged = sinks.staged(curate(raw, dim, limits).flagged.select("user_id", "is_anomalous"))
    enriched = dedup.enrich(flagged.where(~F.col("is_anomalous")), dim)
    one = F.count(F.lit(1))
    kept = flagged.agg(F.array(one, F.count_if(~F.col("is_anomalous"))).alias("n"))
    kept = kept.select(F.posexplode("n").alias("at", "row_count"))
    return (raw.agg(one.alias("row_count")).select(F.lit(1).alias("stage_no"), F.lit("raw").alias("stage"), "row_count")
            .unionByName(kept.select((F.col("at") + 2).alias("stage_no"), F.when(F.col("at") == 0, F.lit("deduplicated"))
                                     .otherwise(F.lit("anomaly_free")).alias("stage"), "row_count"))
            .unionByName(enriched.agg(one.alias("row_count")).select(F.lit(4).alias("stage_no"), F.lit("enriched").alias("stage"), "row_count")))


def run_curate(raw: DataFrame, dim: DataFrame, curated_path: str, limits: Limits = DEFAULT_LIMITS) -> dict:
    """Execute P1 and write the three curated tables. Returns the E10 run
    metrics gathered by ``observe`` during the writes (no extra jobs)."""
    spark = raw.sparkSession
    checkpoint_dir(spark)
    obs_raw, obs_flag = Observation("raw"), Observation("flagged")
    raw_o = raw.observe(obs_raw, F.count(F.lit(1)).alias("records_read"))
    c = curate(raw_o, dim, limits)
    flagged = c.flagged.observe(obs_flag, F.count(F.lit(1)).alias("deduplicated"),
                                F.count_if("is_anomalous").alias("anomalies"))
    flagged = flagged.persist()
    try:
        clean, anomalies = validate.split_anomalous(flagged)
        sinks.write_anomalies(anomalies, f"{curated_path}/anomalies")
        sinks.write_curated_events(dedup.enrich(clean, dim), f"{curated_path}/bp_events")
        sinks.write_daily_summaries(rollups.daily_summaries(clean, dim), f"{curated_path}/daily_summaries")
        m_raw, m_flag = obs_raw.get, obs_flag.get
    finally:
        flagged.unpersist()
    return {
        "records_read": m_raw["records_read"],
        "duplicates_removed": m_raw["records_read"] - m_flag["deduplicated"],
        "anomalies": m_flag["anomalies"],
        "curated_events": m_flag["deduplicated"] - m_flag["anomalies"],
    }


def rebuilt(new: DataFrame, stored: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The dates that a batch of flagged rows changes, and all their deduplicated rows,
    stored ones included; both are cut from what they were read from."""
    key, order = "idempotency_key", ("created_at", "event_id")
    dates = new.select("event_date")
    if stored is not None:
        keys = new.select(F.col(key).alias("_key")).distinct()
        again = stored.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        dates = dates.unionByName(again.select("event_date"))
    dates = dates.distinct().checkpoint(eager=True)
    rows = new
    if stored is not None:
        same_date = stored["event_date"].eqNullSafe(F.col("_date"))
        rows = new.unionByName(stored.join(dates.select(F.col("event_date").alias("_date")), same_date, "left_semi"))
    return dates, dedup.dedup_first(rows, key, order).checkpoint(eager=True)


def curate_new_hours(spark: SparkSession, raw_path: str, dim: DataFrame, root: str, limits: Limits = DEFAULT_LIMITS) -> dict:
    """A9 + P1: curates the raw hours that the ledger does not have yet, and records
    them in the same commit as the three tables (``versions``). Hours come from listing
    folders, not from rows; only the new ones are read. An hour counts as complete once
    it is recorded. Without new hours nothing is committed. Returns the manifest."""
    checkpoint_dir(spark)
    before = versions.manifest(spark, root)
    hours = readers.listed_hours(spark, raw_path)
    ledger = versions.read_ledger(spark, root, before)
    new_hours = hours if ledger is None else readers.new_partitions(hours, ledger)
    todo = new_hours.collect()  # one row an hour
    if not todo:
        return before
    raw_new = spark.read.option("basePath", raw_path).parquet(*[r.folder for r in todo]).drop("year", "month", "day", "hour")
    new = validate.flag_point_range(validate.enforce_types(validate.drop_null_keys(raw_new)), limits)
    stored = None
    for name, anomalous in (("bp_events", False), ("anomalies", True)):
        part = versions.read(spark, root, before, name)
        if part is not None:
            part = part.withColumn("is_anomalous", F.lit(anomalous)).select(*new.columns)
            stored = part if stored is None else stored.unionByName(part)
    dates, flagged = rebuilt(new, stored)
    c = of_flagged(flagged, dim)
    touched = {versions.folder_of("event_date", r[0]) for r in dates.toLocalIterator()}  # dates, as the manifest has them
    done = spark.createDataFrame(sorted((r.year, r.month, r.day, r.hour) for r in todo), "year int, month int, day int, hour int")
    return versions.commit(spark, root, before, {"anomalies": c.anomalies, "bp_events": c.events, "daily_summaries": c.summaries},
                           touched, done.coalesce(1))


def curate_increment(raw_new: DataFrame, dim: DataFrame, curated_path: str,
                     limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Incremental P1. Returns the rebuilt dates (``event_date``).

    What is stored (curated and anomalous rows) and the new rows together decide
    which row of a key is first. Every date of a raw row, and of a stored row
    whose key comes again, is rebuilt whole in all three tables. The dates follow
    from the raw batch, not from what is missing, so running a batch again, also
    after a crash between two writes, ends in the same tables. The rebuilt rows
    are cut from their lineage with ``checkpoint()`` before the overwrite, because
    the plan reads the partitions it is about to replace."""
    spark = raw_new.sparkSession
    checkpoint_dir(spark)
    events_path, summ_path, anom_path = (f"{curated_path}/bp_events", f"{curated_path}/daily_summaries",
                                         f"{curated_path}/anomalies")
    new = validate.flag_point_range(validate.enforce_types(validate.drop_null_keys(raw_new)), limits)
    stored = None
    for path, anomalous in ((events_path, False), (anom_path, True)):
        if sinks.table_exists(spark, path):
            part = spark.read.parquet(path).withColumn("is_anomalous", F.lit(anomalous)).select(*new.columns)
            stored = part if stored is None else stored.unionByName(part)
    dates, flagged = rebuilt(new, stored)
    clean, anomalies = validate.split_anomalous(flagged)
    sinks.rewrite_partitions(anomalies, dates, anom_path)
    sinks.rewrite_partitions(dedup.enrich(clean, dim), dates, events_path)
    sinks.rewrite_partitions(rollups.daily_summaries(clean, dim), dates, summ_path)
    return dates
