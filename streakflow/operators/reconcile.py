"""Reconciliation of derived state with the event log.

The event log is the source of truth: streaks are recomputed from daily
activity (F2), balances from events, daily rows from events. Every check is
a join on the user (or user-day) key between two aggregates, so the shuffle
moves one row per user or user-day, never raw events.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from streakflow.config import DEFAULT_LIMITS, Limits
from streakflow.operators import rollups, streaks


def streak_drift(analytical: DataFrame, operational: DataFrame, col: str = "current_streak") -> DataFrame:
    """Users whose two layers disagree, largest drift first."""
    a = analytical.select("user_id", F.col(col).alias("analytical_streak"))
    o = operational.select("user_id", F.col(col).alias("operational_streak"))
    return (a.join(o, "user_id")
             .where(F.col("analytical_streak") != F.col("operational_streak"))
             .withColumn("drift", F.abs(F.col("analytical_streak") - F.col("operational_streak")))
             .orderBy(F.col("drift").desc(), "user_id"))


def reconcile_points(events: DataFrame, balances: DataFrame) -> DataFrame:
    """Per user, points summed from the log vs the stored balance:
    MATCH / MISMATCH (a user missing on one side counts 0 there)."""
    summed = events.groupBy("user_id").agg(F.sum("points_awarded").cast("long").alias("events_sum"))
    stored = balances.select("user_id", F.col("total_bestie_points").cast("long").alias("stored_total"))
    j = summed.join(stored, "user_id", "full")
    e, s = F.coalesce("events_sum", F.lit(0)), F.coalesce("stored_total", F.lit(0))
    return j.select("user_id", e.alias("events_sum"), s.alias("stored_total"),
                    F.when(e == s, F.lit("MATCH")).otherwise(F.lit("MISMATCH")).alias("status"))


def reconcile_streaks(daily: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored streak fields vs the ones recomputed from daily activity;
    one row per user that differs in any of them."""
    fields = ("current_streak", "longest_streak", "last_activity_date")
    rec = streaks.streaks(daily).select("user_id", *[F.col(f).alias(f"recomputed_{f}") for f in fields])
    st = stored.select("user_id", *[F.col(f).alias(f"stored_{f}") for f in fields])
    j = rec.join(st, "user_id", "full")
    differs = None
    for f in fields:
        d = ~F.col(f"recomputed_{f}").eqNullSafe(F.col(f"stored_{f}"))
        differs = d if differs is None else differs | d
    return j.where(differs)


def _day_keys(events: DataFrame) -> DataFrame:
    return events.select("user_id", "activity_date").where(F.col("activity_date").isNotNull())


def missing_activity(events: DataFrame, daily: DataFrame) -> DataFrame:
    """Daily rows that the events imply but the daily table lacks,
    computed from the events (ready to backfill)."""
    implied = rollups.daily_activity(events)
    return implied.join(daily.select("user_id", "activity_date"), ["user_id", "activity_date"], "left_anti")


def backfill_activity(events: DataFrame, daily: DataFrame) -> DataFrame:
    """The daily table with the missing days added."""
    return daily.unionByName(missing_activity(events, daily).select(*daily.columns))


def orphan_activity(daily: DataFrame, events: DataFrame) -> DataFrame:
    """Daily rows without any event on that user-day."""
    return daily.join(_day_keys(events).distinct(), ["user_id", "activity_date"], "left_anti")


def snapshot_parity(a: DataFrame, b: DataFrame, columns: Sequence[str], key: str = "user_id") -> DataFrame:
    """Per key, whether two snapshots agree (null-safe) and which
    columns differ; a key present on one side only differs in all."""
    l = a.select(key, F.lit(True).alias("_in_a"), *[F.col(c).alias(f"a_{c}") for c in columns])
    r = b.select(key, F.lit(True).alias("_in_b"), *[F.col(c).alias(f"b_{c}") for c in columns])
    j = l.join(r, key, "full")
    diffs = [F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in columns]
    return j.select(
        key,
        F.coalesce("_in_a", F.lit(False)).alias("in_a"),
        F.coalesce("_in_b", F.lit(False)).alias("in_b"),
        F.array_join(F.array_compact(F.array(*diffs)), ",").alias("differing_columns"),
    ).withColumn("parity", (F.col("differing_columns") == "") & F.col("in_a") & F.col("in_b"))


def classify_drift(drift: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Drift up to ``max_auto_fix`` is corrected automatically (the
    recomputed value wins), a larger gap raises an alert."""
    return drift.withColumn("action", F.when(F.col("drift") <= limits.max_auto_fix, F.lit("auto_fix"))
                            .otherwise(F.lit("alert")))


def corrections(classified: DataFrame) -> DataFrame:
    """State rows to write back for auto-fixable drift."""
    return classified.where(F.col("action") == "auto_fix").select(
        "user_id", F.col("analytical_streak").alias("current_streak"))


def correction_audit(classified: DataFrame, at, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """D13 + F15: one audit row per applied correction."""
    ts = F.lit(str(at)).cast("timestamp")
    fixed = classified.where(F.col("action") == "auto_fix")
    return fixed.select(
        F.sha2(F.concat_ws("|", F.lit("reconcile"), "user_id", ts.cast("string")), 256).substr(1, 32).alias("audit_id"),
        "user_id",
        F.lit("STREAK_CORRECTION").alias("action"),
        F.struct(F.col("operational_streak").alias("current_streak")).alias("old_value"),
        F.struct(F.col("analytical_streak").alias("current_streak")).alias("new_value"),
        F.lit("nightly_reconcile").alias("trigger"),
        ts.alias("timestamp"),
        (F.unix_timestamp(ts) + F.lit(limits.audit_ttl_days * 86400)).alias("ttl"),
    )
