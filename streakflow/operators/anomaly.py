"""Anomaly rules over the event log.

Rules that look at a user's previous event or trailing window use the
bucketed helpers of ``windows`` so a very active user is still processed by
many tasks. Each rule returns rows; ``anomaly_log`` unions them into one
typed log.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from streakflow.config import DEFAULT_LIMITS, Limits
from streakflow.functions.timefns import local_time
from streakflow.operators.windows import DAY_US, HOUR_US, previous_value, trailing_sum


def timezone_changes(events: DataFrame, ts: str = "created_at", tie: str = "event_id",
                     zone: str = "timezone", dense: DataFrame | None = None) -> DataFrame:
    """one row per event whose zone differs from the user's previous
    event's zone. ``dense``: users with very many events in a day (``dense_keys``)."""
    prev = previous_value(events, ["user_id"], ts, tie, zone, out="previous_timezone", dense=dense)
    return prev.where(F.col("previous_timezone").isNotNull() & (F.col(zone) != F.col("previous_timezone")))


def timezone_abuse(events: DataFrame, limits: Limits = DEFAULT_LIMITS, ts: str = "created_at",
                   tie: str = "event_id", zone: str = "timezone", where: Column | None = None,
                   dense: DataFrame | None = None, whole: bool = False) -> DataFrame:
    """F7 (rule form): adds ``tz_changed`` and ``tz_abuse``. An event that
    changes the zone is abuse when at least ``tz_change_limit`` changes
    happened in the trailing ``tz_window_hours`` before it (the change of
    the event itself not counted). With ``where`` only rows meeting it take
    part (others get false). ``whole``: no user has more events than a task may hold
    (``light_keys``)."""
    cand = F.lit(True) if where is None else where
    if whole:  # one number orders both windows, so that one sort serves them
        events, ts = events.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp"))), "_us"
    prev = previous_value(events, ["user_id"], ts, tie, zone, out="_prev_zone", where=cand, dense=dense, whole=whole)
    changed = cand & F.coalesce(F.col(zone) != F.col("_prev_zone"), F.lit(False))
    flagged = prev.withColumn("tz_changed", changed)
    width = limits.tz_window_hours * HOUR_US
    counted = trailing_sum(flagged, ["user_id"], ts, tie, width, value=F.col("tz_changed").cast("long"),
                           out="_recent_changes", include_current=False, dense=dense, whole=whole)
    return (counted.withColumn("tz_abuse", F.col("tz_changed") & (F.col("_recent_changes") >= limits.tz_change_limit))
                   .drop("_prev_zone", "_recent_changes", "_us"))


def abusive_changes(events: DataFrame, limits: Limits = DEFAULT_LIMITS, ts: str = "created_at",
                    tie: str = "event_id", zone: str = "timezone", dense: DataFrame | None = None) -> DataFrame:
    """F7 (rule form), only the events that are abuse. The rule counts zone changes at zone
    changes, so no other row enters the trailing window."""
    changes = timezone_changes(events, ts, tie, zone, dense).drop("previous_timezone")
    counted = trailing_sum(changes, ["user_id"], ts, tie, limits.tz_window_hours * HOUR_US,
                           out="_recent_changes", include_current=False, dense=dense)
    return counted.where(F.col("_recent_changes") >= limits.tz_change_limit).drop("_recent_changes")


def rate_flag(events: DataFrame, limits: Limits = DEFAULT_LIMITS, ts: str = "created_at",
              tie: str = "event_id", dense: DataFrame | None = None) -> DataFrame:
    """F8a (rule form): ``attempts_last_hour`` counts the user's attempts in
    the trailing window up to and including this one; ``rate_limited`` when
    it exceeds the limit."""
    width = limits.rate_window_seconds * 1_000_000
    counted = trailing_sum(events, ["user_id"], ts, tie, width, out="attempts_last_hour", bucket_us=DAY_US, dense=dense)
    return counted.withColumn("rate_limited", F.col("attempts_last_hour") > limits.rate_limit)


def midnight_exploit(events: DataFrame, limits: Limits = DEFAULT_LIMITS, ts: str = "created_at",
                     tie: str = "event_id", zone: str = "timezone", dense: DataFrame | None = None) -> DataFrame:
    """an event in the first ``midnight_minutes`` of a local day whose
    previous event was in the last ``midnight_minutes`` of the previous
    local day in another zone (23:59 in one zone, 00:01 next day in another)."""
    local = local_time(F.col(ts), F.col(zone))
    with_local = events.withColumn("_here", F.struct(F.col(zone).alias("zone"), local.alias("local_ts")))
    prev = previous_value(with_local, ["user_id"], ts, tie, "_here", out="_before", dense=dense)
    m = limits.midnight_minutes
    minute_of_day = lambda c: F.hour(c) * 60 + F.minute(c)
    cur_ts, prev_ts = F.col("_here.local_ts"), F.col("_before.local_ts")
    hit = ((F.col("_before.zone") != F.col(zone))
           & (minute_of_day(prev_ts) >= 24 * 60 - m)
           & (minute_of_day(cur_ts) < m)
           & (F.to_date(cur_ts) == F.date_add(F.to_date(prev_ts), 1)))
    return (prev.where(hit)
                .withColumn("previous_timezone", F.col("_before.zone"))
                .withColumn("previous_local_ts", prev_ts)
                .withColumn("local_ts", cur_ts)
                .drop("_here", "_before"))


def points_spike(events: DataFrame, limits: Limits = DEFAULT_LIMITS, ts: str = "created_at") -> DataFrame:
    """clock hours (UTC) whose points exceed ``spike_factor`` x the
    user's mean points per active UTC day (that day included). Two partial
    aggregates and a join on user; no per-event window."""
    hourly = events.groupBy("user_id", F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
        F.sum("points_awarded").cast("long").alias("hour_points"))
    daily = events.groupBy("user_id", F.to_date(F.col(ts)).alias("day")).agg(
        F.sum("points_awarded").alias("day_points"))
    mean = daily.groupBy("user_id").agg(F.avg("day_points").alias("daily_avg"))
    return (hourly.join(mean, "user_id")
                  .where(F.col("hour_points") > F.lit(limits.spike_factor) * F.col("daily_avg")))


def impossible_timestamps(verdicts: DataFrame) -> DataFrame:
    """attempts rejected for a timestamp outside the accepted window."""
    return verdicts.where(F.col("reason").isin(
        "client_timestamp is too far in the future", "client_timestamp is too far in the past"))


def duplicate_keys(attempts: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """idempotency keys sent at least ``duplicate_pattern_min`` times."""
    return (attempts.where(F.col("idempotency_key").isNotNull())
            .groupBy("user_id", "idempotency_key").agg(
                F.count(F.lit(1)).alias("attempts"), F.min("received_at").alias("first_seen"))
            .where(F.col("attempts") >= limits.duplicate_pattern_min))


def duplicate_share(attempts: DataFrame) -> DataFrame:
    """per user, attempts and the share that repeated an earlier key."""
    per_key = attempts.groupBy("user_id", "idempotency_key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("user_id").agg(
        F.sum("n").cast("long").alias("attempts"),
        (F.sum("n") - F.count(F.lit(1))).cast("long").alias("repeats"),
    ).withColumn("repeat_share", F.col("repeats") / F.col("attempts"))


# Severity and action of each rule (rule table of the design).
RULES = {
    "rate_limit": ("Medium", "throttle"),
    "impossible_timestamp": ("High", "reject"),
    "timezone_abuse": ("High", "flag_for_review"),
    "streak_jump": ("Critical", "block_update"),
    "midnight_exploit": ("High", "server_side_tz"),
    "points_spike": ("Medium", "queue_for_review"),
    "duplicate_pattern": ("Medium", "flag_for_review"),
}


def log_rows(df: DataFrame, rule: str, at, detail) -> DataFrame:
    """Shape one rule's findings as anomaly-log rows."""
    severity, action = RULES[rule]
    return df.select(F.lit(rule).alias("rule"), F.col("user_id"), at.cast("timestamp").alias("at"),
                     F.lit(severity).alias("severity"), F.lit(action).alias("action"),
                     detail.cast("string").alias("detail"))


def anomaly_log(*parts: DataFrame) -> DataFrame:
    """union of typed rule rows."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
