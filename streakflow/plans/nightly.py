"""Nightly reconciliation, and the F14 anomaly log over one day's data.

Everything is derived again from the event log (the source of truth) and
joined to the stored state per user; the outputs are frames for the caller
to write (corrections, audit rows, alerts), no driver-side loop.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from streakflow.config import DEFAULT_LIMITS, Limits
from streakflow.operators import anomaly, reconcile, rollups, streaks
from streakflow.operators.windows import hot_keys


@dataclass
class Reconciliation:
    drift: DataFrame            # D6 + D13 classified
    corrections: DataFrame      # D13 auto-fixes
    audit: DataFrame            # D13/F15 audit rows of the fixes
    points: DataFrame           # D7
    streak_mismatch: DataFrame  # D8
    missing_days: DataFrame     # D9
    orphan_days: DataFrame      # D10


def nightly_reconcile(events: DataFrame, daily: DataFrame, stored: DataFrame, at,
                      limits: Limits = DEFAULT_LIMITS) -> Reconciliation:
    """Compare stored streaks/balances and daily rows with the log."""
    truth_daily = rollups.daily_activity(events)
    recomputed = streaks.streaks(truth_daily)
    drift = reconcile.classify_drift(reconcile.streak_drift(recomputed, stored), limits)
    return Reconciliation(
        drift=drift,
        corrections=reconcile.corrections(drift),
        audit=reconcile.correction_audit(drift, at, limits),
        points=reconcile.reconcile_points(events, stored),
        streak_mismatch=reconcile.reconcile_streaks(daily, stored),
        missing_days=reconcile.missing_activity(events, daily),
        orphan_days=reconcile.orphan_activity(daily, events),
    )


def anomaly_findings(valid_attempts: DataFrame, verdicts: DataFrame, accepted: DataFrame, curated: DataFrame,
                     streak_updates: DataFrame, attempts: DataFrame, limits: Limits = DEFAULT_LIMITS,
                     spike_limits: Limits | None = None) -> DataFrame:
    """rule rows of F8a, F12, F7, F9, F10, F11 and F13 in one log."""
    spike_limits = spike_limits or limits
    dense = hot_keys(accepted, ["user_id"], "created_at")
    if "attempts_last_hour" in valid_attempts.columns:  # the ingest plan has counted them
        rate = valid_attempts.where(F.col("attempts_last_hour") > limits.rate_limit)
    else:
        rate = anomaly.rate_flag(valid_attempts, limits, tie="row_id", dense=dense).where("rate_limited")
    tz = anomaly.abusive_changes(accepted, limits, dense=dense)
    jumps = streaks.streak_jumps(streak_updates, order_col="updated_on")
    midnight = anomaly.midnight_exploit(accepted, limits, dense=dense)
    spikes = anomaly.points_spike(curated, spike_limits)
    dups = anomaly.duplicate_keys(attempts, limits)
    return anomaly.anomaly_log(
        anomaly.log_rows(rate, "rate_limit", F.col("created_at"), F.col("attempts_last_hour")),
        anomaly.log_rows(anomaly.impossible_timestamps(verdicts), "impossible_timestamp",
                         F.col("created_at"), F.col("reason")),
        anomaly.log_rows(tz, "timezone_abuse", F.col("created_at"), F.col("timezone")),
        anomaly.log_rows(jumps, "streak_jump", F.col("updated_on"), F.col("step")),
        anomaly.log_rows(midnight, "midnight_exploit", F.col("created_at"),
                         F.concat_ws("->", "previous_timezone", "timezone")),
        anomaly.log_rows(spikes, "points_spike", F.col("hour"), F.col("hour_points")),
        anomaly.log_rows(dups, "duplicate_pattern", F.col("first_seen"), F.col("attempts")),
    )
