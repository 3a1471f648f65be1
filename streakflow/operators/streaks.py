"""Streaks, timelines, leaderboards, lookups.

Streaks are gaps-and-islands over distinct (user, local day) rows: within a
run of consecutive days ``day - row_number`` is constant. Per-user windows
here run over one row per active day, so their size is bounded by the
calendar, not by the event volume.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from streakflow.config import DEFAULT_LIMITS, Limits


def _islands(daily: DataFrame) -> DataFrame:
    days = daily.select("user_id", "activity_date").where(F.col("activity_date").isNotNull()).distinct()
    w = Window.partitionBy("user_id").orderBy("activity_date")
    return days.withColumn("island", F.date_sub("activity_date", F.row_number().over(w).cast("int")))


def streaks(daily: DataFrame, as_of_date: str | dt.date | None = None) -> DataFrame:
    """per user the current streak (length of the run ending on the last
    active day), longest streak, last active day, version (= number of
    active days applied) and, given ``as_of_date``, the effective streak
    (0 once a whole day has been missed)."""
    runs = _islands(daily).groupBy("user_id", "island").agg(
        F.count(F.lit(1)).alias("len"), F.max("activity_date").alias("end"))
    out = runs.groupBy("user_id").agg(
        F.max_by("len", "end").cast("long").alias("current_streak"),
        F.max("len").cast("long").alias("longest_streak"),
        F.max("end").alias("last_activity_date"),
        F.sum("len").cast("long").alias("version"),
    )
    if as_of_date is not None:
        as_of = F.lit(str(as_of_date)).cast("date")
        out = out.withColumn("effective_streak", F.when(
            F.col("last_activity_date") >= F.date_sub(as_of, 1), F.col("current_streak")).otherwise(F.lit(0).cast("long")))
    return out


def effective_streak(state: DataFrame, as_of_date) -> DataFrame:
    """Streak as a user sees it on ``as_of_date``: stored streaks never decay."""
    as_of = F.lit(str(as_of_date)).cast("date")
    return state.withColumn("effective_streak", F.when(
        F.col("last_activity_date") >= F.date_sub(as_of, 1), F.col("current_streak")).otherwise(F.lit(0).cast("long")))


def streak_timeline(daily: DataFrame) -> DataFrame:
    """running streak length on every active day."""
    isl = _islands(daily)
    w = Window.partitionBy("user_id", "island").orderBy("activity_date")
    return isl.select("user_id", "activity_date", F.row_number().over(w).cast("long").alias("streak"))


def points_timeline(events: DataFrame, date_col: str = "event_date") -> DataFrame:
    """points per user-day and their running total."""
    per_day = events.groupBy("user_id", F.col(date_col).alias("day")).agg(
        F.sum("points_awarded").cast("long").alias("day_points"))
    w = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.withColumn("cumulative_points", F.sum("day_points").over(w).cast("long"))


def leaderboard(state: DataFrame, n: int = DEFAULT_LIMITS.leaderboard_size, by: str | None = "country",
                streak_col: str = "current_streak") -> DataFrame:
    """Top ``n`` users per leaderboard partition by streak, then
    points, then user id. ``row_number() <= n`` lets Catalyst insert a
    partial WindowGroupLimit before the shuffle, so at most ``n`` rows per
    partition and map task are moved even when one partition is huge."""
    part = F.coalesce(F.col(by), F.lit("GLOBAL")) if by else F.lit("GLOBAL")
    ranked = state.withColumn("leaderboard_partition", part)
    w = Window.partitionBy("leaderboard_partition").orderBy(
        F.col(streak_col).desc_nulls_last(), F.col("total_bestie_points").desc_nulls_last(), F.col("user_id"))
    return ranked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def streak_jumps(updates: DataFrame, order_col: str = "version", max_step: int = 1) -> DataFrame:
    """updates whose streak rose by more than ``max_step`` over the
    user's previous update."""
    w = Window.partitionBy("user_id").orderBy(order_col)
    prev = F.lag("current_streak").over(w)
    return (updates.withColumn("previous_streak", prev)
                   .withColumn("step", F.col("current_streak") - F.col("previous_streak"))
                   .where(F.col("step") > max_step))


def streak_audit(timeline: DataFrame, limits: Limits = DEFAULT_LIMITS, trigger: str = "streak_recompute") -> DataFrame:
    """one audit row per streak change: old and new value, a stable id
    and a 365-day expiry (the day's noon UTC stands in for the write time)."""
    w = Window.partitionBy("user_id").orderBy("activity_date")
    at = F.to_timestamp(F.concat(F.col("activity_date").cast("string"), F.lit(" 12:00:00")))
    return (timeline.withColumn("old_streak", F.lag("streak").over(w))
            .select(
                F.sha2(F.concat_ws("|", "user_id", F.col("activity_date").cast("string")), 256).substr(1, 32).alias("audit_id"),
                "user_id",
                F.lit("STREAK_UPDATE").alias("action"),
                F.struct(F.col("old_streak").alias("current_streak")).alias("old_value"),
                F.struct(F.col("streak").alias("current_streak")).alias("new_value"),
                F.lit(trigger).alias("trigger"),
                at.alias("timestamp"),
                (F.unix_timestamp(at) + F.lit(limits.audit_ttl_days * 86400)).alias("ttl"),
            ))


def user_streak(state: DataFrame, user_ids: DataFrame) -> DataFrame:
    """G1: current state of the given users (semi join on user_id)."""
    return state.join(user_ids.select("user_id"), "user_id", "left_semi")


def points_history(events: DataFrame, user_ids: DataFrame, as_of_date, days: int = DEFAULT_LIMITS.history_days) -> DataFrame:
    """The given users' events of the last ``days`` days, newest first.
    The date range filter prunes ``event_date`` partitions at the scan."""
    end = F.lit(str(as_of_date)).cast("date")
    recent = events.where((F.col("event_date") > F.date_sub(end, days)) & (F.col("event_date") <= end))
    return recent.join(user_ids.select("user_id"), "user_id", "left_semi").orderBy(
        F.col("created_at").desc(), F.col("event_id").desc())
