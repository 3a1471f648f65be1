"""E4 distinct users over refreshes: bitmaps by user number, merged and not recounted.

Every user has a number of its own, given once and kept (``number_users``). A day's
users are bitmaps: one bit per number, cut into fixed pieces of 32,768 numbers, so a
piece is 4 KB however many users a day has. A week is the OR of its days' pieces, and
its distinct users are the bits that are set. A refresh builds the bitmaps of the days
it brings and merges them with the stored ones; no stored event or user is read again.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Numbers of one task's users lie together; the next refresh goes on in free blocks.
BLOCK = 1 << 33


def number_users(users: DataFrame, known: DataFrame | None = None, key: str = "user_id") -> DataFrame:
    """(key, user_number) of the users in ``users`` that are not in ``known``. Numbers are
    consecutive within a task, so the pieces of bitmaps are full. The result depends on the
    task that holds a user: write it (as with ``known``) before numbers are used."""
    new = users.select(key).where(F.col(key).isNotNull()).distinct()
    number = F.monotonically_increasing_id()
    if known is None:
        return new.withColumn("user_number", number)
    begin = known.agg(F.coalesce((F.floor(F.max("user_number") / F.lit(BLOCK)) + 1) * F.lit(BLOCK), F.lit(0))).scalar()
    return new.join(known.select(key), key, "left_anti").withColumn("user_number", number + begin)


def daily_pieces(summaries: DataFrame, numbers: DataFrame, by: tuple[str, ...] = ("country",), day: str = "event_date") -> DataFrame:
    """Per day and ``by``: the bitmap pieces of its users, with the sums of their user-days
    that means are made of. A user without a number (null) has user-days and no bit."""
    rows = summaries.join(numbers, "user_id", "left")
    return rows.groupBy(day, *by, F.bitmap_bucket_number("user_number").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_number")).alias("bits"),
        F.sum("total_points").cast("long").alias("points"), F.count("total_points").alias("point_days"),
        F.sum("total_events").cast("long").alias("events"), F.count(F.lit(1)).alias("user_days"))


def replace_days(stored: DataFrame, fresh: DataFrame, day: str = "event_date") -> DataFrame:
    """``stored`` pieces with the days of ``fresh`` taken from ``fresh``."""
    return stored.join(fresh.select(day).distinct(), day, "left_anti").unionByName(fresh)


def weekly_pieces(pieces: DataFrame, by: tuple[str, ...] = ("country",), day: str = "event_date") -> DataFrame:
    """The days' pieces merged by week; merging weeks' pieces again changes nothing."""
    week = F.date_trunc("week", F.col(day)).cast("date")
    return pieces.groupBy(week.alias("week_start"), *by, "piece").agg(
        F.bitmap_or_agg("bits").alias("bits"), *[F.sum(c).alias(c) for c in ("points", "point_days", "events", "user_days")])


def weekly_stats(weeks: DataFrame, by: tuple[str, ...] = ("country",)) -> DataFrame:
    """E4 from weekly pieces: the columns of ``warehouse.weekly_streak_stats``."""
    return weeks.groupBy("week_start", *by).agg(
        F.sum(F.bitmap_count("bits")).alias("active_users"),
        (F.sum("points") / F.sum("point_days")).alias("avg_daily_points"),
        (F.sum("events") / F.sum("user_days")).alias("avg_daily_events"))
