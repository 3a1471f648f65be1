"""Per user-day and per user rollups.

All but E8 are single hash aggregates with partial (map-side) aggregation. The type
set of E1 is over validated or warehouse events, whose types are a small fixed set.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from streakflow.operators.dedup import unique_dim


def daily_summaries(events: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Per user and UTC day: events, points, distinct types, first/last
    time and the sorted type list; country and segment from the dimension.

    The aggregate runs on the events first and only its result (one row per
    user-day) is joined to the dimension: the dimension is unique per user,
    so this equals grouping the enriched rows by user, day, country and
    segment, but moves far less data through the join.
    """
    types = F.collect_set("event_type")
    agg = events.groupBy("user_id", "event_date").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.sum("points_awarded").cast("long").alias("total_points"),
        F.size(types).cast("long").alias("distinct_event_types"),
        F.min("created_at").alias("first_event_at"),
        F.max("created_at").alias("last_event_at"),
        F.array_join(F.array_sort(types), ",").alias("event_types"),
    )
    if dim is None:
        if "country" in events.columns:
            raise ValueError("pass the dimension; enriched rows are grouped by user-day only")
        agg = agg.withColumn("country", F.lit(None).cast("string")).withColumn("user_segment", F.lit(None).cast("string"))
    else:
        agg = agg.join(unique_dim(dim.select("user_id", "country", "user_segment")), "user_id", "left")
    return agg.select("user_id", "event_date", "country", "user_segment", "total_events", "total_points",
                      "distinct_event_types", "first_event_at", "last_event_at", "event_types")


def daily_activity(events: DataFrame, date_col: str = "activity_date") -> DataFrame:
    """Per user and local day: first event id (earliest by time, id),
    event count, points and the first event's time."""
    first = F.struct("created_at", "event_id")
    return events.groupBy("user_id", F.col(date_col).alias("activity_date")).agg(
        F.min_by("event_id", first).alias("first_event_id"),
        F.count(F.lit(1)).alias("events_count"),
        F.sum("points_awarded").cast("long").alias("points_earned"),
        F.min("created_at").alias("created_at"),
    )


def point_balances(events: DataFrame) -> DataFrame:
    """Lifetime points, latest timezone and last update per user."""
    latest = F.struct("created_at", "event_id")
    return events.groupBy("user_id").agg(
        F.sum("points_awarded").cast("long").alias("total_bestie_points"),
        F.max_by("timezone", latest).alias("timezone"),
        F.max("created_at").alias("streak_updated_at"),
    )


def user_profile(events: DataFrame) -> DataFrame:
    """Events, distinct types and distinct sources per user. The texts come from
    clients and have no bound, so no task gathers them: equal ones are counted first
    (combined before the shuffle), and distinct counts run over what is left."""
    counted = events.groupBy("user_id", "event_type", "source").agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy("user_id").agg(
        F.sum("_n").alias("events"),
        F.count_distinct("event_type").alias("event_types"),
        F.count_distinct("source").alias("sources"),
    )
