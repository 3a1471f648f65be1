"""Declared schemas of every table the engine reads or writes."""
from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, IntegerType, LongType, MapType, StringType,
    StructField, StructType, TimestampType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Event payload as a client posts it.
PAYLOAD = _s(
    ("user_id", StringType()),
    ("event_type", StringType()),
    ("client_timestamp", StringType()),
    ("timezone", StringType()),
    ("idempotency_key", StringType()),
    ("source", StringType()),
    ("metadata", MapType(StringType(), StringType())),
)

# Raw lake row (bp_events shape before casts); points and created_at may be text.
RAW_EVENT = _s(
    ("user_id", StringType()),
    ("event_id", StringType()),
    ("event_type", StringType()),
    ("points_awarded", StringType()),
    ("source", StringType()),
    ("idempotency_key", StringType()),
    ("client_timestamp", StringType()),
    ("created_at", TimestampType()),
    ("ttl", LongType()),
)

# Accepted event log after casts.
BP_EVENT = _s(
    ("user_id", StringType()),
    ("event_id", StringType()),
    ("event_type", StringType()),
    ("points_awarded", IntegerType()),
    ("source", StringType()),
    ("idempotency_key", StringType()),
    ("client_timestamp", StringType()),
    ("created_at", TimestampType()),
    ("ttl", LongType()),
)

USER_DIM = _s(
    ("user_id", StringType()),
    ("country", StringType()),
    ("signup_date", DateType()),
    ("user_segment", StringType()),
)

DAILY_ACTIVITY = _s(
    ("user_id", StringType()),
    ("activity_date", DateType()),
    ("first_event_id", StringType()),
    ("events_count", LongType()),
    ("points_earned", LongType()),
    ("created_at", TimestampType()),
)

TZ_CHANGE = StructType([StructField("timezone", StringType()), StructField("timestamp", TimestampType())])

USER_STREAKS = _s(
    ("user_id", StringType()),
    ("current_streak", LongType()),
    ("longest_streak", LongType()),
    ("last_activity_date", DateType()),
    ("timezone", StringType()),
    ("total_bestie_points", LongType()),
    ("streak_updated_at", TimestampType()),
    ("version", LongType()),
    ("recent_tz_changes", ArrayType(TZ_CHANGE)),
    ("leaderboard_partition", StringType()),
)

# Change record of the daily-activity table.
CDC_RECORD = StructType([
    StructField("eventName", StringType()),
    StructField("dynamodb", StructType([
        StructField("NewImage", StructType([
            StructField("user_id", StructType([StructField("S", StringType())])),
            StructField("activity_date", StructType([StructField("S", StringType())])),
            StructField("first_event_id", StructType([StructField("S", StringType())])),
        ])),
    ])),
])

DAILY_SUMMARY = _s(
    ("user_id", StringType()),
    ("event_date", DateType()),
    ("country", StringType()),
    ("user_segment", StringType()),
    ("total_events", LongType()),
    ("total_points", LongType()),
    ("distinct_event_types", LongType()),
    ("first_event_at", TimestampType()),
    ("last_event_at", TimestampType()),
    ("event_types", StringType()),
)

# Warehouse fact (and its staging twin): the 11 load columns plus loaded_at.
FACT_BP_EVENTS = _s(
    ("event_id", StringType()),
    ("user_id", StringType()),
    ("event_type", StringType()),
    ("points_awarded", IntegerType()),
    ("source", StringType()),
    ("idempotency_key", StringType()),
    ("client_timestamp", TimestampType()),
    ("created_at", TimestampType()),
    ("event_date", DateType()),
    ("country", StringType()),
    ("user_segment", StringType()),
    ("loaded_at", TimestampType()),
)
FACT_LOAD_COLUMNS = tuple(f.name for f in FACT_BP_EVENTS.fields if f.name != "loaded_at")

DIM_USER_STREAKS = _s(
    ("user_id", StringType()),
    ("snapshot_date", DateType()),
    ("current_streak", IntegerType()),
    ("longest_streak", IntegerType()),
    ("total_bestie_points", IntegerType()),
    ("last_activity_date", DateType()),
    ("timezone", StringType()),
    ("loaded_at", TimestampType()),
)

ANOMALY_LOG = _s(
    ("rule", StringType()),
    ("user_id", StringType()),
    ("at", TimestampType()),
    ("severity", StringType()),
    ("action", StringType()),
    ("detail", StringType()),
)

FLAG = BooleanType()
