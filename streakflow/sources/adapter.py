"""Driver tables -> the reference's event shapes (FIXTURES.md §2).

The driver's ``events`` table has no duplicates, zones or bad rows; the
adapter adds them by fixed arithmetic rules on the ids, so the same rows can
be produced by DuckDB SQL for the oracle. The SQL text of each derived column
is built here once for both engines (``dialect="spark"`` / ``"duckdb"``).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from streakflow.config import POINTS_MAP

# ---------------------------------------------------------------------------
# Fixed values of the adapter rules (FIXTURES.md §2).
# ---------------------------------------------------------------------------
AS_OF = "2024-01-31 00:00:00"
TYPE_MAP = {
    "click": "TOOL_USE",
    "view": "DAILY_OPEN",
    "purchase": "SHARE_RESULT",
    "signup": "CONVERSATION_START",
    "error": "INVALID_TYPE",
}
TZ_CYCLE = ("America/Sao_Paulo", "Asia/Tokyo", "Europe/London", "America/New_York", "Pacific/Auckland", "UTC")
SOURCE_CYCLE = ("mobile_app", "web", "whatsapp", None)
BAD_ZONE = "Bad/Zone"
BAD_ZONE_EVERY = 211
HOPPER_MOD, HOPPER_REM = 10, 3
NO_OFFSET_EVERY = 307
NO_TYPE_EVERY, NO_USER_EVERY, NO_ZONE_EVERY, NO_KEY_EVERY = 503, 509, 521, 523
FUTURE_EVERY, FUTURE_DAYS = 311, 45
BAD_TIME_EVERY = 541
POINTS_OVERRIDES = ((97, "500"), (101, "-1"), (103, "12x"))
DUP_EVERY = 20
DUP_ID_OFFSET = 10_000_000
RECEIVE_SPREAD_SECONDS = 7
UNKNOWN_USER_MOD, UNKNOWN_USER_REM, UNKNOWN_USER_SHIFT = 25, 7, 1_000_000_000
BROKEN_BODY_EVERY = 401
SIGNUP_BASE = "2023-01-01"
SIGNUP_SPREAD_DAYS = 365
STREAK_FAULT_MOD = 11
STREAK_JUMP_MOD, STREAK_JUMP_DELTA = 23, 3
POINTS_FAULT_MOD, POINTS_FAULT_DELTA = 13, 5
MISSING_DAY_MOD, MISSING_DAY = 17, "2024-01-10"
ORPHAN_DAY_MOD, ORPHAN_DAY = 19, "2023-12-31"
ORACLE_RATE_LIMIT = 2
ORACLE_DUPLICATE_PATTERN = 2
ORACLE_SPIKE_FACTOR = 2.0
ORACLE_MIDNIGHT_MINUTES = 360
RECONCILE_AT = "2024-01-31 02:00:00"
ORACLE_MAX_AGE_DAYS = 40
# ---------------------------------------------------------------------------


def _case(expr: str, mapping: list[tuple[str, str | None]]) -> str:
    arms = " ".join(f"WHEN {k} THEN {v}" for k, v in mapping)
    return f"CASE {expr} {arms} END"


def _q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _iso_text(ts: str, dialect: str) -> str:
    if dialect == "spark":
        return f"date_format({ts}, 'yyyy-MM-dd''T''HH:mm:ss.SSSSSS')"
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f')"


def _key_text(ts: str, dialect: str) -> str:
    if dialect == "spark":
        return f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def column_sql(dialect: str) -> dict[str, str]:
    """SQL text of each adapted column over (src_id, row_id, uid, src_type, ts)."""
    kind = _case("src_type", [(_q(k), _q(v)) for k, v in TYPE_MAP.items()])
    event_type = f"CASE WHEN src_id % {NO_TYPE_EVERY} <> 0 THEN {kind} END"
    zone_idx = f"CASE WHEN uid % {HOPPER_MOD} = {HOPPER_REM} THEN (uid + src_id) % {len(TZ_CYCLE)} ELSE uid % {len(TZ_CYCLE)} END"
    zone = (f"CASE WHEN src_id % {NO_ZONE_EVERY} = 0 THEN NULL WHEN src_id % {BAD_ZONE_EVERY} = 0 THEN {_q(BAD_ZONE)} ELSE "
            + _case(zone_idx, [(str(i), _q(z)) for i, z in enumerate(TZ_CYCLE)]) + " END")
    source = _case(f"src_id % {len(SOURCE_CYCLE)}", [(str(i), _q(s)) for i, s in enumerate(SOURCE_CYCLE)])
    type_points = _case(kind, [(_q(k), str(v)) for k, v in POINTS_MAP.items()] + [("'INVALID_TYPE'", "0")])
    overrides = " ".join(f"WHEN src_id % {m} = 0 THEN {_q(v)}" for m, v in POINTS_OVERRIDES)
    points = f"CASE {overrides} ELSE CAST({type_points} AS STRING) END"
    iso = _iso_text("ts", dialect)
    ahead = _iso_text(f"ts + INTERVAL {FUTURE_DAYS} DAY", dialect)
    client_ts = (f"CASE WHEN src_id % {NO_OFFSET_EVERY} = 0 THEN {iso} WHEN src_id % {FUTURE_EVERY} = 0 THEN {ahead} || '+00:00' "
                 f"WHEN src_id % {BAD_TIME_EVERY} = 0 THEN 'yesterday' ELSE {iso} || '+00:00' END")
    # some users' events come under a number that no customer has
    user_id = (f"'usr_' || CAST(uid + CASE WHEN uid % {UNKNOWN_USER_MOD} = {UNKNOWN_USER_REM} "
               f"THEN {UNKNOWN_USER_SHIFT} ELSE 0 END AS STRING)")
    key = (f"CASE WHEN src_id % {NO_KEY_EVERY} <> 0 THEN {user_id} || ':' || {kind} || ':' || {_key_text('ts', dialect)} END")
    user_id = f"CASE WHEN src_id % {NO_USER_EVERY} <> 0 THEN {user_id} END"
    return {
        "user_id": user_id,
        "event_id": "lpad(CAST(row_id AS STRING), 12, '0')",
        "event_type": event_type,
        "timezone": zone,
        "source": source,
        "idempotency_key": key,
        "client_timestamp": client_ts,
        "points_awarded": points,
    }


def adapt_events(events: DataFrame) -> DataFrame:
    """Driver ``events`` -> raw event rows in the reference's shape, with
    duplicates, zones, bad values and arrival times added by rule.

    Narrow transformations plus one filtered union: no shuffle.
    """
    base = events.select(
        F.col("event_id").alias("src_id"), F.col("ts"), F.col("user_id").alias("uid"),
        F.col("event_type").alias("src_type"), F.col("props"),
    )
    rows = base.withColumn("row_id", F.col("src_id")).unionByName(
        base.where(F.col("src_id") % DUP_EVERY == 0).withColumn("row_id", F.col("src_id") + DUP_ID_OFFSET)
    )
    cols = column_sql("spark")
    created = F.col("ts").cast("timestamp")
    return rows.select(
        "uid", "src_id", "row_id",
        *[F.expr(sql).alias(name) for name, sql in cols.items()],
        created.alias("created_at"),
        (created + F.make_interval(secs=(F.col("row_id") % RECEIVE_SPREAD_SECONDS).cast("int"))).alias("received_at"),
        F.from_json("props", "map<string,string>").alias("metadata"),
    )


def raw_events(adapted: DataFrame, event_ttl_days: int = 90) -> DataFrame:
    """Raw-lake rows (bp_events shape, points as text) for the batch job."""
    return adapted.select(
        "user_id", "event_id", "event_type", "points_awarded", "source", "idempotency_key",
        "client_timestamp", "created_at",
        (F.unix_timestamp("created_at") + event_ttl_days * 86400).alias("ttl"),
    )


def payloads(adapted: DataFrame) -> DataFrame:
    """Client payloads (no server-side fields) plus ``received_at`` and the
    row id that fixes arrival order."""
    return adapted.select(
        "row_id", "user_id", "event_type", "client_timestamp", "timezone", "idempotency_key",
        "source", "metadata", "received_at",
    )


def payload_json(adapted: DataFrame) -> DataFrame:
    """Payloads as JSON request bodies, some cut short, the input of ``parse_payload``."""
    p = payloads(adapted)
    body = F.to_json(F.struct("user_id", "event_type", "client_timestamp", "timezone",
                              "idempotency_key", "source", "metadata"))
    cut_short = F.concat(F.lit('{"user_id": '), F.col("row_id").cast("string"))
    body = F.when(F.col("row_id") % BROKEN_BODY_EVERY == 0, cut_short).otherwise(body)
    return p.select("row_id", body.alias("body"), "received_at")


def user_dim(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """User dimension: every customer with its nation (25 fixed rows)."""
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = nation.select("n_nationkey", "n_name")
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select(
        F.concat(F.lit("usr_"), F.col("c_custkey").cast("string")).alias("user_id"),
        F.col("n_name").alias("country"),
        F.date_add(F.lit(SIGNUP_BASE).cast("date"), (F.col("c_custkey") % SIGNUP_SPREAD_DAYS).cast("int")).alias("signup_date"),
        F.col("c_mktsegment").alias("user_segment"),
    )


def user_number(user_id: Column | str) -> Column:
    """Numeric part of ``usr_N`` (fault rules are arithmetic on it)."""
    c = F.col(user_id) if isinstance(user_id, str) else user_id
    return F.substring(c, 5, 64).cast("bigint")


def stored_state_with_faults(streaks: DataFrame, balances: DataFrame) -> DataFrame:
    """Operational state as a key-value store would hold it: recomputed
    streaks and balances with injected drift for reconciliation."""
    n = user_number("user_id")
    s = streaks.select(
        "user_id",
        F.when(n % STREAK_JUMP_MOD == 0, F.col("current_streak") + STREAK_JUMP_DELTA)
        .when(n % STREAK_FAULT_MOD == 0, F.col("current_streak") + 1)
        .otherwise(F.col("current_streak")).alias("current_streak"),
        "longest_streak", "last_activity_date", "version",
    )
    b = balances.select(
        "user_id",
        F.when(n % POINTS_FAULT_MOD == 0, F.col("total_bestie_points") + POINTS_FAULT_DELTA)
        .otherwise(F.col("total_bestie_points")).alias("total_bestie_points"),
        "timezone", "streak_updated_at",
    )
    return s.join(b, "user_id", "full")


def daily_with_faults(daily: DataFrame) -> DataFrame:
    """Daily activity with one missing day per some users and an orphan
    day for others."""
    n = user_number("user_id")
    kept = daily.where(~((n % MISSING_DAY_MOD == 0) & (F.col("activity_date") == F.lit(MISSING_DAY).cast("date"))))
    orphans = (daily.where(n % ORPHAN_DAY_MOD == 0).groupBy("user_id")
               .agg(F.min("first_event_id").alias("first_event_id"))
               .select("user_id", F.lit(ORPHAN_DAY).cast("date").alias("activity_date"), "first_event_id",
                       F.lit(1).cast("bigint").alias("events_count"), F.lit(0).cast("bigint").alias("points_earned"),
                       F.lit(ORPHAN_DAY).cast("timestamp").alias("created_at")))
    return kept.unionByName(orphans.select(*kept.columns))
