"""DuckDB twins of the registered queries (the correctness oracle).

Each SQL text runs on the driver's tables (pre-registered views) and must
give the same rows, column names and types as the Spark query. Instants are
rendered as UTC text with microseconds, doubles rounded to 6 places.
"""
from __future__ import annotations

from streakflow.sources import adapter

TS = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def ts(expr: str) -> str:
    return TS.format(expr)


def _adapter_ctes() -> str:
    cols = adapter.column_sql("duckdb")
    derived = ",\n    ".join(f"{sql} AS {name}" for name, sql in cols.items())
    return f"""
src AS (SELECT event_id AS src_id, ts, user_id AS uid, event_type AS src_type, props FROM events),
rows_ AS (
  SELECT *, src_id AS row_id FROM src
  UNION ALL
  SELECT *, src_id + {adapter.DUP_ID_OFFSET} AS row_id FROM src WHERE src_id % {adapter.DUP_EVERY} = 0),
adapted AS (
  SELECT uid, src_id, row_id, props,
    {derived},
    ts AS created_at,
    ts + to_seconds(CAST(row_id % {adapter.RECEIVE_SPREAD_SECONDS} AS BIGINT)) AS received_at
  FROM rows_),
raw AS (
  SELECT user_id, event_id, event_type, points_awarded, source, idempotency_key, client_timestamp,
         created_at, CAST(floor(epoch(created_at)) AS BIGINT) + 90 * 86400 AS ttl
  FROM adapted),
dim AS (
  SELECT 'usr_' || CAST(c_custkey AS VARCHAR) AS user_id, n_name AS country,
         CAST(DATE '{adapter.SIGNUP_BASE}' + CAST(c_custkey % {adapter.SIGNUP_SPREAD_DAYS} AS INTEGER) AS DATE) AS signup_date,
         c_mktsegment AS user_segment
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""


def _curate_ctes() -> str:
    return """,
kept AS (SELECT * FROM raw WHERE event_type IS NOT NULL AND user_id IS NOT NULL),
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY created_at, event_id) AS rn FROM kept)
  WHERE rn = 1),
typed AS (
  SELECT * REPLACE (TRY_CAST(points_awarded AS INTEGER) AS points_awarded), CAST(created_at AS DATE) AS event_date
  FROM deduped),
flagged AS (SELECT *, COALESCE(points_awarded < 0 OR points_awarded > 100, false) AS is_anomalous FROM typed),
clean AS (SELECT * EXCLUDE (is_anomalous) FROM flagged WHERE NOT is_anomalous),
enriched AS (SELECT c.*, d.country, d.signup_date, d.user_segment FROM clean c LEFT JOIN dim d USING (user_id))"""


def with_ctes(body: str, curate: bool = True, extra: str = "") -> str:
    return "WITH " + _adapter_ctes() + (_curate_ctes() if curate else "") + extra + "\n" + body


def _middle(q: float) -> str:
    """The middle of the sketch bucket that holds a quantile."""
    b = f"quantile_disc(b, {q:.2f})"
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE pow(1.02, {b}) * (2 / 2.02) / 1000000.0 END"


ORACLE: dict[str, str] = {}

ORACLE["daily_summaries"] = with_ctes(f"""
SELECT user_id, event_date, country, user_segment,
       CAST(COUNT(*) AS BIGINT) AS total_events,
       CAST(SUM(points_awarded) AS BIGINT) AS total_points,
       CAST(COUNT(DISTINCT event_type) AS BIGINT) AS distinct_event_types,
       {ts('MIN(created_at)')} AS first_event_at,
       {ts('MAX(created_at)')} AS last_event_at,
       array_to_string(list_sort(list_distinct(list(event_type))), ',') AS event_types
FROM enriched GROUP BY user_id, event_date, country, user_segment""")

ORACLE["curated_versions"] = ORACLE["daily_summaries"]

ORACLE["processing_ledger"] = with_ctes("""
SELECT DISTINCT CAST(year(created_at) AS INTEGER) AS year, CAST(month(created_at) AS INTEGER) AS month,
       CAST(day(created_at) AS INTEGER) AS day, CAST(hour(created_at) AS INTEGER) AS hour,
       CASE WHEN hour(created_at) < 12 THEN 1 ELSE 2 END AS version
FROM raw""")

ORACLE["curated_events"] = with_ctes(f"""
SELECT user_id, event_id, event_type, points_awarded, source, idempotency_key, client_timestamp,
       {ts('created_at')} AS created_at, ttl, event_date, country, signup_date, user_segment
FROM enriched""")

ORACLE["anomalous_points"] = with_ctes(f"""
SELECT user_id, event_id, event_type, points_awarded, idempotency_key, {ts('created_at')} AS created_at,
       event_date, is_anomalous
FROM flagged WHERE is_anomalous""")

ORACLE["dedup_first"] = with_ctes(f"""
SELECT idempotency_key, event_id, {ts('created_at')} AS created_at FROM deduped""")

ORACLE["user_dim"] = with_ctes("SELECT user_id, country, signup_date, user_segment FROM dim", curate=False)

ORACLE["quality_funnel"] = with_ctes("""
SELECT 1 AS stage_no, 'raw' AS stage, CAST(COUNT(*) AS BIGINT) AS row_count FROM raw
UNION ALL SELECT 2, 'deduplicated', CAST(COUNT(*) AS BIGINT) FROM flagged
UNION ALL SELECT 3, 'anomaly_free', CAST(COUNT(*) AS BIGINT) FROM clean
UNION ALL SELECT 4, 'enriched', CAST(COUNT(*) AS BIGINT) FROM enriched""")


# --- P2 ingest -----------------------------------------------------------------
from streakflow.config import POINTS_MAP, STATUS_CODES, STATUSES, STREAK_BUCKET_ELSE, STREAK_BUCKETS  # noqa: E402

AS_OF = adapter.AS_OF
AS_OF_DATE = AS_OF[:10]
LOADED_AT = "2024-01-31 01:00:00"
_VALID_TYPES = ", ".join(f"'{t}'" for t in POINTS_MAP)
_POINTS_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in POINTS_MAP.items()) + " END"
_ISO_RE = r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
_OFFSET_RE = r"(Z|z|[+-]\d{2}(:?\d{2})?)$"


def _utc_parse(col: str) -> str:
    """ISO text -> UTC instant, text without an offset read as UTC whatever
    the DuckDB session zone (Spark's session zone is pinned to UTC)."""
    return (f"(TRY_CAST(CASE WHEN regexp_matches({col}, '^{_ISO_RE}{_OFFSET_RE}') THEN {col}"
            f" WHEN regexp_matches({col}, '^{_ISO_RE}$') THEN {col} || '+00:00' END"
            f" AS TIMESTAMPTZ) AT TIME ZONE 'UTC')")


_CODES_CASE = "CASE status " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in STATUS_CODES.items()) + " END"


def _trailing(value: str, width_us: int, include_current: bool = True, tie: str = "row_id") -> str:
    """Sum over [t - width + 1us, t] up to the current row in (t, tie) order."""
    s = (f"SUM({value}) OVER (PARTITION BY user_id ORDER BY epoch_us(created_at) "
         f"RANGE BETWEEN {width_us - 1} PRECEDING AND CURRENT ROW)"
         f" - COALESCE(SUM({value}) OVER (PARTITION BY user_id, epoch_us(created_at) ORDER BY {tie} "
         f"ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)")
    return s if include_current else f"{s} - {value}"


def _reason_sql(max_age_days: int) -> str:
    req = ", ".join(f"CASE WHEN {f} IS NULL THEN 'Missing required field: {f}' END"
                    for f in ("user_id", "event_type", "client_timestamp", "timezone", "idempotency_key"))
    return f"""COALESCE({req},
      CASE WHEN event_type NOT IN ({_VALID_TYPES}) THEN 'Invalid event_type: ' || event_type END,
      CASE WHEN NOT zone_ok THEN 'Invalid timezone: ' || timezone END,
      CASE WHEN parsed IS NULL THEN 'Invalid client_timestamp format (expected ISO 8601)' END,
      CASE WHEN NOT regexp_matches(client_timestamp, '^{_ISO_RE}{_OFFSET_RE}') THEN 'timestamp_without_offset' END,
      CASE WHEN parsed > TIMESTAMP '{AS_OF}' + INTERVAL 24 HOUR THEN 'client_timestamp is too far in the future'
           WHEN parsed < TIMESTAMP '{AS_OF}' - INTERVAL {max_age_days} DAY THEN 'client_timestamp is too far in the past'
      END)"""


def _ingest_ctes(max_age_days: int, rate_limit: int, tz_limit: int = 2) -> str:
    req = ", ".join(f"CASE WHEN {f} IS NULL THEN 'Missing required field: {f}' END"
                    for f in ("user_id", "event_type", "client_timestamp", "timezone", "idempotency_key"))
    return f""",
pay AS (SELECT row_id, user_id, event_type, client_timestamp, timezone, idempotency_key, source, received_at
        FROM adapted),
v AS (
  SELECT *, {_utc_parse('client_timestamp')} AS parsed,
         COALESCE(timezone IN (SELECT name FROM pg_timezone_names()), false) AS zone_ok
  FROM pay),
v2 AS (
  SELECT *, CASE WHEN zone_ok THEN timezone ELSE 'UTC' END AS zone,
    {_reason_sql(max_age_days)} AS reason
  FROM v),
valid AS (SELECT * EXCLUDE (parsed), parsed AS created_at FROM v2 WHERE reason IS NULL),
counted AS (SELECT *, CAST({_trailing('1', 3600 * 1000000)} AS BIGINT) AS attempts_last_hour FROM valid),
passed AS (SELECT * FROM counted WHERE attempts_last_hour <= {rate_limit}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY created_at, row_id) AS krank,
         first_value(created_at) OVER (PARTITION BY idempotency_key ORDER BY created_at, row_id) AS first_ts
  FROM passed),
firsts AS (SELECT * FROM ranked WHERE krank = 1),
zl AS (SELECT *, COALESCE(timezone <> lag(timezone) OVER (PARTITION BY user_id ORDER BY created_at, row_id), false)
                 AS tz_changed FROM firsts),
za AS (SELECT *, {_trailing('CAST(tz_changed AS BIGINT)', 24 * 3600 * 1000000, False)} AS recent_changes FROM zl),
tzf AS (SELECT *, tz_changed AND recent_changes >= {tz_limit} AS tz_abuse FROM za),
acc AS (
  SELECT row_id, user_id,
         strftime(created_at, '%Y%m%dT%H%M%S') || '#' || substr(sha256(idempotency_key), 1, 8) AS event_id,
         event_type, CAST({_POINTS_CASE} AS INTEGER) AS points_awarded, COALESCE(source, 'unknown') AS source,
         idempotency_key, client_timestamp, created_at,
         CAST(floor(epoch(created_at)) AS BIGINT) + 90 * 86400 AS ttl, timezone,
         CAST((created_at AT TIME ZONE 'UTC') AT TIME ZONE zone AS DATE) AS activity_date, received_at
  FROM tzf WHERE NOT tz_abuse),
verdicts AS (
  SELECT row_id, user_id, CASE WHEN reason = 'timestamp_without_offset' THEN 'error' ELSE 'validation_error' END AS status,
         reason, CAST(NULL AS VARCHAR) AS event_id, CAST(NULL AS VARCHAR) AS original_event_id, received_at
  FROM v2 WHERE reason IS NOT NULL
  UNION ALL SELECT row_id, user_id, 'rate_limited', 'Rate limit exceeded', NULL, NULL, received_at FROM counted
            WHERE attempts_last_hour > {rate_limit}
  UNION ALL SELECT row_id, user_id, 'tz_abuse', 'Suspicious timezone change detected', NULL, NULL, received_at
            FROM tzf WHERE tz_abuse
  UNION ALL SELECT row_id, user_id, 'duplicate', 'Event already processed', NULL,
            strftime(first_ts, '%Y%m%dT%H%M%S') || '#' || substr(sha256(idempotency_key), 1, 8), received_at
            FROM ranked WHERE krank > 1
            AND idempotency_key NOT IN (SELECT idempotency_key FROM tzf WHERE tz_abuse)
  UNION ALL SELECT row_id, user_id, 'tz_abuse', 'Suspicious timezone change detected', NULL, NULL, received_at
            FROM ranked WHERE krank > 1 AND idempotency_key IN (SELECT idempotency_key FROM tzf WHERE tz_abuse)
  UNION ALL SELECT row_id, user_id, 'processed', 'Event processed', event_id, NULL, received_at FROM acc),
daily AS (
  SELECT user_id, activity_date, arg_min(event_id, (created_at, event_id)) AS first_event_id,
         CAST(COUNT(*) AS BIGINT) AS events_count, CAST(SUM(points_awarded) AS BIGINT) AS points_earned,
         MIN(created_at) AS created_at
  FROM acc GROUP BY user_id, activity_date),
balances AS (
  SELECT user_id, CAST(SUM(points_awarded) AS BIGINT) AS total_bestie_points,
         arg_max(timezone, (created_at, event_id)) AS timezone, MAX(created_at) AS streak_updated_at
  FROM acc GROUP BY user_id),
days AS (SELECT DISTINCT user_id, activity_date FROM daily WHERE activity_date IS NOT NULL),
isl AS (SELECT *, activity_date - CAST(row_number() OVER (PARTITION BY user_id ORDER BY activity_date) AS INTEGER) AS island
        FROM days),
runs AS (SELECT user_id, island, COUNT(*) AS len, MAX(activity_date) AS run_end FROM isl GROUP BY user_id, island),
streaks AS (
  SELECT user_id, CAST(arg_max(len, run_end) AS BIGINT) AS current_streak, CAST(MAX(len) AS BIGINT) AS longest_streak,
         MAX(run_end) AS last_activity_date, CAST(SUM(len) AS BIGINT) AS version
  FROM runs GROUP BY user_id),
streaks_eff AS (
  SELECT *, CASE WHEN last_activity_date >= DATE '{AS_OF_DATE}' - 1 THEN current_streak ELSE CAST(0 AS BIGINT) END
         AS effective_streak FROM streaks),
state AS (
  SELECT COALESCE(s.user_id, b.user_id) AS user_id, s.current_streak, s.longest_streak, s.last_activity_date, s.version,
         s.effective_streak, b.total_bestie_points, b.timezone, b.streak_updated_at
  FROM streaks_eff s FULL JOIN balances b ON s.user_id = b.user_id),
state_c AS (SELECT st.*, d.country FROM state st LEFT JOIN (SELECT user_id, country FROM dim) d USING (user_id))"""


def with_ingest(body: str, max_age_days: int = adapter.ORACLE_MAX_AGE_DAYS,
                rate_limit: int = adapter.ORACLE_RATE_LIMIT, extra: str = "") -> str:
    return with_ctes(body, curate=True, extra=_ingest_ctes(max_age_days, rate_limit) + extra)


_VERDICT_SELECT = f"SELECT row_id, user_id, status, reason, event_id, original_event_id, CAST({_CODES_CASE} AS INTEGER) AS http_status FROM verdicts"

ORACLE["ingest_verdicts"] = with_ingest(_VERDICT_SELECT)
ORACLE["ingest_verdicts_default_limits"] = with_ingest(_VERDICT_SELECT, max_age_days=7, rate_limit=100)

ORACLE["parse_payload"] = with_ctes(f"""
SELECT row_id, CASE WHEN ok THEN user_id END AS user_id, CASE WHEN ok THEN event_type END AS event_type,
       CASE WHEN ok THEN client_timestamp END AS client_timestamp, CASE WHEN ok THEN timezone END AS timezone,
       CASE WHEN ok THEN idempotency_key END AS idempotency_key, CASE WHEN ok THEN source END AS source,
       CASE WHEN ok THEN json_extract_string(props, '$.k') END AS metadata_k,
       CASE WHEN NOT ok THEN '{{"user_id": ' || CAST(row_id AS VARCHAR) END AS corrupt_body,
       {ts('received_at')} AS received_at
FROM (SELECT *, row_id % {adapter.BROKEN_BODY_EVERY} <> 0 AS ok FROM adapted)""", curate=False)

ORACLE["accepted_events"] = with_ingest(f"""
SELECT row_id, user_id, event_id, event_type, points_awarded, source, idempotency_key, client_timestamp,
       {ts('created_at')} AS created_at, ttl, timezone, activity_date, {ts('received_at')} AS received_at FROM acc""")

_pivot = ", ".join(f"CAST(COUNT(*) FILTER (WHERE status = '{s}') AS BIGINT) AS {s}" for s in STATUSES)
ORACLE["ingest_report"] = with_ingest(f"SELECT user_id, {_pivot}, CAST(COUNT(*) AS BIGINT) AS total FROM verdicts GROUP BY user_id")

ORACLE["user_profile"] = with_ctes("""
SELECT user_id, CAST(COUNT(*) AS BIGINT) AS events, CAST(COUNT(DISTINCT event_type) AS BIGINT) AS event_types,
       CAST(COUNT(DISTINCT source) AS BIGINT) AS sources
FROM adapted GROUP BY user_id""", curate=False)

ORACLE["daily_activity"] = with_ingest(f"""
SELECT user_id, activity_date, first_event_id, events_count, points_earned, {ts('created_at')} AS created_at FROM daily""")

ORACLE["point_balances"] = with_ingest(f"""
SELECT user_id, total_bestie_points, timezone, {ts('streak_updated_at')} AS streak_updated_at FROM balances""")

ORACLE["streaks"] = with_ingest("SELECT * FROM streaks_eff")

ORACLE["daily_compacted"] = ORACLE["daily_activity"]

ORACLE["streaks_late_days"] = ORACLE["streaks"]

ORACLE["streak_timeline"] = with_ingest("""
SELECT user_id, activity_date, CAST(row_number() OVER (PARTITION BY user_id, island ORDER BY activity_date) AS BIGINT) AS streak
FROM isl""")

ORACLE["points_timeline"] = with_ctes("""
SELECT user_id, day, day_points,
       CAST(SUM(day_points) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS cumulative_points
FROM per_day""", extra=""",
per_day AS (SELECT user_id, event_date AS day, CAST(SUM(points_awarded) AS BIGINT) AS day_points
            FROM enriched GROUP BY user_id, event_date)""")


def _leaderboard(n: int, by: str | None) -> str:
    part = f"COALESCE({by}, 'GLOBAL')" if by else "'GLOBAL'"
    return with_ingest(f"""
SELECT * FROM (
  SELECT {part} AS leaderboard_partition,
         CAST(row_number() OVER (PARTITION BY {part}
              ORDER BY current_streak DESC NULLS LAST, total_bestie_points DESC NULLS LAST, user_id) AS INTEGER) AS rank,
         user_id, current_streak, total_bestie_points
  FROM state_c) WHERE rank <= {n}""")


ORACLE["leaderboard_by_country"] = _leaderboard(3, "country")
ORACLE["leaderboard_global"] = _leaderboard(100, None)

ORACLE["user_streak_lookup"] = with_ingest("""
SELECT user_id, current_streak, longest_streak, last_activity_date, total_bestie_points, timezone FROM state_c
WHERE user_id IN (SELECT user_id FROM dim WHERE country = 'NATION_3')""")

ORACLE["points_history"] = with_ctes(f"""
SELECT user_id, event_id, event_type, points_awarded, {ts('created_at')} AS created_at, event_date FROM enriched
WHERE event_date > DATE '{AS_OF_DATE}' - 30 AND event_date <= DATE '{AS_OF_DATE}'
  AND user_id IN (SELECT user_id FROM dim WHERE country = 'NATION_3')""")

# --- P3 warehouse ------------------------------------------------------------------

_FACT = f"""
fact AS (
  SELECT event_id, user_id, event_type, points_awarded, source, idempotency_key,
         {_utc_parse('client_timestamp')} AS client_timestamp, created_at, event_date,
         country, user_segment, TIMESTAMP '{LOADED_AT}' AS loaded_at
  FROM enriched),
snapshot AS (
  SELECT user_id, DATE '{AS_OF_DATE}' AS snapshot_date, CAST(current_streak AS INTEGER) AS current_streak,
         CAST(longest_streak AS INTEGER) AS longest_streak, CAST(total_bestie_points AS INTEGER) AS total_bestie_points,
         last_activity_date, timezone, TIMESTAMP '{LOADED_AT}' AS loaded_at
  FROM state_c),
summaries AS (
  SELECT user_id, event_date, country, user_segment, CAST(COUNT(*) AS BIGINT) AS total_events,
         CAST(SUM(points_awarded) AS BIGINT) AS total_points
  FROM enriched GROUP BY user_id, event_date, country, user_segment)"""


def with_warehouse(body: str) -> str:
    return with_ctes(body, curate=True, extra=_ingest_ctes(adapter.ORACLE_MAX_AGE_DAYS, adapter.ORACLE_RATE_LIMIT)
                     + "," + _FACT)


_FACT_SELECT = (f"event_id, user_id, event_type, points_awarded, source, idempotency_key, "
                f"{ts('client_timestamp')} AS client_timestamp, {ts('created_at')} AS created_at, event_date, "
                f"country, user_segment, {ts('loaded_at')} AS loaded_at")

ORACLE["snapshot_streaks"] = with_warehouse(f"""
SELECT user_id, snapshot_date, current_streak, longest_streak, total_bestie_points, last_activity_date, timezone,
       {ts('loaded_at')} AS loaded_at FROM snapshot""")

ORACLE["stage_partition"] = with_warehouse(f"SELECT {_FACT_SELECT} FROM fact WHERE event_date = DATE '2024-01-15'")

ORACLE["weekly_streak_stats"] = with_warehouse("""
SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start, country,
       CAST(COUNT(DISTINCT user_id) AS BIGINT) AS active_users,
       round(AVG(total_points), 6) AS avg_daily_points, round(AVG(total_events), 6) AS avg_daily_events
FROM summaries GROUP BY 1, 2""")

ORACLE["weekly_active_refreshed"] = ORACLE["weekly_streak_stats"]

_BUCKET = "CASE " + " ".join(f"WHEN current_streak BETWEEN {low} AND {high} THEN '{label}'" for label, low, high in STREAK_BUCKETS) \
    + f" ELSE '{STREAK_BUCKET_ELSE}' END"
ORACLE["streak_distribution"] = with_warehouse(f"""
SELECT snapshot_date, {_BUCKET} AS streak_bucket,
       CAST(COUNT(*) AS BIGINT) AS user_count, round(AVG(total_bestie_points), 6) AS avg_bp
FROM snapshot GROUP BY 1, 2""")

_PERF = """
SELECT event_date, event_type, CAST(COUNT(*) AS BIGINT) AS event_count,
       CAST(SUM(points_awarded) AS BIGINT) AS total_points, CAST(COUNT(DISTINCT user_id) AS BIGINT) AS unique_users
FROM fact GROUP BY 1, 2"""
ORACLE["event_type_performance"] = with_warehouse(_PERF)
ORACLE["views_via_sql"] = with_warehouse(f"""
, weekly AS (SELECT date_trunc('week', event_date) AS w, country, COUNT(DISTINCT user_id) AS n FROM summaries GROUP BY 1, 2),
buckets AS (SELECT snapshot_date, {_BUCKET} AS bucket, COUNT(*) AS n FROM snapshot GROUP BY 1, 2),
perf AS (SELECT event_date, event_type, COUNT(*) AS n FROM fact GROUP BY 1, 2)
SELECT 'weekly_streak_stats' AS view_name, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(SUM(n) AS BIGINT) AS total FROM weekly
UNION ALL SELECT 'streak_distribution', CAST(COUNT(*) AS BIGINT), CAST(SUM(n) AS BIGINT) FROM buckets
UNION ALL SELECT 'event_type_performance', CAST(COUNT(*) AS BIGINT), CAST(SUM(n) AS BIGINT) FROM perf""")

ORACLE["warehouse_refresh"] = with_warehouse(f"""
SELECT {_FACT_SELECT} FROM (SELECT * REPLACE (
  CASE WHEN event_date = DATE '2024-01-15' THEN TIMESTAMP '2024-02-01 00:00:00' ELSE loaded_at END AS loaded_at) FROM fact)""")

ORACLE["merge_by_key"] = with_warehouse(f"""
, stg_raw AS (
  SELECT r.event_id, r.user_id, r.event_type, TRY_CAST(r.points_awarded AS INTEGER) AS points_awarded, r.source,
         r.idempotency_key, {_utc_parse('r.client_timestamp')} AS client_timestamp,
         r.created_at, CAST(r.created_at AS DATE) AS event_date, d.country, d.user_segment,
         TIMESTAMP '2024-02-01 00:00:00' AS loaded_at
  FROM kept r LEFT JOIN dim d USING (user_id) WHERE CAST(r.created_at AS DATE) = DATE '2024-01-15'),
stg AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY created_at, event_id) AS rn FROM stg_raw)
  WHERE rn = 1),
merged AS (
  SELECT * FROM fact WHERE idempotency_key IS NULL
     OR idempotency_key NOT IN (SELECT idempotency_key FROM stg WHERE idempotency_key IS NOT NULL)
  UNION ALL SELECT * FROM stg)
SELECT {_FACT_SELECT} FROM merged""".replace("\n, stg_raw AS", ", stg_raw AS"))


# --- anomaly rules, reconciliation, quality -----------------------------------------
def _num(col: str) -> str:
    return f"CAST(substr({col}, 5) AS BIGINT)"


def _streak_ctes(src: str, p: str) -> str:
    """Gaps-and-islands streak CTEs over a daily table ``src`` (prefix ``p``)."""
    return f""",
{p}days AS (SELECT DISTINCT user_id, activity_date FROM {src} WHERE activity_date IS NOT NULL),
{p}isl AS (SELECT *, activity_date - CAST(row_number() OVER (PARTITION BY user_id ORDER BY activity_date) AS INTEGER)
           AS island FROM {p}days),
{p}runs AS (SELECT user_id, island, COUNT(*) AS len, MAX(activity_date) AS run_end FROM {p}isl GROUP BY user_id, island),
{p}streaks AS (
  SELECT user_id, CAST(arg_max(len, run_end) AS BIGINT) AS current_streak, CAST(MAX(len) AS BIGINT) AS longest_streak,
         MAX(run_end) AS last_activity_date, CAST(SUM(len) AS BIGINT) AS version
  FROM {p}runs GROUP BY user_id),
{p}timeline AS (
  SELECT user_id, activity_date,
         CAST(row_number() OVER (PARTITION BY user_id, island ORDER BY activity_date) AS BIGINT) AS streak
  FROM {p}isl)"""


_FAULTS = f""",
stored AS (
  SELECT COALESCE(s.user_id, b.user_id) AS user_id,
         CASE WHEN {_num('s.user_id')} % {adapter.STREAK_JUMP_MOD} = 0 THEN s.current_streak + {adapter.STREAK_JUMP_DELTA}
              WHEN {_num('s.user_id')} % {adapter.STREAK_FAULT_MOD} = 0 THEN s.current_streak + 1
              ELSE s.current_streak END AS current_streak,
         s.longest_streak, s.last_activity_date, s.version,
         CASE WHEN {_num('b.user_id')} % {adapter.POINTS_FAULT_MOD} = 0
              THEN b.total_bestie_points + {adapter.POINTS_FAULT_DELTA} ELSE b.total_bestie_points END AS total_bestie_points,
         b.timezone, b.streak_updated_at
  FROM streaks s FULL JOIN balances b ON s.user_id = b.user_id),
daily_f AS (
  SELECT * FROM daily
  WHERE NOT ({_num('user_id')} % {adapter.MISSING_DAY_MOD} = 0 AND activity_date = DATE '{adapter.MISSING_DAY}')
  UNION ALL
  SELECT user_id, DATE '{adapter.ORPHAN_DAY}', MIN(first_event_id), CAST(1 AS BIGINT), CAST(0 AS BIGINT),
         TIMESTAMP '{adapter.ORPHAN_DAY} 00:00:00'
  FROM daily WHERE {_num('user_id')} % {adapter.ORPHAN_DAY_MOD} = 0 GROUP BY user_id)""" + _streak_ctes("daily_f", "f_") + f""",
updates AS (
  SELECT user_id, activity_date AS updated_on, streak AS current_streak FROM f_timeline
  UNION ALL
  SELECT user_id, DATE '{AS_OF_DATE}' + 1, current_streak FROM stored WHERE current_streak IS NOT NULL),
jumps AS (
  SELECT * FROM (
    SELECT user_id, updated_on, lag(current_streak) OVER (PARTITION BY user_id ORDER BY updated_on) AS previous_streak,
           current_streak FROM updates)
  WHERE current_streak - previous_streak > 1),
tzr AS (
  SELECT *, COALESCE(timezone <> lag(timezone) OVER (PARTITION BY user_id ORDER BY created_at, event_id), false) AS ch
  FROM acc),
tzr2 AS (SELECT *, {_trailing('CAST(ch AS BIGINT)', 24 * 3600 * 1000000, False, 'event_id')} AS recent FROM tzr),
tz_rule AS (SELECT * FROM tzr2 WHERE ch AND recent >= 2),
mx AS (SELECT *, (created_at AT TIME ZONE 'UTC') AT TIME ZONE timezone AS local_ts FROM acc),
mx2 AS (
  SELECT *, lag(timezone) OVER w AS previous_timezone, lag(local_ts) OVER w AS previous_local_ts FROM mx
  WINDOW w AS (PARTITION BY user_id ORDER BY created_at, event_id)),
midnight AS (
  SELECT * FROM mx2
  WHERE previous_timezone <> timezone
    AND hour(previous_local_ts) * 60 + minute(previous_local_ts) >= 1440 - {adapter.ORACLE_MIDNIGHT_MINUTES}
    AND hour(local_ts) * 60 + minute(local_ts) < {adapter.ORACLE_MIDNIGHT_MINUTES}
    AND CAST(local_ts AS DATE) = CAST(previous_local_ts AS DATE) + 1),
hourly AS (SELECT user_id, date_trunc('hour', created_at) AS hour, CAST(SUM(points_awarded) AS BIGINT) AS hour_points
           FROM enriched GROUP BY 1, 2),
dailyp AS (SELECT user_id, CAST(created_at AS DATE) AS day, SUM(points_awarded) AS day_points FROM enriched GROUP BY 1, 2),
meanp AS (SELECT user_id, AVG(day_points) AS daily_avg FROM dailyp GROUP BY 1),
spikes AS (SELECT h.*, m.daily_avg FROM hourly h JOIN meanp m USING (user_id)
           WHERE h.hour_points > {adapter.ORACLE_SPIKE_FACTOR} * m.daily_avg),
dupkeys AS (
  SELECT user_id, idempotency_key, CAST(COUNT(*) AS BIGINT) AS attempts, MIN(received_at) AS first_seen
  FROM adapted WHERE idempotency_key IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) >= {adapter.ORACLE_DUPLICATE_PATTERN}),
v7 AS (SELECT *, {_reason_sql(7)} AS reason7 FROM v),
drift AS (
  SELECT a.user_id, a.current_streak AS analytical_streak, o.current_streak AS operational_streak,
         abs(a.current_streak - o.current_streak) AS drift,
         CASE WHEN abs(a.current_streak - o.current_streak) <= 1 THEN 'auto_fix' ELSE 'alert' END AS action
  FROM streaks a JOIN stored o ON a.user_id = o.user_id WHERE a.current_streak <> o.current_streak)"""


def with_faults(body: str) -> str:
    return with_ingest(body, extra=_FAULTS)


ORACLE["timezone_changes"] = with_ingest(f"""
SELECT user_id, event_id, {ts('created_at')} AS created_at, previous_timezone, timezone FROM (
  SELECT *, lag(timezone) OVER (PARTITION BY user_id ORDER BY created_at, event_id) AS previous_timezone FROM acc)
WHERE previous_timezone IS NOT NULL AND timezone <> previous_timezone""")

ORACLE["timezone_abuse_rule"] = with_faults(f"SELECT user_id, event_id, {ts('created_at')} AS created_at, timezone FROM tz_rule")

ORACLE["rate_flag_rule"] = with_ingest(
    f"SELECT row_id, user_id, attempts_last_hour FROM counted WHERE attempts_last_hour > {adapter.ORACLE_RATE_LIMIT}")

ORACLE["streak_jumps"] = with_faults("""
SELECT user_id, updated_on, previous_streak, current_streak, current_streak - previous_streak AS step FROM jumps""")

ORACLE["midnight_exploit"] = with_faults(f"""
SELECT user_id, event_id, timezone, previous_timezone, {ts('local_ts')} AS local_ts,
       {ts('previous_local_ts')} AS previous_local_ts FROM midnight""")

ORACLE["points_spike"] = with_faults(f"""
SELECT user_id, {ts('hour')} AS hour, hour_points, round(daily_avg, 6) AS daily_avg FROM spikes""")

ORACLE["impossible_timestamps"] = with_ingest("""
SELECT row_id, user_id, reason FROM verdicts
WHERE reason IN ('client_timestamp is too far in the future', 'client_timestamp is too far in the past')""",
                                              max_age_days=7, rate_limit=100)

ORACLE["duplicate_keys"] = with_faults(f"""
SELECT user_id, idempotency_key, attempts, {ts('first_seen')} AS first_seen FROM dupkeys""")

ORACLE["duplicate_share"] = with_ctes("""
SELECT user_id, CAST(SUM(n) AS BIGINT) AS attempts, CAST(SUM(n) - COUNT(*) AS BIGINT) AS repeats,
       round((SUM(n) - COUNT(*)) / SUM(n), 6) AS repeat_share
FROM pk GROUP BY user_id""", curate=False, extra=""",
pk AS (SELECT user_id, idempotency_key, COUNT(*) AS n FROM adapted GROUP BY 1, 2)""")

_SEV = {
    "rate_limit": ("Medium", "throttle"),
    "impossible_timestamp": ("High", "reject"),
    "timezone_abuse": ("High", "flag_for_review"),
    "streak_jump": ("Critical", "block_update"),
    "midnight_exploit": ("High", "server_side_tz"),
    "points_spike": ("Medium", "queue_for_review"),
    "duplicate_pattern": ("Medium", "flag_for_review"),
}


def _log(rule: str, at: str, detail: str, src: str) -> str:
    sev, act = _SEV[rule]
    return (f"SELECT '{rule}' AS rule, user_id, {ts(at)} AS at, '{sev}' AS severity, '{act}' AS action, "
            f"CAST({detail} AS VARCHAR) AS detail FROM {src}")


ORACLE["anomaly_log"] = with_faults("\nUNION ALL ".join([
    _log("rate_limit", "created_at", "attempts_last_hour", f"counted WHERE attempts_last_hour > {adapter.ORACLE_RATE_LIMIT}"),
    _log("impossible_timestamp", "parsed", "reason7",
         "v7 WHERE reason7 IN ('client_timestamp is too far in the future', 'client_timestamp is too far in the past')"),
    _log("timezone_abuse", "created_at", "timezone", "tz_rule"),
    _log("streak_jump", "CAST(updated_on AS TIMESTAMP)", "current_streak - previous_streak", "jumps"),
    _log("midnight_exploit", "created_at", "previous_timezone || '->' || timezone", "midnight"),
    _log("points_spike", "hour", "hour_points", "spikes"),
    _log("duplicate_pattern", "first_seen", "attempts", "dupkeys"),
]))

ORACLE["streak_audit"] = with_ingest(f"""
SELECT substr(sha256(user_id || '|' || CAST(activity_date AS VARCHAR)), 1, 32) AS audit_id, user_id,
       'STREAK_UPDATE' AS action, lag(streak) OVER (PARTITION BY user_id ORDER BY activity_date) AS old_streak,
       streak AS new_streak, 'streak_recompute' AS trigger,
       {ts("CAST(activity_date AS TIMESTAMP) + INTERVAL 12 HOUR")} AS timestamp,
       CAST(epoch(CAST(activity_date AS TIMESTAMP) + INTERVAL 12 HOUR) AS BIGINT) + 365 * 86400 AS ttl
FROM t_timeline""", extra=_streak_ctes("daily", "t_"))

ORACLE["streak_drift"] = with_faults("SELECT * FROM drift")

ORACLE["reconcile_points"] = with_faults("""
SELECT COALESCE(s.user_id, t.user_id) AS user_id, COALESCE(s.events_sum, 0) AS events_sum,
       COALESCE(CAST(t.total_bestie_points AS BIGINT), 0) AS stored_total,
       CASE WHEN COALESCE(s.events_sum, 0) = COALESCE(CAST(t.total_bestie_points AS BIGINT), 0) THEN 'MATCH'
            ELSE 'MISMATCH' END AS status
FROM (SELECT user_id, CAST(SUM(points_awarded) AS BIGINT) AS events_sum FROM acc GROUP BY user_id) s
FULL JOIN stored t ON s.user_id = t.user_id""")

ORACLE["reconcile_streaks"] = with_faults("""
SELECT COALESCE(r.user_id, s.user_id) AS user_id,
       r.current_streak AS recomputed_current_streak, r.longest_streak AS recomputed_longest_streak,
       r.last_activity_date AS recomputed_last_activity_date,
       s.current_streak AS stored_current_streak, s.longest_streak AS stored_longest_streak,
       s.last_activity_date AS stored_last_activity_date
FROM f_streaks r FULL JOIN stored s ON r.user_id = s.user_id
WHERE r.current_streak IS DISTINCT FROM s.current_streak OR r.longest_streak IS DISTINCT FROM s.longest_streak
   OR r.last_activity_date IS DISTINCT FROM s.last_activity_date""")

ORACLE["missing_activity"] = with_faults(f"""
SELECT user_id, activity_date, first_event_id, events_count, points_earned, {ts('created_at')} AS created_at
FROM daily d WHERE NOT EXISTS (
  SELECT 1 FROM daily_f f WHERE f.user_id = d.user_id AND f.activity_date = d.activity_date)""")

ORACLE["orphan_activity"] = with_faults(f"""
SELECT user_id, activity_date, first_event_id, events_count, points_earned, {ts('created_at')} AS created_at
FROM daily_f f WHERE NOT EXISTS (
  SELECT 1 FROM acc a WHERE a.user_id = f.user_id AND a.activity_date = f.activity_date)""")

ORACLE["snapshot_parity"] = with_faults("""
SELECT user_id, in_a, in_b, differing_columns,
       differing_columns = '' AND in_a AND in_b AS parity FROM (
  SELECT COALESCE(a.user_id, b.user_id) AS user_id, a.user_id IS NOT NULL AS in_a, b.user_id IS NOT NULL AS in_b,
         concat_ws(',',
           CASE WHEN a.current_streak IS DISTINCT FROM b.current_streak THEN 'current_streak' END,
           CASE WHEN a.longest_streak IS DISTINCT FROM b.longest_streak THEN 'longest_streak' END,
           CASE WHEN a.total_bestie_points IS DISTINCT FROM b.total_bestie_points THEN 'total_bestie_points' END)
           AS differing_columns
  FROM stored a FULL JOIN (
    SELECT COALESCE(s.user_id, bl.user_id) AS user_id, s.current_streak, s.longest_streak, bl.total_bestie_points
    FROM streaks s FULL JOIN balances bl ON s.user_id = bl.user_id) b ON a.user_id = b.user_id)""")

ORACLE["correction_audit"] = with_faults(f"""
SELECT substr(sha256('reconcile|' || user_id || '|{adapter.RECONCILE_AT}'), 1, 32) AS audit_id, user_id,
       'STREAK_CORRECTION' AS action, operational_streak AS old_streak, analytical_streak AS new_streak,
       'nightly_reconcile' AS trigger, '{adapter.RECONCILE_AT}.000000' AS timestamp,
       CAST(epoch(TIMESTAMP '{adapter.RECONCILE_AT}') AS BIGINT) + 365 * 86400 AS ttl
FROM drift WHERE action = 'auto_fix'""")

ORACLE["dq_checks"] = with_ctes("""
SELECT 'daily_summaries' AS table_name, 'schema' AS check_name, true AS passed, '' AS detail
UNION ALL SELECT 'daily_summaries', 'non_empty', COUNT(*) > 0, CAST(COUNT(*) AS VARCHAR) FROM summ
UNION ALL SELECT 'daily_summaries', 'key_unique:user_id,event_date', COUNT(*) = 0, CAST(COUNT(*) AS VARCHAR)
          FROM (SELECT user_id, event_date FROM summ GROUP BY 1, 2 HAVING COUNT(*) > 1)
UNION ALL SELECT 'bp_events', 'key_unique:idempotency_key', COUNT(*) = 0, CAST(COUNT(*) AS VARCHAR)
          FROM (SELECT idempotency_key FROM enriched GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'bp_events', 'row_preserving', (SELECT COUNT(*) FROM clean) = (SELECT COUNT(*) FROM enriched),
          CAST((SELECT COUNT(*) FROM clean) AS VARCHAR) || '->' || CAST((SELECT COUNT(*) FROM enriched) AS VARCHAR)
UNION ALL SELECT 'bp_events', 'not_increasing', (SELECT COUNT(*) FROM flagged) <= (SELECT COUNT(*) FROM raw),
          CAST((SELECT COUNT(*) FROM raw) AS VARCHAR) || '->' || CAST((SELECT COUNT(*) FROM flagged) AS VARCHAR)""",
                              extra=""",
summ AS (SELECT user_id, event_date FROM enriched GROUP BY user_id, event_date, country, user_segment)""")

ORACLE["ingest_error_rate"] = with_ingest(f"""
SELECT {ts('w')} AS window_start, {ts("w + INTERVAL 1 HOUR")} AS window_end, attempts, errors,
       round(errors / attempts, 6) AS error_rate, errors / attempts > 0.01 AS alert FROM (
  SELECT date_trunc('hour', received_at) AS w, CAST(COUNT(*) AS BIGINT) AS attempts,
         CAST(SUM(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors
  FROM verdicts GROUP BY 1)""")

ORACLE["update_lag"] = with_ingest("""
SELECT activity_date, CAST(COUNT(*) AS BIGINT) AS updates, round(AVG(lag_s), 6) AS avg_lag_seconds,
       round(MAX(lag_s), 6) AS max_lag_seconds, CAST(COUNT(*) FILTER (WHERE lag_s > 5) AS BIGINT) AS late_updates
FROM (SELECT activity_date, (epoch_us(received_at) - epoch_us(created_at)) / 1000000.0 AS lag_s FROM acc)
GROUP BY activity_date""")

ORACLE["partition_gaps"] = with_ctes(f"""
SELECT {ts('h')} AS hour
FROM generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR) AS g(h)
WHERE h NOT IN (SELECT DISTINCT date_trunc('hour', created_at) FROM raw)""", curate=False)

ORACLE["attempts_by_hour"] = with_ingest(f"""
SELECT user_id, {ts("date_trunc('hour', created_at)")} AS hour, CAST(COUNT(*) AS BIGINT) AS attempts
FROM acc GROUP BY 1, 2""")


ORACLE["new_partitions"] = with_ctes("""
SELECT DISTINCT CAST(year(created_at) AS INTEGER) AS year, CAST(month(created_at) AS INTEGER) AS month,
       CAST(day(created_at) AS INTEGER) AS day, CAST(hour(created_at) AS INTEGER) AS hour
FROM raw WHERE day(created_at) >= 15""", curate=False)

ORACLE["drop_seen"] = with_ctes(f"""
SELECT idempotency_key, event_id, TRY_CAST(points_awarded AS INTEGER) AS points_awarded, {ts('created_at')} AS created_at
FROM kept WHERE CAST(created_at AS DATE) = DATE '2024-01-15'
  AND (idempotency_key IS NULL
       OR idempotency_key NOT IN (SELECT idempotency_key FROM enriched WHERE idempotency_key IS NOT NULL))""")

ORACLE["first_writer_wins"] = with_ctes("""
SELECT idempotency_key, event_id, idempotency_key IS NOT NULL AND event_id <> first_id AS is_duplicate,
       CASE WHEN idempotency_key IS NOT NULL AND event_id <> first_id THEN first_id END AS original_event_id
FROM (SELECT *, first_value(event_id) OVER (PARTITION BY idempotency_key ORDER BY created_at, event_id) AS first_id
      FROM kept)""")

_CUT = "2024-01-16"
ORACLE["first_writer_history"] = with_ctes(f"""
SELECT idempotency_key, event_id, idempotency_key IS NOT NULL AND (hist_id IS NOT NULL OR event_id <> first_id) AS is_duplicate,
       CASE WHEN idempotency_key IS NOT NULL AND (hist_id IS NOT NULL OR event_id <> first_id) THEN COALESCE(hist_id, first_id) END
       AS original_event_id
FROM (SELECT b.*, h.hist_id, first_value(b.event_id) OVER (PARTITION BY b.idempotency_key ORDER BY b.created_at, b.event_id) AS first_id
      FROM batch b LEFT JOIN (SELECT idempotency_key, min(event_id) AS hist_id FROM enriched WHERE event_date < DATE '{_CUT}'
                              GROUP BY 1) h ON b.idempotency_key = h.idempotency_key)""", extra=f""",
batch AS (SELECT * FROM kept WHERE created_at >= TIMESTAMP '{_CUT}' OR CAST(event_id AS BIGINT) >= {adapter.DUP_ID_OFFSET})""")

ORACLE["drop_seen_history"] = with_ctes(f"""
SELECT idempotency_key, event_id, {ts('created_at')} AS created_at FROM kept k
WHERE (created_at >= TIMESTAMP '{_CUT}' OR CAST(event_id AS BIGINT) >= {adapter.DUP_ID_OFFSET})
  AND NOT EXISTS (SELECT 1 FROM enriched e WHERE e.event_date < DATE '{_CUT}' AND e.idempotency_key = k.idempotency_key)""")

ORACLE["live_events"] = with_ingest(f"""
SELECT user_id, event_id, ttl, {ts('created_at')} AS created_at FROM acc
WHERE ttl > CAST(epoch(TIMESTAMP '2024-04-15 00:00:00') AS BIGINT)""")

# where a count that begins at an attempt is followed by the next one: at a gap of an
# hour before it is full, else at the first attempt an hour after it is full
ORACLE["rate_limit_exact"] = with_ingest(f"""
SELECT row_id, user_id, {ts('created_at')} AS created_at, rn < begun + {adapter.ORACLE_RATE_LIMIT} AS allowed
FROM (SELECT n.*, max(s.rn) OVER (PARTITION BY n.user_id ORDER BY n.rn ROWS UNBOUNDED PRECEDING) AS begun
      FROM numbered n LEFT JOIN begins s ON s.user_id = n.user_id AND s.rn = n.rn)""", extra=f""",
numbered AS (
  SELECT row_id, user_id, created_at, epoch_us(created_at) AS t, row_number() OVER w AS rn,
         epoch_us(created_at) - lag(epoch_us(created_at)) OVER w >= 3600000000 AS gap
  FROM valid WINDOW w AS (PARTITION BY user_id ORDER BY created_at, row_id)),
ahead AS (
  SELECT *, lead(t, {adapter.ORACLE_RATE_LIMIT - 1}) OVER (PARTITION BY user_id ORDER BY rn) + 3600000000 AS free_at,
         min(CASE WHEN gap THEN rn END) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_gap
  FROM numbered),
instants AS (SELECT user_id, t, min(rn) AS rn FROM numbered GROUP BY 1, 2),
onward AS MATERIALIZED (
  SELECT a.user_id, a.rn, CASE WHEN a.next_gap < a.rn + {adapter.ORACLE_RATE_LIMIT} THEN a.next_gap ELSE i.rn END AS next_rn
  FROM ahead a ASOF LEFT JOIN instants i ON a.user_id = i.user_id AND a.free_at <= i.t),
begins AS (
  SELECT DISTINCT user_id, CAST(1 AS BIGINT) AS rn FROM numbered
  UNION
  SELECT o.user_id, o.next_rn FROM begins b JOIN onward o ON o.user_id = b.user_id AND o.rn = b.rn WHERE o.next_rn IS NOT NULL)"""
).replace("WITH", "WITH RECURSIVE", 1)

ORACLE["lag_percentiles"] = with_ingest("""
SELECT activity_date, updates, p50_sketch, p95_sketch, p99_sketch, p50, p95, p99
FROM (SELECT activity_date, CAST(COUNT(*) AS BIGINT) AS updates, round(quantile_disc(lag_s, 0.50), 6) AS p50,
             round(quantile_disc(lag_s, 0.95), 6) AS p95, round(quantile_disc(lag_s, 0.99), 6) AS p99,
             round(middle(quantile_disc(b, 0.50)), 6) AS p50_sketch, round(middle(quantile_disc(b, 0.95)), 6) AS p95_sketch,
             round(middle(quantile_disc(b, 0.99)), 6) AS p99_sketch
      FROM (SELECT activity_date, lag_s, CASE WHEN lag_s <= 0.000001 THEN 0 ELSE CAST(ceil(ln(lag_s * 1000000.0) / ln(1.02)) AS BIGINT) END AS b
            FROM (SELECT activity_date, (epoch_us(received_at) - epoch_us(created_at)) / 1000000.0 AS lag_s FROM acc))
      GROUP BY activity_date)""".replace("middle(quantile_disc(b, 0.50))", _middle(0.50)).replace("middle(quantile_disc(b, 0.95))", _middle(0.95))
    .replace("middle(quantile_disc(b, 0.99))", _middle(0.99)))
