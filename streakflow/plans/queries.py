"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver tables. Their DuckDB twins
are in ``streakflow.plans.oracle``; column names and types match."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from streakflow.operators import dedup, rollups, validate
from streakflow.plans import curate as curate_plan
from streakflow.plans.inputs import adapted, finish, raw, user_dim
from streakflow.sources import adapter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def _curated(spark, sf_dir) -> curate_plan.Curated:
    return curate_plan.curate(raw(spark, sf_dir), user_dim(spark, sf_dir))


# --- P1 slice -------------------------------------------------------------

@query("daily_summaries")
def q_daily_summaries(spark, sf_dir):
    """E1 over the curated batch."""
    return finish(_curated(spark, sf_dir).summaries)


@query("curated_events")
def q_curated_events(spark, sf_dir):
    """P1 curated events: deduplicated, typed, clean, enriched."""
    c = _curated(spark, sf_dir)
    return finish(c.events.select("user_id", "event_id", "event_type", "points_awarded", "source",
                                  "idempotency_key", "client_timestamp", "created_at", "ttl",
                                  "event_date", "country", "signup_date", "user_segment"))


@query("anomalous_points")
def q_anomalous_points(spark, sf_dir):
    """B9 anomalous branch (points outside 0..100)."""
    c = _curated(spark, sf_dir)
    return finish(c.anomalies.select("user_id", "event_id", "event_type", "points_awarded",
                                     "idempotency_key", "created_at", "event_date", "is_anomalous"))


@query("dedup_first")
def q_dedup_first(spark, sf_dir):
    """D1 on the raw rows: earliest per idempotency key."""
    r = validate.drop_null_keys(raw(spark, sf_dir))
    return finish(dedup.dedup_first(r).select("idempotency_key", "event_id", "created_at"))


@query("user_dim")
def q_user_dim(spark, sf_dir):
    """A3 shape of the user dimension."""
    return user_dim(spark, sf_dir)


@query("quality_funnel")
def q_quality_funnel(spark, sf_dir):
    """Raw -> deduplicated -> anomaly-free -> enriched counts."""
    return curate_plan.quality_funnel(raw(spark, sf_dir), user_dim(spark, sf_dir))


# --- P2 ingest ---------------------------------------------------------------
from streakflow.config import Limits  # noqa: E402
from streakflow.operators import anomaly, streaks, warehouse  # noqa: E402
from streakflow.plans import ingest as ingest_plan  # noqa: E402
from streakflow.sources import readers, sinks, versions  # noqa: E402

ORACLE_LIMITS = Limits(max_age_days=adapter.ORACLE_MAX_AGE_DAYS, rate_limit=adapter.ORACLE_RATE_LIMIT,
                       duplicate_pattern_min=adapter.ORACLE_DUPLICATE_PATTERN,
                       midnight_minutes=adapter.ORACLE_MIDNIGHT_MINUTES)
AS_OF_DATE = adapter.AS_OF[:10]
LOADED_AT = "2024-01-31 01:00:00"


def _ingested(spark, sf_dir, limits: Limits = ORACLE_LIMITS) -> ingest_plan.Ingested:
    return ingest_plan.ingest_batch(adapter.payloads(adapted(spark, sf_dir)), adapter.AS_OF, limits)


def _classified(spark, sf_dir):
    """The classified attempts, written once for the branches of one query."""
    attempts = adapter.payloads(adapted(spark, sf_dir)).select("row_id", *ingest_plan.PAYLOAD_COLUMNS)
    return sinks.staged(ingest_plan.classify(attempts, adapter.AS_OF, ORACLE_LIMITS))


#: What daily activity, balances and streaks are made of.
ACTIVITY_COLUMNS = ("user_id", "event_id", "points_awarded", "created_at", "timezone", "activity_date")


def _staged(spark, sf_dir, columns=None):
    """The accepted log (or some of its columns), written once for the branches of one query."""
    return _accepted(spark, sf_dir, columns, written=True)


def _accepted(spark, sf_dir, columns=None, written=False):
    return ingest_plan.accept(adapter.payloads(adapted(spark, sf_dir)), adapter.AS_OF, ORACLE_LIMITS,
                              columns=columns, written=written)


def _daily(spark, sf_dir):
    return ingest_plan.daily_activity(_accepted(spark, sf_dir, ACTIVITY_COLUMNS))


def _state(spark, sf_dir, acc=None):
    """User streak state: F2 streaks + E3 balances + country shard."""
    acc = acc if acc is not None else _staged(spark, sf_dir)
    s = streaks.streaks(ingest_plan.daily_activity(acc), AS_OF_DATE)
    b = ingest_plan.point_balances(acc)
    d = user_dim(spark, sf_dir).select("user_id", "country")
    return s.join(b, "user_id", "full").join(d, "user_id", "left")


VERDICT_COLS = ("row_id", "user_id", "status", "reason", "event_id", "original_event_id", "http_status")



@query("ingest_verdicts")
def q_ingest_verdicts(spark, sf_dir):
    """Verdict of every attempt (oracle limits)."""
    return _ingested(spark, sf_dir).verdicts.select(*VERDICT_COLS)


@query("ingest_verdicts_default_limits")
def q_ingest_verdicts_default(spark, sf_dir):
    """B6 with the reference's 7-day window and 100/hour limit."""
    return _ingested(spark, sf_dir, Limits()).verdicts.select(*VERDICT_COLS)


@query("parse_payload")
def q_parse_payload(spark, sf_dir):
    """A2: JSON bodies parsed back to payload columns."""
    p = readers.parse_payload(adapter.payload_json(adapted(spark, sf_dir)))
    return finish(p.select("row_id", "user_id", "event_type", "client_timestamp", "timezone", "idempotency_key",
                           "source", F.col("metadata")["k"].alias("metadata_k"), "corrupt_body", "received_at"))


@query("accepted_events")
def q_accepted_events(spark, sf_dir):
    """B8 B11 B13 B14 on the processed attempts, with local activity date."""
    return finish(_accepted(spark, sf_dir))


@query("ingest_report")
def q_ingest_report(spark, sf_dir):
    """Attempts per user and status."""
    return ingest_plan.ingest_report(_ingested(spark, sf_dir).verdicts)


@query("user_profile")
def q_user_profile(spark, sf_dir):
    """Attempts, distinct types and sources per user (raw payloads)."""
    return rollups.user_profile(adapter.payloads(adapted(spark, sf_dir)))


@query("daily_activity")
def q_daily_activity(spark, sf_dir):
    """Per user and local day."""
    return finish(_daily(spark, sf_dir))


@query("point_balances")
def q_point_balances(spark, sf_dir):
    """Lifetime points, latest zone, last update."""
    return finish(ingest_plan.point_balances(_accepted(spark, sf_dir)))


@query("streaks")
def q_streaks(spark, sf_dir):
    """current, longest, last day, version, effective streak."""
    return streaks.streaks(_daily(spark, sf_dir), AS_OF_DATE)


@query("streaks_late_days")
def q_streaks_late(spark, sf_dir):
    """F2/S13 over stored month blocks: two batches of days come late and out of order, one
    of them twice; only the streaks of their users are derived anew."""
    from streakflow.operators import streak_runs
    daily = sinks.staged(_daily(spark, sf_dir).select("user_id", "activity_date"))
    late = F.pmod(F.xxhash64("user_id", "activity_date"), F.lit(5))
    on_time = streak_runs.month_blocks(daily.where(late > 1))
    state = streak_runs.streaks_of(on_time)
    batches = [daily.where(late == 0), daily.where(late == 1), daily.where(late == 0)]
    blocks = sinks.staged(streak_runs.merge_blocks(on_time, *[streak_runs.month_blocks(b) for b in batches]))
    users = daily.where(late <= 1).select("user_id").distinct()
    return streaks.effective_streak(streak_runs.repair(state, blocks, users), AS_OF_DATE)


@query("streak_timeline")
def q_streak_timeline(spark, sf_dir):
    """running streak per user-day."""
    return streaks.streak_timeline(_daily(spark, sf_dir))


@query("points_timeline")
def q_points_timeline(spark, sf_dir):
    """cumulative points per user-day of the curated events."""
    return streaks.points_timeline(_curated(spark, sf_dir).events)


@query("leaderboard_by_country")
def q_leaderboard(spark, sf_dir):
    """Top 3 per country by streak, points, user."""
    lb = streaks.leaderboard(_state(spark, sf_dir), n=3, by="country")
    return lb.select("leaderboard_partition", "rank", "user_id", "current_streak", "total_bestie_points")


@query("leaderboard_global")
def q_leaderboard_global(spark, sf_dir):
    """global top 100."""
    lb = streaks.leaderboard(_state(spark, sf_dir), n=100, by=None)
    return lb.select("leaderboard_partition", "rank", "user_id", "current_streak", "total_bestie_points")


@query("user_streak_lookup")
def q_user_streak(spark, sf_dir):
    """G1: state of the users of one nation (semi join)."""
    wanted = user_dim(spark, sf_dir).where(F.col("country") == "NATION_3").select("user_id")
    return finish(streaks.user_streak(_state(spark, sf_dir), wanted).select(
        "user_id", "current_streak", "longest_streak", "last_activity_date", "total_bestie_points", "timezone"))


@query("points_history")
def q_points_history(spark, sf_dir):
    """Last 30 days of events of the users of one nation."""
    wanted = user_dim(spark, sf_dir).where(F.col("country") == "NATION_3").select("user_id")
    ev = _curated(spark, sf_dir).events
    return finish(streaks.points_history(ev, wanted, AS_OF_DATE, 30).select(
        "user_id", "event_id", "event_type", "points_awarded", "created_at", "event_date"))


# --- P3 warehouse --------------------------------------------------------------

def _fact(spark, sf_dir):
    from streakflow import schemas
    return readers.align_columns(_curated(spark, sf_dir).events, schemas.FACT_BP_EVENTS, LOADED_AT,
                                 schemas.FACT_LOAD_COLUMNS)


def _snapshot(spark, sf_dir):
    return readers.snapshot_streaks(_state(spark, sf_dir), AS_OF_DATE, LOADED_AT)


@query("snapshot_streaks")
def q_snapshot(spark, sf_dir):
    """dim_user_streaks rows."""
    return finish(_snapshot(spark, sf_dir))


@query("stage_partition")
def q_stage(spark, sf_dir):
    """One curated date in the staging shape."""
    return finish(readers.stage_partition(_curated(spark, sf_dir).events, "2024-01-15", LOADED_AT))


@query("weekly_streak_stats")
def q_weekly(spark, sf_dir):
    """E4 over the daily summaries."""
    return finish(warehouse.weekly_streak_stats(_curated(spark, sf_dir).summaries))


@query("weekly_active_refreshed")
def q_weekly_refreshed(spark, sf_dir):
    """E4 by refreshes: bitmaps of the first days, then of later days and of one day again,
    merged by week; new users get their numbers with the refresh that brings them."""
    from streakflow.operators import active_users
    summaries = sinks.staged(_curated(spark, sf_dir).summaries.select(
        "user_id", "event_date", "country", "total_points", "total_events"))
    first, then = summaries.where("event_date < '2024-01-17'"), summaries.where("event_date >= '2024-01-16'")
    known = sinks.staged(active_users.number_users(first))
    numbers = known.unionByName(sinks.staged(active_users.number_users(then, known)))
    stored = sinks.staged(active_users.daily_pieces(first, known))
    pieces = active_users.replace_days(stored, active_users.daily_pieces(then, numbers))
    return finish(active_users.weekly_stats(active_users.weekly_pieces(pieces)))


@query("streak_distribution")
def q_distribution(spark, sf_dir):
    """E5 over the streak snapshot."""
    return finish(warehouse.streak_distribution(_snapshot(spark, sf_dir)))


@query("event_type_performance")
def q_event_perf(spark, sf_dir):
    """E6 over the fact table."""
    return warehouse.event_type_performance(_fact(spark, sf_dir))


@query("views_via_sql")
def q_views_sql(spark, sf_dir):
    """All three views by name in SQL: rows and total of each."""
    warehouse.register_views(warehouse.weekly_streak_stats(_curated(spark, sf_dir).summaries, 6),
                             warehouse.streak_distribution(_snapshot(spark, sf_dir), 6),
                             warehouse.event_type_performance(_fact(spark, sf_dir)))
    return spark.sql("""
        SELECT 'weekly_streak_stats' AS view_name, count(*) AS n_rows, sum(active_users) AS total FROM v_weekly_streak_stats
        UNION ALL SELECT 'streak_distribution', count(*), sum(user_count) FROM v_streak_distribution
        UNION ALL SELECT 'event_type_performance', count(*), sum(event_count) FROM v_event_type_performance""")


@query("merge_by_key")
def q_merge(spark, sf_dir):
    """The fact after merging one re-staged date whose rows come from
    the raw lake (duplicates and out-of-range points included, deduplicated
    in staging)."""
    from streakflow import schemas
    fact = _fact(spark, sf_dir)
    r = validate.enforce_types(validate.drop_null_keys(raw(spark, sf_dir)))
    r = dedup.enrich(r, user_dim(spark, sf_dir))
    stg = readers.stage_partition(r, "2024-01-15", "2024-02-01 00:00:00")
    return finish(warehouse.merge_by_key(fact, stg).select(*schemas.FACT_BP_EVENTS.fieldNames()))


@query("warehouse_refresh")
def q_warehouse_refresh(spark, sf_dir):
    """P3 as a plan: the fact written by date, then one curated date loaded again through the
    key index; only the dates that the index names are read and rewritten."""
    from streakflow import schemas
    from streakflow.plans import warehouse as warehouse_plan
    lake, fact_path = sinks.shared_path(spark, "lake"), sinks.shared_path(spark, "fact")
    sinks.write_partitioned(_curated(spark, sf_dir).events, lake)
    events = spark.read.parquet(lake)
    sinks.write_partitioned(readers.align_columns(events, schemas.FACT_BP_EVENTS, LOADED_AT, schemas.FACT_LOAD_COLUMNS), fact_path)
    warehouse_plan.refresh_fact(spark, lake, fact_path, "2024-01-15", "2024-02-01 00:00:00")
    return finish(spark.read.parquet(fact_path).select(*schemas.FACT_BP_EVENTS.fieldNames()))


def _versioned(spark, sf_dir):
    """Raw hours landed and curated in two increments, the hours before noon first."""
    lake, root = sinks.shared_path(spark, "raw"), sinks.shared_path(spark, "versioned")
    landed = sinks.with_hour_partitions(raw(spark, sf_dir))
    for half in (F.col("hour") < 12, F.col("hour") >= 12):
        # one file an hour and range: small hours do not become many files
        (landed.where(half).repartitionByRange("year", "month", "day", "hour", "event_id").write.mode("append")
         .partitionBy("year", "month", "day", "hour").parquet(lake))
        held = curate_plan.curate_new_hours(spark, lake, user_dim(spark, sf_dir), root)
    return root, held


@query("curated_versions")
def q_curated_versions(spark, sf_dir):
    """A9 + P1 through the ledger: the summaries of the newest committed version."""
    root, held = _versioned(spark, sf_dir)
    summaries = versions.read(spark, root, held, "daily_summaries")
    return finish(summaries.select(*_curated(spark, sf_dir).summaries.columns))


@query("processing_ledger")
def q_processing_ledger(spark, sf_dir):
    """The hours that the ledger has, each with the commit that recorded it."""
    root, held = _versioned(spark, sf_dir)
    return versions.read_ledger(spark, root, held).select("year", "month", "day", "hour", F.col("v").cast("int").alias("version"))


@query("daily_compacted")
def q_daily_compacted(spark, sf_dir):
    """The daily table written in 18 micro-batches and merged by levels of four."""
    from streakflow.streaming import jobs
    landed, path = sinks.shared_path(spark, "micro"), sinks.shared_path(spark, "daily")
    accepted = _accepted(spark, sf_dir).withColumns(
        {"status": F.lit("processed"), "micro": F.pmod(F.xxhash64("event_id"), F.lit(18))})
    accepted.write.partitionBy("micro").parquet(landed)  # a folder a batch, so that each batch reads its own rows only
    arrived = spark.read.schema(accepted.schema).parquet(landed)
    upsert = jobs.daily_upsert(path, fan=4)
    for n in range(18):
        upsert(arrived.where(F.col("micro") == n), n)
    return finish(jobs.read_daily(spark, path))


# --- F6-F15 anomaly rules --------------------------------------------------------
from streakflow.operators import quality, reconcile  # noqa: E402
from streakflow.operators.windows import hot_keys  # noqa: E402

SPIKE_LIMITS = Limits(spike_factor=adapter.ORACLE_SPIKE_FACTOR)


def _dense(spark, sf_dir):
    """Users with several events in a day, counted on the attempts: few rows make a user
    dense here, so that the tables given exercise both forms of the windows."""
    return hot_keys(adapted(spark, sf_dir).select("user_id", "created_at"), ["user_id"], "created_at", floor=5)


def _valid_attempts(spark, sf_dir):
    v = validate.validation(adapter.payloads(adapted(spark, sf_dir)), adapter.AS_OF, ORACLE_LIMITS)
    return v.where(F.col("reject_status").isNull())


def _stored(spark, sf_dir, acc=None):
    acc = acc if acc is not None else _staged(spark, sf_dir)
    return adapter.stored_state_with_faults(streaks.streaks(ingest_plan.daily_activity(acc)),
                                            ingest_plan.point_balances(acc))


def _streak_updates(spark, sf_dir, acc=None):
    """Streak values in update order: the timeline of the (faulty) daily
    table, then the stored state as the latest write."""
    acc = acc if acc is not None else _staged(spark, sf_dir)
    tl = streaks.streak_timeline(adapter.daily_with_faults(ingest_plan.daily_activity(acc)))
    st = _stored(spark, sf_dir, acc).where(F.col("current_streak").isNotNull())
    return tl.select("user_id", F.col("activity_date").alias("updated_on"), F.col("streak").alias("current_streak")) \
        .unionByName(st.select("user_id", F.date_add(F.lit(AS_OF_DATE).cast("date"), 1).alias("updated_on"),
                               "current_streak"))


@query("timezone_changes")
def q_timezone_changes(spark, sf_dir):
    """accepted events whose zone differs from the user's previous one."""
    ch = anomaly.timezone_changes(_staged(spark, sf_dir), dense=_dense(spark, sf_dir))
    return finish(ch.select("user_id", "event_id", "created_at", "previous_timezone", "timezone"))


@query("timezone_abuse_rule")
def q_timezone_abuse(spark, sf_dir):
    """F7 as a rule over the accepted log."""
    t = anomaly.timezone_abuse(_staged(spark, sf_dir), ORACLE_LIMITS, dense=_dense(spark, sf_dir))
    return finish(t.where("tz_abuse").select("user_id", "event_id", "created_at", "timezone"))


@query("rate_flag_rule")
def q_rate_flag(spark, sf_dir):
    """Valid attempts beyond the hourly limit."""
    r = anomaly.rate_flag(_valid_attempts(spark, sf_dir), ORACLE_LIMITS, tie="row_id", dense=_dense(spark, sf_dir))
    return r.where("rate_limited").select("row_id", "user_id", "attempts_last_hour")


@query("streak_jumps")
def q_streak_jumps(spark, sf_dir):
    """updates that raise a streak by more than one."""
    j = streaks.streak_jumps(_streak_updates(spark, sf_dir), order_col="updated_on")
    return j.select("user_id", "updated_on", "previous_streak", "current_streak", "step")


@query("midnight_exploit")
def q_midnight(spark, sf_dir):
    """late-night event in one zone, then just past midnight in another."""
    acc = _staged(spark, sf_dir)
    m = anomaly.midnight_exploit(acc, ORACLE_LIMITS, dense=_dense(spark, sf_dir))
    return finish(m.select("user_id", "event_id", "timezone", "previous_timezone", "local_ts", "previous_local_ts"))


@query("points_spike")
def q_points_spike(spark, sf_dir):
    """hours with points above factor x the user's daily mean."""
    s = anomaly.points_spike(_curated(spark, sf_dir).events, SPIKE_LIMITS)
    return finish(s.select("user_id", "hour", "hour_points", "daily_avg"))


@query("impossible_timestamps")
def q_impossible(spark, sf_dir):
    """attempts outside the 7-day / 24-hour window."""
    v = validate.validation(adapter.payloads(adapted(spark, sf_dir)), adapter.AS_OF, Limits())
    return anomaly.impossible_timestamps(v.withColumn("reason", F.col("reject_reason"))).select(
        "row_id", "user_id", "reason")


@query("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    """keys sent at least twice."""
    d = anomaly.duplicate_keys(adapter.payloads(adapted(spark, sf_dir)), ORACLE_LIMITS)
    return finish(d)


@query("duplicate_share")
def q_duplicate_share(spark, sf_dir):
    """per user share of repeated keys."""
    return finish(anomaly.duplicate_share(adapter.payloads(adapted(spark, sf_dir))))


@query("anomaly_log")
def q_anomaly_log(spark, sf_dir):
    """all rule findings in one typed log, over one written table of classified attempts."""
    from streakflow.plans import nightly
    classified = _classified(spark, sf_dir)
    acc = ingest_plan.of_classified(classified).accepted
    checked = validate.validation(adapter.payloads(adapted(spark, sf_dir)), adapter.AS_OF, Limits())
    return finish(nightly.anomaly_findings(
        classified.where(F.col("reject_status").isNull()), checked.withColumn("reason", F.col("reject_reason")),
        acc, _curated(spark, sf_dir).events, _streak_updates(spark, sf_dir, acc),
        adapter.payloads(adapted(spark, sf_dir)), ORACLE_LIMITS, SPIKE_LIMITS))


@query("streak_audit")
def q_streak_audit(spark, sf_dir):
    """audit rows of every streak change."""
    a = streaks.streak_audit(streaks.streak_timeline(_daily(spark, sf_dir)))
    return finish(a.select("audit_id", "user_id", "action", F.col("old_value.current_streak").alias("old_streak"),
                           F.col("new_value.current_streak").alias("new_streak"), "trigger", "timestamp", "ttl"))


# --- D6-D13 reconciliation ---------------------------------------------------------

def _recomputed(spark, sf_dir, acc=None):
    acc = acc if acc is not None else _staged(spark, sf_dir)
    return streaks.streaks(ingest_plan.daily_activity(acc))


@query("streak_drift")
def q_streak_drift(spark, sf_dir):
    """D6 + D13: recomputed vs stored streaks, classified."""
    acc = _staged(spark, sf_dir, ACTIVITY_COLUMNS)
    rec = sinks.staged(_recomputed(spark, sf_dir, acc))  # one row a user, read by both sides
    stored = adapter.stored_state_with_faults(rec, ingest_plan.point_balances(acc))
    return reconcile.classify_drift(reconcile.streak_drift(rec, stored))


@query("reconcile_points")
def q_reconcile_points(spark, sf_dir):
    """Log sum vs stored balance."""
    acc = _staged(spark, sf_dir)
    return reconcile.reconcile_points(acc, _stored(spark, sf_dir, acc))


@query("reconcile_streaks")
def q_reconcile_streaks(spark, sf_dir):
    """Stored streak fields vs recomputation from the faulty daily table."""
    acc = _staged(spark, sf_dir)
    daily = ingest_plan.daily_activity(acc)
    return reconcile.reconcile_streaks(adapter.daily_with_faults(daily), _stored(spark, sf_dir, acc))


@query("missing_activity")
def q_missing_activity(spark, sf_dir):
    """User-days with events but no daily row."""
    acc = _staged(spark, sf_dir)
    m = reconcile.missing_activity(acc, adapter.daily_with_faults(ingest_plan.daily_activity(acc)))
    return finish(m)


@query("orphan_activity")
def q_orphan_activity(spark, sf_dir):
    """Daily rows without events."""
    acc = _staged(spark, sf_dir)
    o = reconcile.orphan_activity(adapter.daily_with_faults(ingest_plan.daily_activity(acc)), acc)
    return finish(o)


@query("snapshot_parity")
def q_snapshot_parity(spark, sf_dir):
    """Stored vs recomputed state, per user."""
    acc = _staged(spark, sf_dir)
    rec = _recomputed(spark, sf_dir, acc).join(ingest_plan.point_balances(acc), "user_id", "full")
    return reconcile.snapshot_parity(_stored(spark, sf_dir, acc), rec,
                                     ["current_streak", "longest_streak", "total_bestie_points"])


@query("correction_audit")
def q_correction_audit(spark, sf_dir):
    """Audit rows of the auto-fixed drift."""
    acc = _staged(spark, sf_dir)
    d = reconcile.classify_drift(reconcile.streak_drift(_recomputed(spark, sf_dir, acc), _stored(spark, sf_dir, acc)))
    a = reconcile.correction_audit(d, adapter.RECONCILE_AT)
    return finish(a.select("audit_id", "user_id", "action", F.col("old_value.current_streak").alias("old_streak"),
                           F.col("new_value.current_streak").alias("new_streak"), "trigger", "timestamp", "ttl"))


# --- E10-E15 quality -------------------------------------------------------------

@query("dq_checks")
def q_dq_checks(spark, sf_dir):
    """Schema, non-empty, key-unique, row-preserving, not-increasing."""
    from streakflow import schemas
    r = raw(spark, sf_dir)
    c = curate_plan.of_flagged(sinks.staged(_curated(spark, sf_dir).flagged), user_dim(spark, sf_dir))
    clean = c.flagged.where(~F.col("is_anomalous"))
    return quality.dq_checks(
        quality.schema_check(c.summaries, "daily_summaries", schemas.DAILY_SUMMARY),
        quality.non_empty(c.summaries, "daily_summaries"),
        quality.key_unique(c.summaries, "daily_summaries", ["user_id", "event_date"]),
        quality.key_unique(c.events, "bp_events", ["idempotency_key"]),
        quality.row_preserving(clean, c.events, "bp_events"),
        quality.not_increasing(r, c.flagged, "bp_events"),
    )


@query("ingest_error_rate")
def q_error_rate(spark, sf_dir):
    """Hourly share of unexpected errors."""
    v = _ingested(spark, sf_dir).verdicts_detail
    return finish(quality.ingest_error_rate(v, "1 hour", limits=ORACLE_LIMITS))


@query("update_lag")
def q_update_lag(spark, sf_dir):
    """received_at - created_at per local day."""
    return finish(quality.update_lag(_accepted(spark, sf_dir), "received_at", by="activity_date"))


@query("lag_percentiles")
def q_lag_percentiles(spark, sf_dir):
    """p50, p95 and p99 of the lag per local day, from mergeable sketches and exactly."""
    acc = _staged(spark, sf_dir)
    lag = (F.unix_micros("received_at") - F.unix_micros("created_at")) / F.lit(1_000_000.0)
    rows = acc.select("activity_date", F.col("received_at").cast("date").alias("day"), lag.alias("lag_seconds"))
    # one sketch for every (date, arrival day), merged by date: no event is read twice
    parts = quality.lag_sketch(rows, "lag_seconds", ["activity_date", "day"])
    merged = quality.merge_sketches(parts, ["activity_date"])
    return finish(quality.sketch_quantiles(merged, ["activity_date"]).join(
        quality.exact_quantiles(rows, "lag_seconds", ["activity_date"]), "activity_date"))


@query("partition_gaps")
def q_partition_gaps(spark, sf_dir):
    """Hours of January 2024 without raw events."""
    return finish(quality.partition_gaps(raw(spark, sf_dir), "2024-01-01 00:00:00", "2024-02-01 00:00:00"))


@query("attempts_by_hour")
def q_attempts_by_hour(spark, sf_dir):
    """Accepted attempts per user-hour."""
    return finish(quality.attempts_by_hour(_accepted(spark, sf_dir)))


# --- remaining scans, joins and filters -------------------------------------------

LIVE_AS_OF = "2024-04-15 00:00:00"


@query("new_partitions")
def q_new_partitions(spark, sf_dir):
    """Raw hour partitions not in the processing ledger (ledger = the
    hours of the first two weeks, derived from the same raw rows)."""
    present = readers.hour_partitions(sinks.with_hour_partitions(raw(spark, sf_dir)))
    ledger = present.where(F.col("day") < 15)
    return readers.new_partitions(present, ledger)


@query("drop_seen")
def q_drop_seen(spark, sf_dir):
    """Raw rows of one day whose key is not yet in the curated log."""
    r = validate.enforce_types(validate.drop_null_keys(raw(spark, sf_dir)))
    batch = r.where(F.col("event_date") == F.lit("2024-01-15").cast("date"))
    return finish(dedup.drop_seen(batch, _curated(spark, sf_dir).events).select(
        "idempotency_key", "event_id", "points_awarded", "created_at"))


@query("first_writer_wins")
def q_first_writer_wins(spark, sf_dir):
    """D3 on the raw rows: duplicates and the id of their original."""
    r = validate.drop_null_keys(raw(spark, sf_dir))
    return dedup.first_writer_wins(r).select("idempotency_key", "event_id", "is_duplicate", "original_event_id")


HISTORY_CUT = "2024-01-16"


def _resent(spark, sf_dir):
    """Later raw rows and copies that are sent again, and the curated log before them."""
    r = validate.drop_null_keys(raw(spark, sf_dir))
    batch = r.where((F.col("created_at") >= HISTORY_CUT) | (F.col("event_id").cast("long") >= adapter.DUP_ID_OFFSET))
    return batch, _curated(spark, sf_dir).events.where(F.col("event_date") < F.lit(HISTORY_CUT).cast("date"))


@query("first_writer_history")
def q_first_writer_history(spark, sf_dir):
    """D3 against a history: keys of earlier days that come again name the stored event."""
    batch, history = _resent(spark, sf_dir)
    return dedup.first_writer_wins(batch, history).select("idempotency_key", "event_id", "is_duplicate", "original_event_id")


@query("drop_seen_history")
def q_drop_seen_history(spark, sf_dir):
    """D2 against the days before the batch: re-sent keys go, new ones stay."""
    batch, history = _resent(spark, sf_dir)
    return finish(dedup.drop_seen(batch, history).select("idempotency_key", "event_id", "created_at"))


@query("live_events")
def q_live_events(spark, sf_dir):
    """Accepted events not yet expired on a later day."""
    return finish(validate.live_events(_accepted(spark, sf_dir), LIVE_AS_OF).select(
        "user_id", "event_id", "ttl", "created_at"))


@query("rate_limit_exact")
def q_rate_limit_exact(spark, sf_dir):
    """The reference's limiter attempt by attempt, by transfer tables."""
    from streakflow.operators import limiter
    v = _valid_attempts(spark, sf_dir).select("row_id", "user_id", "created_at")
    return finish(limiter.rate_limit_exact(v, ORACLE_LIMITS))
