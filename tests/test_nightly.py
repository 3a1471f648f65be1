"""P4 finds exactly the injected faults (FIXTURES.md §2), P5 tables exist."""
from pyspark.sql import functions as F

from streakflow.plans import charts, nightly
from streakflow.plans import queries as Q
from streakflow.sources import adapter

SF = "/root/testdata/sf0.001"


def _num(u):
    return int(u[4:])


def test_nightly_finds_injected_faults_only(spark):
    acc = Q._accepted(spark, SF)
    daily = Q.ingest_plan.daily_activity(acc)
    stored = Q._stored(spark, SF, acc)
    rec = nightly.nightly_reconcile(acc, adapter.daily_with_faults(daily), stored, adapter.RECONCILE_AT)
    users = {r["user_id"] for r in daily.select("user_id").distinct().collect()}

    drift = {r["user_id"]: (r["drift"], r["action"]) for r in rec.drift.collect()}
    want = {u for u in users if _num(u) % 23 == 0 or _num(u) % 11 == 0}
    assert set(drift) == want
    for u, (d, action) in drift.items():
        assert (d, action) == ((3, "alert") if _num(u) % 23 == 0 else (1, "auto_fix"))
    assert {r["user_id"] for r in rec.corrections.collect()} == {u for u in want if _num(u) % 23 != 0}
    assert rec.audit.count() == rec.corrections.count()

    bad_points = {r["user_id"] for r in rec.points.where("status = 'MISMATCH'").collect()}
    assert bad_points == {u for u in users if _num(u) % 13 == 0}

    days = {(r["user_id"], str(r["activity_date"])) for r in daily.select("user_id", "activity_date").collect()}
    missing = {(r["user_id"], str(r["activity_date"])) for r in rec.missing_days.collect()}
    assert missing == {(u, d) for u, d in days if _num(u) % 17 == 0 and d == adapter.MISSING_DAY}
    orphans = {(r["user_id"], str(r["activity_date"])) for r in rec.orphan_days.collect()}
    assert orphans == {(u, adapter.ORPHAN_DAY) for u in users if _num(u) % 19 == 0}


def test_chart_tables(spark):
    acc = Q._accepted(spark, SF)
    daily = Q.ingest_plan.daily_activity(acc)
    c = Q._curated(spark, SF)
    t = charts.chart_tables(daily, c.events, Q._snapshot(spark, SF), Q.raw(spark, SF), Q.user_dim(spark, SF))
    assert set(t) == {"streak_timeline", "points_timeline", "streak_distribution", "quality_funnel"}
    funnel = [r["row_count"] for r in t["quality_funnel"].orderBy("stage_no").collect()]
    assert funnel == sorted(funnel, reverse=True) and funnel[-1] > 0
    pts = t["points_timeline"].groupBy("user_id").agg(F.max("cumulative_points").alias("m"),
                                                       F.sum("day_points").alias("s"))
    assert pts.where("m <> s").count() == 0


def test_backfill_restores_missing_days(spark):
    from streakflow.operators import reconcile
    acc = Q._accepted(spark, SF)
    daily = Q.ingest_plan.daily_activity(acc)
    broken = daily.where(~((F.substring("user_id", 5, 9).cast("int") % 17 == 0)
                           & (F.col("activity_date") == F.lit(adapter.MISSING_DAY).cast("date"))))
    fixed = reconcile.backfill_activity(acc, broken)
    cols = ["user_id", "activity_date", "first_event_id", "events_count", "points_earned"]
    assert fixed.select(*cols).exceptAll(daily.select(*cols)).count() == 0
    assert daily.select(*cols).exceptAll(fixed.select(*cols)).count() == 0
    assert daily.count() > broken.count()
