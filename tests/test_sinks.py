"""Lake writes: rerun safety, incremental dates, warehouse merge, partition pruning."""
import os

from pyspark.sql import functions as F

from streakflow.plans import curate, warehouse as wh
from streakflow.plans.inputs import raw, user_dim
from streakflow.sources import readers, sinks

SF = "/root/testdata/sf0.001"


def _snapshot(spark, path):
    return sorted(map(repr, spark.read.parquet(path).select("idempotency_key", "event_date").collect()))  # keys may be null


def test_run_curate_twice_same_lake(spark, scratch):
    r, d = raw(spark, SF), user_dim(spark, SF)
    m1 = curate.run_curate(r, d, scratch)
    first = _snapshot(spark, f"{scratch}/bp_events")
    m2 = curate.run_curate(r, d, scratch)
    assert m1 == m2 and m1["records_read"] == r.count()
    assert _snapshot(spark, f"{scratch}/bp_events") == first
    summ = spark.read.parquet(f"{scratch}/daily_summaries")
    assert summ.groupBy("user_id", "event_date").count().where("count > 1").count() == 0


def test_increment_by_hours_equals_full(spark, scratch):
    r, d = raw(spark, SF), user_dim(spark, SF)
    full = os.path.join(scratch, "full")
    curate.run_curate(r, d, full)
    inc = os.path.join(scratch, "inc")
    early = r.where(F.hour("created_at") < 12)
    late = r.where(F.hour("created_at") >= 12)
    curate.curate_increment(early, d, inc)
    curate.curate_increment(late, d, inc)
    curate.curate_increment(late, d, inc)  # re-run: no change
    assert _snapshot(spark, f"{inc}/bp_events") == _snapshot(spark, f"{full}/bp_events")
    cols = ["user_id", "event_date", "total_events", "total_points", "event_types"]
    a = spark.read.parquet(f"{inc}/daily_summaries").select(*cols)
    b = spark.read.parquet(f"{full}/daily_summaries").select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _tables(spark, path):
    return {t: sorted(map(repr, spark.read.parquet(f"{path}/{t}").select(*c).collect())) for t, c in (
        ("bp_events", ["event_id", "event_date", "idempotency_key"]), ("anomalies", ["event_id", "event_date", "points_awarded"]),
        ("daily_summaries", ["user_id", "event_date", "total_events", "total_points"]))}


def test_increment_reruns_and_crashes_end_alike(spark, scratch, monkeypatch):
    r, d = raw(spark, SF), user_dim(spark, SF)
    # null keys, and a key that comes again earlier on another date
    r = r.withColumn("idempotency_key", F.when(F.col("event_id") % 150 != 3, F.col("idempotency_key")))
    moved = r.where("event_id = 500").withColumn("created_at", F.expr("created_at - interval 3 days")) \
             .withColumn("event_id", F.lit("000000000000"))
    r = r.where("created_at < '2024-01-20'").unionByName(moved)
    full = os.path.join(scratch, "full")
    curate.curate_increment(r, d, full)
    want = _tables(spark, full)
    assert len(want["anomalies"]) > 0
    early, late = r.where("event_id % 2 = 1"), r.where("event_id % 2 = 0")
    for crash_at in (None, "write_1", "write_2", "write_3"):
        path = os.path.join(scratch, f"crash_{crash_at}")
        curate.curate_increment(early, d, path)
        if crash_at:
            real, done = sinks.write_partitioned, []

            def failing(*a, **k):
                real(*a, **k)
                done.append(1)
                if len(done) == int(crash_at[-1]):
                    raise RuntimeError("lost")

            monkeypatch.setattr(sinks, "write_partitioned", failing)
            try:
                curate.curate_increment(late, d, path)
            except RuntimeError:
                pass
            monkeypatch.setattr(sinks, "write_partitioned", real)
        curate.curate_increment(late, d, path)
        curate.curate_increment(late, d, path)
        assert _tables(spark, path) == want, crash_at


def test_warehouse_key_leaves_its_date(spark, scratch):
    r, d = raw(spark, SF), user_dim(spark, SF)
    lake, fact = os.path.join(scratch, "lake"), os.path.join(scratch, "fact")
    one = r.where("created_at >= '2024-01-10' and created_at < '2024-01-11'").limit(1)
    curate.run_curate(one, d, lake)
    wh.refresh_fact(spark, f"{lake}/bp_events", fact, "2024-01-10", "2024-02-01 00:00:00")
    lake2 = os.path.join(scratch, "lake2")
    curate.run_curate(one.withColumn("created_at", F.expr("created_at + interval 1 day")), d, lake2)
    wh.refresh_fact(spark, f"{lake2}/bp_events", fact, "2024-01-11", "2024-02-02 00:00:00")
    assert [str(x[0]) for x in spark.read.parquet(fact).select("event_date").collect()] == ["2024-01-11"]


def test_warehouse_merge_idempotent_and_pruned(spark, scratch):
    r, d = raw(spark, SF), user_dim(spark, SF)
    lake = os.path.join(scratch, "lake")
    curate.run_curate(r, d, lake)
    fact = os.path.join(scratch, "fact")
    for day in ("2024-01-10", "2024-01-11"):
        wh.refresh_fact(spark, f"{lake}/bp_events", fact, day, "2024-02-01 00:00:00")
    n1 = spark.read.parquet(fact).count()
    wh.refresh_fact(spark, f"{lake}/bp_events", fact, "2024-01-10", "2024-02-02 00:00:00")
    f = spark.read.parquet(fact)
    assert f.count() == n1
    assert f.groupBy("idempotency_key").count().where("count > 1").count() == 0
    staged = readers.stage_partition(spark.read.parquet(f"{lake}/bp_events"), "2024-01-10", "2024-02-01")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-10" in plan


def test_read_raw_hour_pruning_and_new_partitions(spark, scratch):
    r = raw(spark, SF)
    path = os.path.join(scratch, "raw")
    sinks.with_hour_partitions(r).write.partitionBy("year", "month", "day", "hour").parquet(path)
    got = readers.read_raw(spark, path, since="2024-01-05 00:00:00", until="2024-01-06 00:00:00")
    assert got.count() == r.where("created_at >= '2024-01-05' and created_at < '2024-01-06'").count()
    present = readers.hour_partitions(readers.read_raw(spark, path))
    ledger = present.where("day < 5")
    new = readers.new_partitions(present, ledger)
    assert new.where("day < 5").count() == 0 and new.count() == present.count() - ledger.count()


def test_scan_pushdown_and_pruning(spark, scratch):
    import contextlib
    import io

    from streakflow.operators import validate
    from streakflow.plans import queries as Q
    path = os.path.join(scratch, "raw")
    sinks.with_hour_partitions(raw(spark, SF)).write.partitionBy("year", "month", "day", "hour").parquet(path)
    df = validate.drop_null_keys(readers.read_raw(spark, path, since="2024-01-05 00:00:00")) \
        .select("user_id", "event_type", "created_at")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(user_id)]" in plan
    assert "ReadSchema: struct<user_id:string,event_type:string,created_at:timestamp>" in plan
    assert "2024010500" in plan  # hour bound as a partition filter
    lb = Q.QUERIES["leaderboard_by_country"](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        lb.explain("formatted")
    assert buf.getvalue().count("WindowGroupLimit") >= 2  # partial limit before the shuffle
