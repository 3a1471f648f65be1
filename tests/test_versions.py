"""Versioned commit with its ledger, and the levelled compaction of the daily table."""
import os

import pytest
from pyspark.sql import functions as F

from streakflow.plans import curate
from streakflow.plans.inputs import raw, user_dim
from streakflow.sources import sinks, versions
from streakflow.streaming import compaction, jobs

SF = "/root/testdata/sf0.001"
COLUMNS = {"bp_events": ["event_id", "event_date", "idempotency_key"], "anomalies": ["event_id", "event_date"],
           "daily_summaries": ["user_id", "event_date", "total_events", "total_points"]}


def _state(spark, root):
    held = versions.manifest(spark, root)
    tables = {t: sorted(map(repr, versions.read(spark, root, held, t).select(*c).collect())) for t, c in COLUMNS.items()}
    return tables, versions.read_ledger(spark, root, held).count()


def _land(rows, path):
    (sinks.with_hour_partitions(rows).repartition(1).write.mode("append")
     .partitionBy("year", "month", "day", "hour").parquet(path))


def test_readers_see_one_version_wherever_a_writer_is_lost(spark, scratch, monkeypatch):
    r, d = raw(spark, SF).where("created_at < '2024-01-06'"), user_dim(spark, SF)
    odd = F.when(F.pmod(F.xxhash64("event_id"), F.lit(9)) == 0, F.lit("500")).otherwise(F.col("points_awarded").cast("string"))
    r = r.withColumn("points_awarded", odd)
    full = os.path.join(scratch, "full")
    curate.run_curate(r, d, full)
    lake, root = os.path.join(scratch, "raw"), os.path.join(scratch, "root")
    _land(r.where("hour(created_at) < 12"), lake)
    assert curate.curate_new_hours(spark, lake, d, root)["version"] == 1
    old = _state(spark, root)
    _land(r.where("hour(created_at) >= 12"), lake)
    real_write, real_publish = sinks.write_partitioned, sinks.publish
    for lost_at in (1, 2, 3, "publish"):
        done = []

        def write(*a, **k):
            real_write(*a, **k)
            done.append(1)
            if len(done) == lost_at:
                raise RuntimeError("lost")

        def publish(*a):
            if lost_at == "publish":
                raise RuntimeError("lost")
            real_publish(*a)

        monkeypatch.setattr(sinks, "write_partitioned", write)
        monkeypatch.setattr(sinks, "publish", publish)
        with pytest.raises(RuntimeError, match="lost"):
            curate.curate_new_hours(spark, lake, d, root)
        monkeypatch.setattr(sinks, "write_partitioned", real_write)
        monkeypatch.setattr(sinks, "publish", real_publish)
        assert _state(spark, root) == old, lost_at
    assert curate.curate_new_hours(spark, lake, d, root)["version"] == 2
    tables, hours = _state(spark, root)
    assert tables == {t: sorted(map(repr, spark.read.parquet(f"{full}/{t}").select(*c).collect())) for t, c in COLUMNS.items()}
    assert hours == sinks.with_hour_partitions(r).select("year", "month", "day", "hour").distinct().count() > old[1]
    assert curate.curate_new_hours(spark, lake, d, root)["version"] == 2  # nothing new, no commit
    before = versions.manifest(spark, root, 1)
    assert versions.read(spark, root, before, "bp_events").count() == len(old[0]["bp_events"])  # readers of version 1 go on
    versions.vacuum(spark, root, keep=1)
    assert versions.numbers(spark, root) == [2] and _state(spark, root) == (tables, hours)


def test_publish_refuses_a_taken_number(spark, scratch):
    sinks.publish(spark, "{}", f"{scratch}/versions/1.json")
    with pytest.raises(FileExistsError):
        sinks.publish(spark, "{}", f"{scratch}/versions/1.json")
    assert [n for n in sinks.folder_names(spark, f"{scratch}/versions") if not n.endswith(".crc")] == ["1.json"]


def test_due_blocks_are_aligned_and_innermost_first():
    assert compaction.live({(0, 3): "", (0, 0): "", (3, 3): "", (4, 4): ""}) == [(0, 3), (4, 4)]
    assert compaction.due([(0, 3), (4, 7), (8, 11), (12, 12), (13, 13), (14, 14), (15, 15)], 15, 4) == [(12, 15)]
    assert compaction.due([(0, 3), (4, 7), (8, 11), (12, 15)], 15, 4) == [(0, 15)]
    assert compaction.due([(0, 3), (9, 9)], 15, 4) == [(8, 11)]  # batches may be missing
    assert compaction.due([(0, 15), (16, 16)], 16, 4) == [] == compaction.due([], 5, 4)
    spans = []
    for n in range(1000):  # folders in force stay few
        spans.append((n, n))
        while blocks := compaction.due(spans, n, 4):
            spans = sorted([s for s in spans if not any(b[0] <= s[0] and s[1] <= b[1] for b in blocks)] + blocks)
        assert len(spans) <= 3 * 5


def test_compaction_survives_a_crash_at_any_step(spark, scratch, monkeypatch):
    rows = spark.createDataFrame([(f"u{i % 3}", f"e{i:02d}", i) for i in range(30)], "user_id string, event_id string, i long")
    rows = rows.withColumns({"created_at": F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(i % 40 as int))"),
                             "points_awarded": F.lit(2), "status": F.lit("processed"), "timezone": F.lit("UTC"),
                             "event_type": F.lit("x"), "activity_date": F.lit("2024-01-01").cast("date")})
    from streakflow.operators import rollups
    want = sorted(map(repr, rollups.daily_activity(rows).select("user_id", "activity_date", "first_event_id", "events_count", "points_earned").collect()))
    read = lambda path: sorted(map(repr, jobs.read_daily(spark, path).select(
        "user_id", "activity_date", "first_event_id", "events_count", "points_earned").collect()))
    real_merge, real_delete = jobs.merge_daily, sinks.delete
    for crash in ("merge", "delete"):
        path = os.path.join(scratch, f"daily_{crash}")
        run = jobs.daily_upsert(path, fan=2)
        for n in range(5):
            batch = rows.where(F.col("i") % 5 == n)
            if crash:
                def lost(*a):
                    raise RuntimeError("lost")

                monkeypatch.setattr(*((jobs, "merge_daily", lost) if crash == "merge" else (sinks, "delete", lost)))
                try:
                    jobs.daily_upsert(path, fan=2)(batch, n)
                except RuntimeError:
                    pass
                monkeypatch.setattr(jobs, "merge_daily", real_merge)
                monkeypatch.setattr(sinks, "delete", real_delete)
            run(batch, n)
            run(batch, n)  # a replay of the last batch
        assert read(path) == want, crash
        assert compaction.live(compaction.committed(spark, path)) == [(0, 3), (4, 4)]
