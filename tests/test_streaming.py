"""Stream = batch: the streaming forms on file sources, trigger availableNow."""
import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from streakflow.config import Limits
from streakflow.operators import streaks
from streakflow.plans import ingest
from streakflow.sources import readers
from streakflow.streaming import jobs


def _collect(stream_df, scratch, name, mode="update"):
    out = os.path.join(scratch, name)

    def sink(batch, batch_id):
        batch.write.mode("append").parquet(out)

    q = (stream_df.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", os.path.join(scratch, name + "_ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    return stream_df.sparkSession.read.parquet(out)


def test_ingest_stream_equals_expectations(spark, six_users, scratch):
    src = os.path.join(scratch, "payloads")
    cols = [f.name for f in jobs.PAYLOAD_STREAM_SCHEMA.fields]
    # two files delivered in send order: the fold state carries across micro-batches
    six_users.where("row_id < 80").select(*cols).coalesce(1).write.mode("append").parquet(src)
    six_users.where("row_id >= 80").select(*cols).coalesce(1).write.mode("append").parquet(src)
    stream = jobs.read_payloads(spark, src, max_files_per_trigger=1)
    got = _collect(jobs.ingest_stream(stream, Limits()), scratch, "verdicts", mode="append")
    counts = {r["status"]: r["n"] for r in got.groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert counts == {"processed": 126, "duplicate": 12, "rate_limited": 5, "validation_error": 5}
    batch = ingest.ingest_batch(six_users, AS_OF, Limits()).verdicts
    diff = got.select("row_id", "status", "event_id").exceptAll(batch.select("row_id", "status", "event_id"))
    assert diff.count() == 0
    acc = got.where("status = 'processed'")
    assert acc.where(F.col("points_awarded").isNull() | F.col("activity_date").isNull()).count() == 0


def _attempts():
    """Valid attempts over eleven days, one dated 2099, one two years old, one without
    a user, one key that the stored log has, more attempts an hour than allowed."""
    at = dt.datetime(2025, 3, 1, 12, 0)
    rows = []

    def send(user, when, client=None, key=None, zone="UTC"):
        client = client or when
        rows.append((user, "TOOL_USE", client.isoformat() + "+00:00", zone, key or f"k{len(rows)}", "web", None, len(rows), when))

    send("u1", at)
    send("u1", at + dt.timedelta(minutes=1), client=dt.datetime(2099, 1, 1))
    send("u1", at + dt.timedelta(minutes=2), client=dt.datetime(2023, 1, 1))
    send(None, at + dt.timedelta(minutes=3))
    for i in range(6):
        send("u2", at + dt.timedelta(minutes=4 + i), client=at + dt.timedelta(minutes=60 - i))
    for i in range(12):
        send(f"u{i % 3}", at + dt.timedelta(hours=3 + i))
    send("u1", at + dt.timedelta(days=9), key="again")
    send("u2", at + dt.timedelta(days=10))
    return rows


@pytest.mark.parametrize("files", [1, 3, 10])
def test_ingest_stream_does_not_depend_on_batches(spark, scratch, files):
    rows = _attempts()
    src = os.path.join(scratch, f"cut{files}")
    size = -(-len(rows) // files)
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i:i + size], jobs.PAYLOAD_STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.02)  # the file source reads in order of modification
    log = spark.createDataFrame([("again", "20250301T120000#stored")], "idempotency_key string, event_id string")
    stream = jobs.read_payloads(spark, src, max_files_per_trigger=1)
    got = _collect(jobs.ingest_stream(stream, Limits(rate_limit=4), stored_log=log), scratch, f"cut_v{files}", mode="append")
    verdicts = {r["row_id"]: r["status"] for r in got.collect()}
    assert len(verdicts) == got.count() == len(rows)
    assert [verdicts[i] for i in (1, 2, 3)] == ["validation_error"] * 3
    assert [verdicts[i] for i in range(4, 10)] == ["processed"] * 4 + ["rate_limited"] * 2
    # the key of nine days ago: forgotten by the state's window, found in the stored log
    assert verdicts[len(rows) - 2] == "duplicate"
    assert verdicts[len(rows) - 1] == "processed"


def test_streak_stream_equals_batch(spark, six_users, scratch):
    acc = ingest.ingest_batch(six_users, AS_OF, Limits()).accepted
    daily = ingest.daily_activity(acc).select("user_id", "activity_date", "first_event_id", "created_at")
    src = os.path.join(scratch, "daily")
    # deliver days in two files, in date order per file
    daily.where("activity_date < '2025-03-28'").coalesce(1).write.parquet(src + "/a")
    daily.where("activity_date >= '2025-03-28'").coalesce(1).write.parquet(src + "/b")
    schema = daily.schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    deduped = jobs.stream_dedup(stream, ("user_id", "first_event_id"), "created_at", "1 hour")
    got = _collect(jobs.streak_stream(deduped), scratch, "streaks")
    latest = got.groupBy("user_id").agg(F.max_by(F.struct("current_streak", "longest_streak", "version"),
                                                 "version").alias("s")).select("user_id", "s.*")
    expected = streaks.streaks(ingest.daily_activity(acc)).select("user_id", "current_streak", "longest_streak",
                                                                  "version")
    assert latest.exceptAll(expected).count() == 0 and expected.exceptAll(latest).count() == 0


def test_streak_step_policies():
    from streakflow.operators.sequential import streak_step
    s = None
    for d in (10, 11, 12):
        s = streak_step(s, d)
    assert s == (3, 3, 12, 3)
    assert streak_step(s, 12) == s                       # same day: no-op
    assert streak_step(s, 9) == s                        # late day ignored
    assert streak_step(s, 9, late="reference") == (1, 3, 9, 4)   # reference: reset, last moves back
    assert streak_step(s, 14) == (1, 3, 14, 4)           # gap resets


def test_cdc_inserts_flatten(spark):
    rows = [("INSERT", ("u1", "2025-03-29", "e1")), ("MODIFY", ("u1", "2025-03-29", "e1")),
            ("INSERT", ("u2", "2025-03-28", None))]
    data = [{"eventName": n, "dynamodb": {"NewImage": {"user_id": {"S": u}, "activity_date": {"S": d},
                                                       "first_event_id": None if e is None else {"S": e}}}}
            for n, (u, d, e) in rows]
    from streakflow import schemas
    df = spark.createDataFrame(data, schemas.CDC_RECORD)
    got = sorted(tuple(r) for r in readers.cdc_inserts(df).collect())
    assert [(u, str(d), e) for u, d, e in got] == [("u1", "2025-03-29", "e1"), ("u2", "2025-03-28", "unknown")]


def test_daily_upsert_idempotent(spark, six_users, scratch):
    v = ingest.classify(six_users, AS_OF, Limits())
    part1 = v.where("row_id % 2 = 0")
    part2 = v.where("row_id % 2 = 1")
    run = jobs.daily_upsert(os.path.join(scratch, "daily"))
    run(part1, 0)
    run(part2, 1)
    run(part2, 1)  # replayed batch: no-op
    got = jobs.read_daily(spark, os.path.join(scratch, "daily"))
    expected = ingest.daily_activity(v.where("status = 'processed'"))
    cols = ["user_id", "activity_date", "first_event_id", "events_count", "points_earned"]
    assert got.select(*cols).exceptAll(expected.select(*cols)).count() == 0
    assert expected.select(*cols).exceptAll(got.select(*cols)).count() == 0


def test_land_raw_then_read_raw(spark, scratch):
    from streakflow.plans.inputs import raw
    from streakflow.sources import sinks
    r = raw(spark, "/root/testdata/sf0.001")
    src = os.path.join(scratch, "incoming")
    r.coalesce(2).write.parquet(src)
    stream = spark.readStream.schema(r.schema).parquet(src)
    lake = os.path.join(scratch, "lake")
    q = sinks.land_raw(stream, lake, os.path.join(scratch, "land_ckpt"), available_now=True)
    q.awaitTermination(600)
    back = readers.read_raw(spark, lake).select(*r.columns)
    assert back.exceptAll(r).count() == 0 and r.exceptAll(back).count() == 0
    one_hour = readers.read_raw(spark, lake, since="2024-01-03 05:00:00", until="2024-01-03 06:00:00")
    assert one_hour.count() == r.where("created_at >= '2024-01-03 05:00:00' and created_at < '2024-01-03 06:00:00'").count()


def test_windowed_monitors(spark, six_users, scratch):
    v = ingest.ingest_batch(six_users, AS_OF, Limits()).verdicts_detail
    src = os.path.join(scratch, "verdicts")
    v.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(v.schema).parquet(src)
    got = _collect(jobs.error_rate_stream(stream, "1 hour", "0 seconds"), scratch, "err", mode="append")
    batch = v.groupBy(F.window("received_at", "1 hour").alias("w")).agg(F.count("*").alias("attempts"))
    last_end = v.agg(F.max("received_at")).collect()[0][0]
    finished = batch.where(F.col("w.end") <= F.lit(last_end)).select(F.col("w.start").alias("window_start"), "attempts")
    assert got.select("window_start", "attempts").exceptAll(finished).count() == 0
    assert finished.exceptAll(got.select("window_start", "attempts")).count() == 0

    attempts = v.where("status <> 'validation_error'").select("user_id", "created_at")
    src2 = os.path.join(scratch, "attempts")
    attempts.coalesce(1).write.parquet(src2)
    s2 = spark.readStream.schema(attempts.schema).parquet(src2)
    flagged = _collect(jobs.rate_monitor_stream(s2, Limits(), "5 minutes", "0 seconds"), scratch, "rate", mode="append")
    assert {r["user_id"] for r in flagged.collect()} <= {"usr_frank"}


def test_stream_limiter_equals_batch_exact(spark, scratch):
    """J4 (inside the J1 fold) = F8b on the sf0.001 driver data, limit 2."""
    from streakflow.operators import sequential, validate
    from streakflow.plans.inputs import adapted
    from streakflow.sources import adapter
    limits = Limits(rate_limit=2, max_age_days=40)
    p = adapter.payloads(adapted(spark, "/root/testdata/sf0.001"))
    src = os.path.join(scratch, "p")
    p.select(*[f.name for f in jobs.PAYLOAD_STREAM_SCHEMA.fields]).coalesce(1).write.parquet(src)
    got = _collect(jobs.ingest_stream(jobs.read_payloads(spark, src), limits), scratch, "v", mode="append")
    stream_denied = {r["row_id"] for r in got.where("status = 'rate_limited'").collect()}
    valid = validate.validation(p, adapter.AS_OF, limits).where("reject_status is null")
    # the stream's limiter goes by the arrival clock
    valid = valid.withColumn("created_at", F.col("received_at"))
    exact = sequential.rate_limit_exact(valid.select("row_id", "user_id", "created_at"), limits)
    batch_denied = {r["row_id"] for r in exact.where("not allowed").collect()}
    assert stream_denied == batch_denied and len(batch_denied) > 0
