"""Edge rows and invariants of single operators."""
import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from conftest import AS_OF, PAYLOAD_DDL, local_ts
from streakflow.config import Limits
from streakflow.operators import anomaly, dedup, streaks, validate, warehouse
from streakflow.operators.windows import dense_keys, light_keys, previous_value, running_sum, trailing_sum
from streakflow.plans import ingest
from streakflow.sources import adapter, sinks


def test_point_range_and_casts(spark):
    rows = [("a", "k1", "-1"), ("a", "k2", "0"), ("a", "k3", "100"), ("a", "k4", "101"), ("a", "k5", None),
            ("a", "k6", "12x")]
    df = spark.createDataFrame(rows, "user_id string, idempotency_key string, points_awarded string")
    df = df.withColumn("created_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    flagged = validate.flag_point_range(validate.enforce_types(df))
    got = {r["idempotency_key"]: (r["points_awarded"], r["is_anomalous"]) for r in flagged.collect()}
    assert got == {"k1": (-1, True), "k2": (0, False), "k3": (100, False), "k4": (101, True),
                   "k5": (None, False), "k6": (None, False)}


def test_validation_reasons(spark):
    base = dict(user_id="u", event_type="TOOL_USE", client_timestamp="2025-03-29T10:00:00+00:00",
                timezone="Europe/London", idempotency_key="k", source=None, received_at=None)
    cases = {
        0: dict(idempotency_key=None),
        1: dict(event_type="NOPE"),
        2: dict(timezone="Bad/Zone"),
        3: dict(client_timestamp="yesterday"),
        4: dict(client_timestamp="2025-03-29T10:00:00"),
        5: dict(client_timestamp="2025-03-31T10:00:00+00:00"),
        6: dict(client_timestamp="2025-03-01T10:00:00+00:00"),
        7: dict(),
        8: dict(user_id=None, event_type=None),
    }
    rows = [{"row_id": k, **base, **v} for k, v in cases.items()]
    df = spark.createDataFrame(pd.DataFrame(rows), PAYLOAD_DDL)
    got = {r["row_id"]: (r["reject_status"], r["reject_reason"])
           for r in validate.validation(df, AS_OF, Limits()).collect()}
    assert got[0] == ("validation_error", "Missing required field: idempotency_key")
    assert got[1] == ("validation_error", "Invalid event_type: NOPE")
    assert got[2] == ("validation_error", "Invalid timezone: Bad/Zone")
    assert got[3][1].startswith("Invalid client_timestamp format")
    assert got[4] == ("error", "timestamp_without_offset")
    assert got[5][1] == "client_timestamp is too far in the future"
    assert got[6][1] == "client_timestamp is too far in the past"
    assert got[7] == (None, None)
    assert got[8][1] == "Missing required field: user_id"


def test_local_dates_across_zones(spark):
    rows = [(0, "2025-03-29T23:58:00+09:00", "Asia/Tokyo"), (1, "2025-03-30T00:30:00+13:00", "Pacific/Auckland"),
            (2, "2025-03-30T00:30:00+00:00", "Europe/London"), (3, "2025-03-30T23:30:00+01:00", "Europe/London")]
    df = spark.createDataFrame(rows, "row_id long, client_timestamp string, timezone string")
    for c in ("user_id", "event_type", "idempotency_key"):
        df = df.withColumn(c, F.lit("TOOL_USE" if c == "event_type" else "x"))
    got = {r["row_id"]: str(r["activity_date"]) for r in validate.validation(df, AS_OF).collect()}
    assert got == {0: "2025-03-29", 1: "2025-03-30", 2: "2025-03-30", 3: "2025-03-30"}


def test_dedup_tie_break_and_methods(spark):
    rows = [("k", "2024-01-01 00:00:00", "e2"), ("k", "2024-01-01 00:00:00", "e1"), ("k", "2024-01-02 00:00:00", "e0"),
            ("j", "2024-01-01 00:00:00", "e9")]
    df = spark.createDataFrame(rows, "idempotency_key string, created_at string, event_id string") \
        .withColumn("created_at", F.col("created_at").cast("timestamp"))
    a = {r["idempotency_key"]: r["event_id"] for r in dedup.dedup_first(df).collect()}
    w = {r["idempotency_key"]: r["event_id"] for r in dedup.dedup_first(df, method="window").collect()}
    assert a == w == {"k": "e1", "j": "e9"}


def test_merge_is_idempotent(spark):
    fact = spark.createDataFrame([("k1", 1), ("k2", 2), ("k3", 3)], "idempotency_key string, v int") \
        .withColumn("created_at", F.lit(None).cast("timestamp")).withColumn("event_id", F.col("idempotency_key"))
    stg = spark.createDataFrame([("k2", 20), ("k4", 40), ("k4", 41)], "idempotency_key string, v int") \
        .withColumn("created_at", F.lit(None).cast("timestamp")).withColumn("event_id", F.concat("idempotency_key", F.col("v").cast("string")))
    once = warehouse.merge_by_key(fact, stg)
    twice = warehouse.merge_by_key(once, stg)
    key = lambda df: sorted(tuple(r) for r in df.select("idempotency_key", "v").collect())
    assert key(once) == key(twice) == [("k1", 1), ("k2", 20), ("k3", 3), ("k4", 40)]


def test_streaks_order_independent(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05", "2024-01-06", "2024-01-10"]
    random.seed(1)
    shuffled = days[:]
    random.shuffle(shuffled)
    for order in (days, shuffled):
        df = spark.createDataFrame([("u", d) for d in order], "user_id string, activity_date string") \
            .withColumn("activity_date", F.to_date("activity_date"))
        r = streaks.streaks(df, "2024-01-12").collect()[0]
        assert (r["current_streak"], r["longest_streak"], str(r["last_activity_date"]), r["version"],
                r["effective_streak"]) == (1, 3, "2024-01-10", 6, 0)
    tl = streaks.streak_timeline(df).orderBy("activity_date").collect()
    assert [r["streak"] for r in tl] == [1, 2, 3, 1, 2, 1]


def _random_events(spark, n=400, seed=7):
    random.seed(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{random.randint(0, 5)}"
        t = base + dt.timedelta(seconds=random.randint(0, 3 * 86400))
        if i % 17 == 0 and rows:
            t = rows[-1][2]  # equal timestamps
        rows.append((i, user, t, random.choice(["A", "B", "C"]), random.randint(0, 3)))
    return spark.createDataFrame(rows, "rid long, user_id string, created_at timestamp, zone string, v long")


def test_bucketed_helpers_equal_plain_windows(spark):
    df = _random_events(spark)
    w = Window.partitionBy("user_id").orderBy("created_at", "rid")
    plain = df.withColumn("prev", F.lag("zone").over(w)) \
        .withColumn("run", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # trailing hour count by brute force: self join
    a, b = df.alias("a"), df.alias("b")
    brute = (a.join(b, (F.col("a.user_id") == F.col("b.user_id"))
                    & (F.col("b.created_at") > F.col("a.created_at") - F.expr("INTERVAL 1 HOUR"))
                    & (F.struct("b.created_at", "b.rid") <= F.struct("a.created_at", "a.rid")))
             .groupBy("a.rid").agg(F.sum("b.v").alias("trail")))
    got_prev = previous_value(df, ["user_id"], "created_at", "rid", "zone", out="prev", bucket_us=3_600_000_000)
    got_run = running_sum(df, ["user_id"], "created_at", "rid", F.col("v"), out="run", bucket_us=3_600_000_000)
    for bucket in (None, 1_200_000_000, 86_400_000_000):
        got_trail = trailing_sum(df, ["user_id"], "created_at", "rid", 3_600_000_000, value=F.col("v"),
                                 out="trail", bucket_us=bucket)
        t = {r["rid"]: r["trail"] for r in got_trail.collect()}
        assert t == {r["rid"]: r["trail"] for r in brute.collect()}
    p = {r["rid"]: (r["prev"], r["run"]) for r in plain.collect()}
    gp = {r["rid"]: r["prev"] for r in got_prev.collect()}
    gr = {r["rid"]: r["run"] for r in got_run.collect()}
    assert gp == {k: v[0] for k, v in p.items()}
    assert gr == {k: v[1] for k, v in p.items()}


def test_dense_keys_in_cells_equal_plain_windows(spark):
    df = _random_events(spark).unionByName(_random_events(spark, 60, 9).withColumns(
        {"rid": F.col("rid") + 1000, "user_id": F.lit(None).cast("string")}))
    dense = spark.createDataFrame([("hot",), ("u1",), (None,)], "user_id string")
    for width in (3_600_000_000, 86_400_000_000):
        for own in (True, False):
            args = (["user_id"], "created_at", "rid", width)
            want = {r["rid"]: r["n"] for r in trailing_sum(df, *args, value=F.col("v"), out="n", include_current=own).collect()}
            for cell in (60_000_000, 600_000_000, width):
                got = trailing_sum(df, *args, value=F.col("v"), out="n", include_current=own, dense=dense, cell_us=cell)
                assert got.columns == [*df.columns, "n"]
                assert {r["rid"]: r["n"] for r in got.collect()} == want
    for cell in (60_000_000, 7_000_000_000):
        for helper, column in ((previous_value, "zone"), (running_sum, F.col("v"))):
            args = (["user_id"], "created_at", "rid", column)
            df = df.where("user_id is not null")  # rows without a user are no sequence
            assert sorted(map(str, helper(df, *args, out="x", dense=dense, cell_us=cell).collect())) == \
                sorted(map(str, helper(df, *args, out="x").collect()))
    found = dense_keys(df, ["user_id"], "created_at", floor=30)
    assert found.columns == ["user_id"]
    assert {r["user_id"] for r in found.collect()} == {"hot"}
    assert dense_keys(df, ["user_id"], "created_at", floor=10, share=2).count() == 0  # none has half of all rows


def test_user_with_a_third_of_one_day_is_spread(spark):
    n = 30000
    df = spark.range(n).select(
        F.col("id").alias("rid"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("user_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=(F.col("id") * 37 % 86400).cast("int"))).alias("created_at"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    dense = dense_keys(df, ["user_id"], "created_at", floor=1000)
    out = trailing_sum(df, ["user_id"], "created_at", "rid", 3_600_000_000, out="n", dense=dense, bucket_us=86_400_000_000)
    per_task = [r["count"] for r in out.where("n > 0").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(per_task) == n and max(per_task) < 0.05 * n


def _hopper(spark):
    rows = []
    zones = ["Asia/Tokyo", "Europe/London", "America/New_York", "UTC"]
    base = dt.datetime(2025, 3, 28, 1, 0, tzinfo=dt.timezone.utc)
    for i, z in enumerate(zones):
        ts = base + dt.timedelta(hours=3 * i)
        rows.append({"row_id": i, "user_id": "usr_hop", "event_type": "TOOL_USE",
                     "client_timestamp": ts.isoformat(), "timezone": z, "idempotency_key": f"h{i}",
                     "source": "web", "received_at": ts.replace(tzinfo=None)})
    # midnight hopper: 23:59 Tokyo, then 00:01 London the next date
    t1, t2 = local_ts("Asia/Tokyo", 2025, 3, 27, 23, 59), local_ts("Europe/London", 2025, 3, 28, 0, 1)
    for k, (ts, z) in enumerate(((t1, "Asia/Tokyo"), (t2, "Europe/London"))):
        rows.append({"row_id": 10 + k, "user_id": "usr_mid", "event_type": "DAILY_OPEN",
                     "client_timestamp": ts.isoformat(), "timezone": z, "idempotency_key": f"m{k}",
                     "source": None, "received_at": ts.replace(tzinfo=None)})
    return spark.createDataFrame(pd.DataFrame(rows), PAYLOAD_DDL).withColumn(
        "metadata", F.lit(None).cast("map<string,string>"))


def test_zone_hopper_and_midnight(spark):
    df = _hopper(spark)
    ing = ingest.ingest_batch(df, AS_OF, Limits())
    st = {r["row_id"]: r["status"] for r in ing.verdicts.collect()}
    assert [st[i] for i in range(4)] == ["processed", "processed", "processed", "tz_abuse"]
    assert st[10] == st[11] == "processed"
    mid = anomaly.midnight_exploit(ing.accepted.withColumnRenamed("row_id", "rid"), Limits(), tie="event_id").collect()
    assert [r["user_id"] for r in mid] == ["usr_mid"]
    ch = anomaly.timezone_changes(ing.accepted).where("user_id = 'usr_hop'").count()
    assert ch == 2
    src = {r["row_id"]: r["source"] for r in ing.accepted.select("row_id", "source").collect()}
    assert src[10] == "unknown"


def test_leaderboard_top_n_per_partition(spark):
    rows = [(f"u{i}", "X" if i % 2 else None, i % 5, i) for i in range(20)]
    df = spark.createDataFrame(rows, "user_id string, country string, current_streak long, total_bestie_points long")
    lb = streaks.leaderboard(df, n=3, by="country").collect()
    parts = {}
    for r in lb:
        parts.setdefault(r["leaderboard_partition"], []).append((r["rank"], r["current_streak"], r["total_bestie_points"]))
    assert set(parts) == {"X", "GLOBAL"}
    assert all(len(v) == 3 for v in parts.values())
    assert sorted(parts["X"])[0][1:] == (4, 19)


def test_normalise_numbers_and_keys(spark):
    from decimal import Decimal

    from streakflow.sources import readers
    df = spark.createDataFrame([(Decimal("3"), Decimal("2.5"), [Decimal("1")], ("x", Decimal("4")))],
                               "a decimal(10,0), b decimal(10,2), c array<decimal(5,0)>, s struct<n:string,v:decimal(8,0)>")
    out = readers.normalise_numbers(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "bigint", "double", "array<bigint>", "struct<n:string,v:bigint>"]
    assert tuple(out.collect()[0]) == (3, 2.5, [1], ("x", 4))
    k = spark.createDataFrame([("u", "TOOL_USE", "2025-03-29T10:00:00+00:00", None)],
                              "user_id string, event_type string, client_timestamp string, idempotency_key string")
    assert validate.make_idempotency_key(k).collect()[0]["idempotency_key"] == "u:TOOL_USE:2025-03-29T10:00:00+00:00"


def test_exact_limiter_refreshes_ttl_only_on_accepted(spark):
    from streakflow.operators import sequential
    base = dt.datetime(2024, 1, 1)
    # limit 2: t=0 ok, 10 ok, 20 denied, 3600 ok? last counted at 10 -> 3600-10 < 3600: still full -> denied,
    # 3610 resets (>= ttl after the last counted attempt) -> ok
    secs = [0, 10, 20, 3600, 3610, 3620, 3630]
    rows = [(i, "u", base + dt.timedelta(seconds=s)) for i, s in enumerate(secs)]
    df = spark.createDataFrame(rows, "row_id long, user_id string, created_at timestamp")
    got = {r["row_id"]: r["allowed"] for r in sequential.rate_limit_exact(df, Limits(rate_limit=2)).collect()}
    assert [got[i] for i in range(len(secs))] == [True, True, False, False, True, True, False]


def test_exact_limiter_matches_brute_force_on_driver_data(spark):
    """F8b over every valid attempt of sf0.001 against a plain Python fold."""
    from streakflow.operators import sequential
    from streakflow.plans import queries as Q
    sf = "/root/testdata/sf0.001"
    limits = Limits(rate_limit=2)
    v = Q._valid_attempts(spark, sf).select("row_id", "user_id", "created_at")
    got = {r["row_id"]: r["allowed"] for r in sequential.rate_limit_exact(v, limits).collect()}
    pdf = v.toPandas().sort_values(["user_id", "created_at", "row_id"])
    want = {}
    for _, g in pdf.groupby("user_id"):
        st = sequential.UserState()
        for rid, t in zip(g["row_id"], g["created_at"]):
            want[rid] = sequential.rate_step(st, int(pd.Timestamp(t).value // 1000), limits)
    assert got == want and sum(not x for x in want.values()) > 0


def test_hot_user_spread_over_tasks(spark):
    """One user holds a third of the rows: after the bucketed trailing window
    no single partition holds that user's whole history."""
    n = 30000
    df = spark.range(n).select(
        F.col("id").alias("rid"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string")))
        .alias("user_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=(F.col("id") * 37 % (30 * 86400)).cast("int")))
        .alias("created_at"))
    # AQE would merge this small shuffle into one partition; measure the hash layout itself
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = trailing_sum(df, ["user_id"], "created_at", "rid", 3_600_000_000, out="n") \
        .withColumn("p", F.spark_partition_id())  # taken after the window's shuffle
    per_part = out.where("user_id = 'hot'").groupBy("p").agg(F.count("*").alias("count"), F.max("n").alias("m")) \
        .collect()
    hot = sum(r["count"] for r in per_part)
    assert hot == n // 3 and all(r["m"] >= 1 for r in per_part)
    assert len(per_part) > 1 and max(r["count"] for r in per_part) < 0.5 * hot
    # a plain per-user window puts all of them in one partition
    w = Window.partitionBy("user_id").orderBy("created_at")
    plain = df.withColumn("x", F.count("*").over(w)).withColumn("p", F.spark_partition_id()) \
        .where("user_id = 'hot'").groupBy("p").agg(F.count("*").alias("count"), F.max("x").alias("m")).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(plain) == 1


def test_ingest_reads_its_input_once(spark, tmp_path):
    """The tables of an ingest read what was written on the way, never the payloads again."""
    path = str(tmp_path / "payloads")
    adapter.payloads(adapter.adapt_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))).write.parquet(path)
    ing = ingest.ingest_batch(spark.read.parquet(path), adapter.AS_OF, Limits(max_age_days=40, rate_limit=2))
    for out in (ing.accepted, ing.verdicts, ing.verdicts_detail):
        assert out.inputFiles() and not [f for f in out.inputFiles() if path in f]


def test_abusive_changes_are_the_flagged_rows(spark):
    """Only zone changes enter the window, with the same verdicts as a window over all rows."""
    zones = F.when(F.col("id") % 5 == 0, F.lit("UTC")).when(F.col("id") % 3 == 0, F.lit("Asia/Tokyo")).otherwise(F.lit("Europe/London"))
    df = spark.range(2000).select(
        F.col("id").cast("string").alias("event_id"), F.concat(F.lit("u"), F.col("id") % 40).alias("user_id"), zones.alias("timezone"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=((F.col("id") * 1607) % 1_500_000).cast("int"))).alias("created_at"))
    all_rows = {r.event_id for r in anomaly.timezone_abuse(df, Limits()).where("tz_abuse").collect()}
    assert {r.event_id for r in anomaly.abusive_changes(df, Limits()).collect()} == all_rows and 0 < len(all_rows) < 2000


def test_whole_keys_equal_buckets_and_no_frame_slides(spark):
    """Light keys in one bucket give what the bucketed windows give; the trailing sum is a
    difference of two growing sums, so a row costs the same however full its window is."""
    df = _random_events(spark)
    assert light_keys(df, ["user_id"]) and not light_keys(df, ["user_id"], most=100, groups=1 << 10)
    assert light_keys(df.limit(0), ["user_id"])
    for own in (True, False):
        args = (["user_id"], "created_at", "rid", 3_600_000_000)
        got = trailing_sum(df, *args, value=F.col("v"), out="n", include_current=own, whole=True)
        want = trailing_sum(df, *args, value=F.col("v"), out="n", include_current=own)
        assert got.columns == [*df.columns, "n"] and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        for plan in (got, want):
            assert "RangeFrame, -3599999999" not in plan._jdf.queryExecution().toString()
    args = (["user_id"], "created_at", "rid", "zone")
    for where in (None, F.col("v") > 1):
        got, want = (previous_value(df, *args, out="x", where=where, whole=w).select("rid", "x") for w in (True, False))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("light", ["both", "users", "keys", "none"])
def test_accepted_log_without_writes_between(spark, monkeypatch, light):
    """The accepted log alone equals the processed rows of all verdicts. Where every user and key
    is light nothing is written on the way; heavy ones take the bucketed form, with the same rows."""
    payloads = adapter.payloads(adapter.adapt_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet")))
    limits = Limits(max_age_days=40, rate_limit=2)
    plain = sorted(map(str, ingest.accept(payloads, adapter.AS_OF, limits).collect()))
    asked = {"user_id": light in ("both", "users"), "idempotency_key": light in ("both", "keys")}
    writes = []
    monkeypatch.setattr(ingest, "light_keys", lambda df, keys: asked[keys[0]])
    monkeypatch.setattr(ingest, "staged", lambda df: writes.append(1) or sinks.staged(df))
    log = ingest.accept(payloads, adapter.AS_OF, limits)
    assert (len(writes) == 0) == (light == "both")
    classified = sinks.staged(ingest.classify(payloads.drop("metadata"), adapter.AS_OF, limits))
    want = ingest.of_classified(classified).accepted
    assert log.columns == want.columns and log.dtypes == want.dtypes
    assert sorted(map(str, log.collect())) == sorted(map(str, want.collect())) == plain
    assert {r.status for r in classified.select("status").distinct().collect()} == {"processed", "duplicate", "rate_limited", "tz_abuse", "validation_error", "error"}
    few = ingest.accept(payloads, adapter.AS_OF, limits, columns=("user_id", "ttl", "event_id"), written=True)
    assert few.columns == ["row_id", "user_id", "ttl", "event_id"] and few.exceptAll(want.select(few.columns)).count() == 0 and few.count() == want.count()
