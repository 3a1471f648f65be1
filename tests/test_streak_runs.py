"""Streaks as merged month blocks, and distinct users as merged bitmaps."""
import datetime as dt
import random

from pyspark.sql import functions as F

from streakflow.operators import active_users, streak_runs, streaks, warehouse

DAYS = "user_id string, activity_date date"


def random_days(seed, users=12, span=150):
    rng = random.Random(seed)
    base = dt.date(2023, 11, 20)
    return [(f"u{u}", base + dt.timedelta(days=d)) for u in range(users) for d in range(span) if rng.random() < (u + 1) / users]


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_blocks_equal_gaps_and_islands(spark):
    rows = random_days(1) + [("none", None), ("leap", dt.date(2024, 2, 28)), ("leap", dt.date(2024, 2, 29)), ("leap", dt.date(2024, 3, 1)),
                             ("eve", dt.date(2023, 12, 31)), ("eve", dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 5))]
    daily = spark.createDataFrame(rows * 2, DAYS)
    want = streaks.streaks(daily, "2024-04-18")
    got = streak_runs.streaks_of(streak_runs.month_blocks(daily), "2024-04-18")
    assert got.columns == want.columns and as_set(got) == as_set(want)
    assert streak_runs.streaks_of(streak_runs.month_blocks(daily.limit(0))).count() == 0


def test_days_in_any_order_end_alike(spark, scratch):
    rows = random_days(2)
    random.Random(3).shuffle(rows)
    parts = [rows[:150], rows[150:300], rows[100:200], rows[300:]]  # some come twice
    state = None
    for part in parts:
        daily = spark.createDataFrame(part, DAYS)
        users = streak_runs.add_days(spark, f"{scratch}/blocks", daily)
        blocks = spark.read.parquet(f"{scratch}/blocks")
        fresh = streak_runs.streaks_of(blocks) if state is None else streak_runs.repair(state, blocks, users)
        state = spark.createDataFrame(fresh.collect(), fresh.schema)
    assert as_set(state) == as_set(streaks.streaks(spark.createDataFrame(rows, DAYS)))


def test_a_late_day_reads_and_writes_its_month_only(spark, scratch):
    path = f"{scratch}/blocks"
    streak_runs.add_days(spark, path, spark.createDataFrame(random_days(4), DAYS))
    import os
    def files():
        return {m: sorted(os.listdir(f"{path}/{m}")) for m in os.listdir(path) if m.startswith("month=")}
    before = files()
    late = spark.createDataFrame([("u3", dt.date(2024, 1, 9))], DAYS)
    assert as_set(streak_runs.add_days(spark, path, late)) == {("u3",)}
    after = files()
    assert [m for m in after if after[m] != before.get(m)] == ["month=2024-01-01"]


def test_refreshed_weeks_equal_a_recount(spark):
    rng = random.Random(5)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in range(20)]
    rows = {(f"u{rng.randrange(300)}", d): (rng.choice(["A", "B", None]), rng.randrange(90), 1 + rng.randrange(9)) for d in days for _ in range(60)}
    country = {}
    rows = [(u, d, country.setdefault(u, c), p, n) for (u, d), (c, p, n) in rows.items()]
    schema = "user_id string, event_date date, country string, total_points long, total_events long"
    whole = spark.createDataFrame(rows, schema)
    numbers = stored = None
    for a, b in ((0, 7), (6, 13), (13, 20)):  # day 6 comes twice
        part = spark.createDataFrame([r for r in rows if days[0] + dt.timedelta(days=a) <= r[1] < days[0] + dt.timedelta(days=b)], schema)
        fresh = active_users.number_users(part, numbers).collect()
        fresh = spark.createDataFrame(fresh, "user_id string, user_number long")
        numbers = fresh if numbers is None else numbers.unionByName(fresh)
        pieces = active_users.daily_pieces(part, numbers)
        pieces = spark.createDataFrame(pieces.collect(), pieces.schema)
        stored = pieces if stored is None else active_users.replace_days(stored, pieces)
    assert numbers.count() == numbers.select("user_number").distinct().count() == whole.select("user_id").distinct().count()
    got = active_users.weekly_stats(active_users.weekly_pieces(stored))
    want = warehouse.weekly_streak_stats(whole)
    cols = ["week_start", "country", "active_users", F.round("avg_daily_points", 9).alias("p"), F.round("avg_daily_events", 9).alias("e")]
    assert as_set(got.select(cols)) == as_set(want.select(cols))
