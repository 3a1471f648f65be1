"""The parallel limiter against the attempt-by-attempt rule."""
import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from streakflow.config import Limits
from streakflow.operators import limiter
from streakflow.operators.sequential import UserState, rate_step


def stepwise(times, limits):
    state = UserState()
    return [rate_step(state, int(t), limits) for t in times]


@pytest.mark.parametrize("seed", range(6))
def test_chunks_compose_to_the_rule(seed):
    rng = np.random.default_rng(seed)
    limit, ttl = int(rng.integers(1, 6)), 100 * limiter.US
    limits = Limits(rate_limit=limit, rate_window_seconds=100)
    for _ in range(150):
        steps = rng.choice([0, 1, 7, 30, 60, 99], rng.integers(1, 60)) * limiter.US  # one segment: gaps below the lifetime
        times = np.cumsum(steps) + 1_700_000_000 * limiter.US
        count, time, got = 0, 0, []
        for part in np.split(times, np.flatnonzero(np.diff(times // (2 * ttl))) + 1):
            chunk = limiter.Chunk(part, limit, ttl)
            got += chunk.allowed(count, time).tolist()
            rows = [r for r in chunk.table() if r[0] == count]
            row = rows[0] if count < limit else next(r for r in rows if r[1] >= time)
            assert (row[2], time if row[3] == -1 else row[3]) == chunk.leave(count, time)
            count, time = chunk.leave(count, time)
        assert got == stepwise(times, limits)


def test_a_hot_user_is_spread_and_exact(spark):
    limits = Limits(rate_limit=3, rate_window_seconds=600)
    n = 6000
    df = spark.range(n).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("user_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=((F.col("id") * 37) % 86_400).cast("int"))).alias("created_at"))
    got = {r.row_id: r.allowed for r in limiter.rate_limit_exact(df, limits).collect()}
    want = {}
    for _, g in df.toPandas().sort_values(["user_id", "created_at", "row_id"]).groupby("user_id"):
        want.update(zip(g["row_id"], stepwise(g["created_at"].astype("datetime64[us]").astype("int64"), limits)))
    assert got == want and 0 < sum(want.values()) < n
    # the hot user never pauses: one segment, yet many chunks, each a task's work of its own
    seg = limiter.rate_segments(df.where("user_id = 'hot'"), limits)
    chunks = seg.select("segment", F.floor(F.unix_micros("created_at") / F.lit(1200 * limiter.US)).alias("chunk")).distinct().collect()
    assert len({c.segment for c in chunks}) == 1 and len(chunks) >= 72


@pytest.mark.parametrize("whole", [20, 10_000])
def test_segments_whole_and_in_chunks_with_repeated_row_ids(spark, whole):
    # two attempts share every row id; each must come out once, with its own verdict
    limits = Limits(rate_limit=3, rate_window_seconds=600)
    n = 3000
    df = spark.range(n).select(
        (F.col("id") % (n // 2)).alias("row_id"), F.concat(F.lit("u"), F.col("id") % 7).alias("user_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=((F.col("id") * 41) % 70_000).cast("int"))).alias("created_at"))
    got = sorted(tuple(r) for r in limiter.rate_limit_exact(df, limits, whole).select("user_id", F.unix_micros("created_at"), "row_id", "allowed").collect())
    want = []
    for user, g in df.toPandas().sort_values(["user_id", "created_at", "row_id"]).groupby("user_id"):
        times = g["created_at"].astype("datetime64[us]").astype("int64")
        want += [(user, int(t), int(r), a) for t, r, a in zip(times, g["row_id"], stepwise(times, limits))]
    assert got == sorted(want) and 0 < sum(w[3] for w in want) < n


def test_no_attempts(spark):
    empty = spark.createDataFrame([], "row_id long, user_id string, created_at timestamp")
    assert limiter.rate_limit_exact(empty).columns == ["row_id", "user_id", "created_at", "allowed"] and limiter.rate_limit_exact(empty).count() == 0
