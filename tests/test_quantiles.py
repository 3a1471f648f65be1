"""Lag sketches: bounded error, merge equal to a single sketch, refresh without a recount."""
import math

from pyspark.sql import functions as F

from streakflow.operators import quality


def lags(spark, n=4000):
    return spark.range(n).select((F.col("id") % 5).alias("day"), (F.col("id") % 3).alias("part"),
                                 F.when(F.col("id") % 3 == 0, F.lit(2.5)).when(F.col("id") % 97 == 0, F.lit(0.0))
                                 .otherwise(F.pow(F.lit(1.01), F.col("id") % 1500)).alias("lag"))


def test_sketch_error_and_merge(spark):
    rows = lags(spark)
    once = quality.lag_sketch(rows, "lag", ["day"])
    old, new = (quality.lag_sketch(rows.where(c), "lag", ["day"]) for c in ("part < 2", "part = 2"))
    merged = quality.merge_sketches(old.unionByName(new), ["day"])  # a refresh adds the new part's counts only
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, merged.select(once.columns).collect()))
    values = {}
    for r in rows.collect():
        values.setdefault(r.day, []).append(r.lag)
    exact = {r.day: r for r in quality.exact_quantiles(rows, "lag", ["day"]).collect()}
    for r in quality.sketch_quantiles(merged, ["day"]).collect():
        own = sorted(values[r.day])
        assert r.updates == len(own)
        for name, q in quality.QUANTILES.items():
            want = own[math.ceil(q * len(own) / 100) - 1]
            assert exact[r.day][name] == want and abs(r[f"{name}_sketch"] - want) <= 0.01 * want + 1e-9


def test_sketch_of_nothing(spark):
    none = lags(spark).withColumn("lag", F.lit(None).cast("double"))
    assert quality.sketch_quantiles(quality.lag_sketch(none, "lag", ["day"]), ["day"]).count() == 0
    assert quality.exact_quantiles(none, "lag", ["day"]).count() == 0


def test_gap_scan_reads_the_asked_range_only(spark, scratch):
    spark.range(1000).select((F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("created_at")).write.parquet(f"{scratch}/t")
    gaps = quality.partition_gaps(spark.read.parquet(f"{scratch}/t"), "2024-01-05 00:00:00", "2024-01-06 00:00:00")
    plan = gaps._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(created_at" in plan and "LessThan(created_at" in plan and gaps.count() == 0
