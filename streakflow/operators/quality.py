"""Data-quality checks and monitors, all as rows (no driver-side
counting): a failed check is a row with ``passed = false``."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from streakflow.config import DEFAULT_LIMITS, Limits


def _check(df: DataFrame, table: str, check: str, passed, detail) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                     passed.alias("passed"), detail.cast("string").alias("detail"))


def schema_check(df: DataFrame, table: str, declared: StructType) -> DataFrame:
    """Columns and types as declared (evaluated on the plan's schema)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = [f.name for f in declared.fields if f.name not in have]
    wrong = [f.name for f in declared.fields if f.name in have and have[f.name] != f.dataType.simpleString()]
    detail = ";".join([f"missing:{m}" for m in missing] + [f"type:{w}" for w in wrong])
    spark = df.sparkSession
    return spark.range(1).select(F.lit(table).alias("table_name"), F.lit("schema").alias("check_name"),
                                 F.lit(not missing and not wrong).alias("passed"), F.lit(detail).alias("detail"))


def non_empty(df: DataFrame, table: str) -> DataFrame:
    agg = df.agg(F.count(F.lit(1)).alias("n"))
    return _check(agg, table, "non_empty", F.col("n") > 0, F.col("n"))


def key_unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """No key value appears twice (one aggregate on the key, then a count)."""
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    agg = dup.agg(F.count(F.lit(1)).alias("dups"))
    return _check(agg, table, "key_unique:" + ",".join(key), F.col("dups") == 0, F.col("dups"))


def _two_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row (b, a) with the row counts of two frames: two global
    aggregates stacked and folded, no join."""
    b = before.agg(F.count(F.lit(1)).alias("n")).select(F.col("n").alias("b"), F.lit(None).cast("long").alias("a"))
    a = after.agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("long").alias("b"), F.col("n").alias("a"))
    return b.unionByName(a).agg(F.max("b").alias("b"), F.max("a").alias("a"))


def row_preserving(before: DataFrame, after: DataFrame, table: str) -> DataFrame:
    """A step (e.g. enrichment) kept the row count."""
    return _check(_two_counts(before, after), table, "row_preserving", F.col("a") == F.col("b"),
                  F.concat_ws("->", F.col("b").cast("string"), F.col("a").cast("string")))


def not_increasing(before: DataFrame, after: DataFrame, table: str) -> DataFrame:
    """A step (e.g. dedup) never added rows."""
    return _check(_two_counts(before, after), table, "not_increasing", F.col("a") <= F.col("b"),
                  F.concat_ws("->", F.col("b").cast("string"), F.col("a").cast("string")))


def dq_checks(*checks: DataFrame) -> DataFrame:
    """Union of check rows."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def ingest_error_rate(verdicts: DataFrame, window: str = "1 hour", ts: str = "received_at",
                      statuses: Sequence[str] = ("error",), limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Share of unexpected errors per tumbling window (rejections are
    answers, not errors); ``alert`` above the threshold."""
    is_err = F.col("status").isin(list(statuses)).cast("int")
    return (verdicts.groupBy(F.window(F.col(ts), window).alias("w"))
            .agg(F.count(F.lit(1)).alias("attempts"), F.sum(is_err).cast("long").alias("errors"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "attempts", "errors",
                    (F.col("errors") / F.col("attempts")).alias("error_rate"))
            .withColumn("alert", F.col("error_rate") > limits.error_rate_alert))


def update_lag(events: DataFrame, updated: str = "received_at", limits: Limits = DEFAULT_LIMITS,
               by: str = "event_date") -> DataFrame:
    """Seconds from event time to state update per day: count, mean,
    max and how many exceeded the alert limit."""
    lag = F.unix_micros(F.col(updated)) - F.unix_micros(F.col("created_at"))
    secs = lag / F.lit(1_000_000.0)
    return (events.withColumn("_lag", secs).groupBy(by).agg(
        F.count(F.lit(1)).alias("updates"),
        F.avg("_lag").alias("avg_lag_seconds"),
        F.max("_lag").alias("max_lag_seconds"),
        F.count_if(F.col("_lag") > limits.update_lag_seconds).alias("late_updates")))


#: Buckets of a quantile sketch grow by this factor; a quantile is off by 1 % of its value at most.
SKETCH_GROWTH = 1.02
QUANTILES = {"p50": 50, "p95": 95, "p99": 99}


def lag_sketch(rows: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """A mergeable quantile sketch of ``value``: counts by logarithmic bucket
    (0 for values of at most a millionth). Two sketches merge by adding counts, so a
    day's sketch is kept and never recounted; its size follows the range of the values
    (some 60 buckets a factor of 3), not their number. Null values are not counted."""
    bucket = F.when(F.col(value) <= 1e-6, F.lit(0)).otherwise(
        F.ceil(F.log(F.col(value) * 1e6) / F.log(F.lit(SKETCH_GROWTH)))).cast("long")
    return rows.where(F.col(value).isNotNull()).groupBy(*by, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    return parts.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` columns, ``updates`` and the quantiles of a sketch (a bucket's middle)."""
    whole = Window.partitionBy(*by)
    ranked = sketch.select(*by, "bucket", F.sum("n").over(whole.orderBy("bucket")).alias("_upto"), F.sum("n").over(whole).alias("updates"))
    middle = F.when(F.col("bucket") == 0, F.lit(0.0)).otherwise(
        F.pow(F.lit(SKETCH_GROWTH), F.col("bucket")) * (2 / (1 + SKETCH_GROWTH)) / 1e6)
    return ranked.groupBy(*by, "updates").agg(*[
        F.min_by(middle, F.when(F.col("_upto") * 100 >= F.col("updates") * q, F.col("bucket"))).alias(f"{name}_sketch")
        for name, q in QUANTILES.items()])


def exact_quantiles(rows: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """The same quantiles exactly: the smallest value that so many per cent do not
    exceed. Distinct values are counted first, so equal values cost one row a task."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*by)
    ranked = counts.select(*by, value, F.sum("n").over(whole.orderBy(value)).alias("_upto"), F.sum("n").over(whole).alias("_all"))
    return ranked.groupBy(*by).agg(*[F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * q, F.col(value))).alias(name) for name, q in QUANTILES.items()])


def partition_gaps(present: DataFrame, start, end, ts: str = "created_at") -> DataFrame:
    """Hours in [start, end) without any row. The hour range is
    generated on executors (``sequence`` + ``explode``) and anti-joined
    with the distinct hours present."""
    spark = present.sparkSession
    hours = spark.range(1).select(F.explode(F.sequence(
        F.lit(str(start)).cast("timestamp"),
        F.lit(str(end)).cast("timestamp") - F.expr("INTERVAL 1 HOUR"),
        F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    # only the asked range is read
    wanted = present.where((F.col(ts) >= F.lit(str(start)).cast("timestamp")) & (F.col(ts) < F.lit(str(end)).cast("timestamp")))
    seen = wanted.select(F.date_trunc("hour", F.col(ts)).alias("hour")).distinct()
    return hours.join(seen, "hour", "left_anti")


def attempts_by_hour(events: DataFrame, ts: str = "created_at") -> DataFrame:
    """Accepted attempts per user per clock hour."""
    return events.groupBy("user_id", F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
        F.count(F.lit(1)).alias("attempts"))
