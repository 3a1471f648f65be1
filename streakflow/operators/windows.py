"""Per-key sequential window helpers that stay parallel under skew.

A plain ``Window.partitionBy(user_id)`` sends all rows of one user to one
task; if one user holds a third of the log that task holds a third of the
data. These helpers split every key by event-time bucket:

* ``trailing_sum``: sum over the trailing ``width`` of each row. Each row is
  also copied into the following buckets as read-only context, so a bucket
  holds its own rows plus the last ``width`` before it and the frame is exact.
* ``previous_value``: the value of the previous row of the same key (``lag``)
  when the previous row may sit in an earlier bucket: the last row of every
  bucket is found by a partial aggregate, carried forward over the (small)
  per-bucket table, and joined back.

Order within a key is (``ts``, ``tie``); ``tie`` breaks equal timestamps. Rows whose key
is null are no sequence: ``previous_value`` and ``running_sum`` see their bucket only.

A bucket is a day or a window's width, so a key that holds much of one day would
still be one task. ``dense_keys`` finds such keys from counts; given them, the
helpers cut these keys' rows into cells of a minute instead:

* ``trailing_sum`` in two levels: sums of whole cells come from a table of one row
  per (key, cell), so a row meets only the rows of its own cell and of the cell in
  which its window begins;
* the others take the cell as the bucket.

Where no key holds more rows than one task may (``light_keys`` finds out first), no bucket
is needed: with ``whole`` a key is one bucket, without copies and without carried values.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
MINUTE_US = 60_000_000
#: A key is dense if one of its days has more than one row in ``DENSE_SHARE`` of all rows, so there
#: are fewer dense keys than that (the bound of their broadcast), and more than ``DENSE_FLOOR`` rows.
DENSE_SHARE = 10_000
DENSE_FLOOR = 50_000
#: Rows of one key that a task may hold, and the hash groups whose counts bound a key's rows.
LIGHT_ROWS = 200_000
LIGHT_GROUPS = 1 << 16


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def dense_keys(df: DataFrame, keys: Sequence[str], ts: str, floor: int = DENSE_FLOOR, share: int = DENSE_SHARE) -> DataFrame:
    """The keys of which some day holds more than ``floor`` rows and more than one row in
    ``share`` of all. One aggregate of narrow rows; fewer than ``share`` keys result."""
    days = df.groupBy(*keys, F.floor(_micros(ts) / F.lit(DAY_US)).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    total = days.agg(F.sum("_n")).scalar()
    return days.where((F.col("_n") > floor) & (F.col("_n") * share > total)).select(*keys).distinct()


def hot_keys(df: DataFrame, keys: Sequence[str], ts: str, floor: int = DENSE_FLOOR, share: int = DENSE_SHARE) -> DataFrame | None:
    """``dense_keys``, written once, or None where no key is dense: the windows then need no
    second form, and the plan stays as small as it was."""
    from streakflow.sources.sinks import staged

    found = staged(dense_keys(df, keys, ts, floor, share))
    return None if found.isEmpty() else found


def light_keys(df: DataFrame, keys: Sequence[str], most: int = LIGHT_ROWS, groups: int = LIGHT_GROUPS) -> bool:
    """Whether surely no key holds more than ``most`` rows, or than twice the mean hash group
    of a larger table. A key has no more rows than its hash group, so only counts of a fixed
    number of groups are shuffled, and a heavy group of light keys just gives False. Rows
    with a null among the keys are not counted."""
    counts = df.select(*keys).dropna().groupBy(F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    largest, total = counts.agg(F.coalesce(F.max("_n"), F.lit(0)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    return largest <= max(most, 2 * total // groups)


def _marked(df: DataFrame, keys: Sequence[str], dense: DataFrame | None) -> DataFrame:
    """``df`` with ``_dense``. The dense keys are fewer than ``DENSE_SHARE``, so they are broadcast."""
    if dense is None:
        return df.withColumn("_dense", F.lit(False))
    few = F.broadcast(dense.select(*[F.col(k).alias(f"_dense_{k}") for k in keys], F.lit(True).alias("_dense")))
    same = [df[k].eqNullSafe(few[f"_dense_{k}"]) for k in keys]
    marked = df.join(few, same, "left").drop(*[f"_dense_{k}" for k in keys])
    return marked.withColumn("_dense", F.coalesce("_dense", F.lit(False)))


def _bucket_start(ts: str, bucket_us: int, cell_us: int, dense: DataFrame | None) -> Column:
    """Start of a row's bucket: of its cell for a dense key."""
    t = _micros(ts)
    wide = F.floor(t / F.lit(bucket_us)).cast("long") * F.lit(bucket_us)
    if dense is None:
        return wide
    return F.when(F.col("_dense"), F.floor(t / F.lit(cell_us)).cast("long") * F.lit(cell_us)).otherwise(wide)


def trailing_sum(df: DataFrame, keys: Sequence[str], ts: str, tie: str, width_us: int,
                 value: Column | None = None, out: str = "trailing", include_current: bool = True,
                 bucket_us: int | None = None, dense: DataFrame | None = None, cell_us: int = MINUTE_US,
                 whole: bool = False) -> DataFrame:
    """Add ``out`` = sum of ``value`` (default 1 = a count) over rows of the
    same key whose time lies in ``[t - width + 1us, t]`` and that come no
    later than the current row in (ts, tie) order (the row itself included
    or not).

    Rows are partitioned by (key, time bucket). A row is also emitted, as
    read-only context, into each following bucket whose frames can still
    reach it (``explode``: the input is read once). With buckets wider than
    the window (e.g. a day for an hour) only rows near a bucket's end are
    copied; buckets narrower than the window spread a dense key over more
    tasks at the cost of more copies. Default: one window width.

    Rows of ``dense`` keys go into cells of ``cell_us`` (a divisor of the width). A
    row's copy meets only the cell in which the row leaves the window; what lies
    in the cells between comes as one more row per cell, whose sum is taken from the
    table of cell sums (one row per key and cell that has rows: bounded by the calendar).

    With ``whole`` (``light_keys``) every key is one bucket, and ``ts`` may be microseconds.
    """
    keys = list(keys)
    if whole:
        t = F.col(ts) if df.schema[ts].dataType == LongType() else _micros(ts)
        u = df.select("*", t.alias("_t"), F.coalesce((F.lit(1) if value is None else value).cast("long"), F.lit(0).cast("long")).alias("_v"))
        return u.withColumn(out, _upto_row_within(Window.partitionBy(*keys), tie, width_us, include_current)).drop("_t", "_v")
    if dense is not None and width_us % cell_us:
        raise ValueError("the width must be a multiple of the cell")
    df = _marked(df, keys, dense)
    bucket = bucket_us or width_us
    reach = -(-width_us // bucket)
    val = F.lit(1) if value is None else value
    t = _micros(ts)
    b0 = F.floor(t / F.lit(bucket)).cast("long")
    if reach == 1:  # the common case, in plain expressions (stays in codegen)
        offsets = F.when(t + F.lit(width_us) > (b0 + 1) * F.lit(bucket), F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))) \
            .otherwise(F.array(F.lit(0).cast("long")))
    else:
        offsets = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(reach).cast("long")),
                           lambda k: (k == 0) | (t + F.lit(width_us) > (b0 + k) * F.lit(bucket)))
    summed = F.coalesce(val.cast("long"), F.lit(0).cast("long"))
    if value is not None:  # a row of value 0 adds nothing to a later bucket
        offsets = F.when(summed == 0, F.array(F.lit(0).cast("long"))).otherwise(offsets)
    if dense is not None:
        cells = width_us // cell_us
        cell = F.floor(t / F.lit(cell_us)).cast("long")
        offsets = F.when(F.col("_dense") & (summed != 0), F.array(F.lit(0).cast("long"), F.lit(cells).cast("long"))).otherwise(offsets)
        b0 = F.when(F.col("_dense"), cell).otherwise(b0)
    u = df.select("*", t.alias("_t"), summed.alias("_v"), b0.alias("_b0"), F.explode(offsets).alias("_k"))
    u = u.withColumns({"_b": F.col("_b0") + F.col("_k"), "_own": F.col("_k") == 0})
    if dense is not None:
        between = Window.partitionBy(*keys).orderBy("_b").rangeBetween(-(cells - 1), -1)
        per_cell = df.where("_dense").groupBy(*keys, cell.alias("_b")).agg(F.sum(summed).alias("_cell_sum"))
        inner = per_cell.select(*keys, "_b", F.sum("_cell_sum").over(between).alias("_mid"),
                                (F.col("_b") * F.lit(cell_us)).alias("_t"), F.lit(0).cast("long").alias("_v"), F.lit(False).alias("_own"))
        u = u.unionByName(inner, allowMissingColumns=True)
    part = Window.partitionBy(*keys, "_b")
    total = _upto_row_within(part, tie, width_us, include_current)
    if dense is not None:  # a cell's row lies at the cell's start, before its own rows
        total = total + F.coalesce(F.sum("_mid").over(part.orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    return u.withColumn(out, total).where("_own").drop("_t", "_v", "_k", "_b0", "_b", "_own", "_dense", "_mid")


def _upto_row_within(part, tie: str, width_us: int, include_current: bool) -> Column:
    """Sum of ``_v`` over the rows of ``part`` up to this one in (_t, tie) order, less those
    that have left the window. Both sums only ever grow along the order, so a row costs the
    same however many rows its window holds; one sort serves both."""
    upto_row = F.sum("_v").over(part.orderBy("_t", tie).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    left = F.sum("_v").over(part.orderBy("_t").rangeBetween(Window.unboundedPreceding, -width_us))
    total = upto_row - F.coalesce(left, F.lit(0))
    return total if include_current else total - F.col("_v")


def previous_value(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str,
                   out: str | None = None, bucket_us: int = DAY_US, where: Column | None = None,
                   dense: DataFrame | None = None, cell_us: int = MINUTE_US, whole: bool = False) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row of the same key in
    (ts, tie) order (null for the first row), without one task per key.
    With ``where``, only rows meeting it count as previous rows. With ``whole``
    (``light_keys``) every key is one bucket."""
    keys = list(keys)
    out = out or f"prev_{value}"
    cond = F.lit(True) if where is None else where
    if whole:
        before = Window.partitionBy(*keys).orderBy(F.col(ts), F.col(tie)).rowsBetween(Window.unboundedPreceding, -1)
        boxed = F.when(cond, F.struct(F.col(value).alias("v")))  # a null value counts as well
        return df.withColumn(out, F.last(boxed, ignorenulls=True).over(before)["v"])
    rows = _marked(df, keys, dense).withColumns({
        "_b": _bucket_start(ts, bucket_us, cell_us, dense), "_pv": F.when(cond, F.struct(F.col(value).alias("v")))})
    # last qualifying row per (key, bucket), for every bucket that has rows:
    # a partial aggregate, hot keys combine map-side
    last = rows.groupBy(*keys, "_b").agg(
        F.max(F.when(F.col("_pv").isNotNull(), F.struct(F.col(ts), F.col(tie), F.col("_pv"))))["_pv"].alias("_last"))
    # carry the last qualifying value of earlier buckets: one row per
    # key-bucket, so this window is small
    per_key = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*keys, "_b", F.last("_last", ignorenulls=True).over(per_key).alias("_carry"))
    within = (Window.partitionBy(*keys, "_b").orderBy(F.col(ts), F.col(tie))
              .rowsBetween(Window.unboundedPreceding, -1))
    before = F.last("_pv", ignorenulls=True).over(within)
    return (rows.join(carried, [*keys, "_b"], "left")
                .withColumn(out, F.coalesce(before, F.col("_carry"))["v"])
                .drop("_b", "_pv", "_carry", "_dense"))


def running_sum(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: Column, out: str,
                bucket_us: int = DAY_US, dense: DataFrame | None = None, cell_us: int = MINUTE_US) -> DataFrame:
    """Add ``out`` = running sum of ``value`` per key in (ts, tie) order,
    current row included: per-bucket totals (partial aggregate), their
    prefix over the small per-bucket table, plus the running sum inside the
    bucket."""
    keys = list(keys)
    rows = _marked(df, keys, dense).withColumns({
        "_b": _bucket_start(ts, bucket_us, cell_us, dense), "_rv": F.coalesce(value.cast("long"), F.lit(0).cast("long"))})
    per_bucket = rows.groupBy(*keys, "_b").agg(F.sum("_rv").alias("_bs"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*keys, "_b", F.coalesce(F.sum("_bs").over(before), F.lit(0)).alias("_off"))
    within = (Window.partitionBy(*keys, "_b").orderBy(F.col(ts), F.col(tie))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.join(offsets, [*keys, "_b"], "left")
                .withColumn(out, (F.col("_off") + F.sum("_rv").over(within)).cast("long"))
                .drop("_b", "_rv", "_off", "_dense"))
