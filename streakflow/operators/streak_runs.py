"""F2 as a structure that merges: streaks that late days repair without a recomputation.

A user's active days are stored as one number per month, whose bit d-1 says that day d
was active. Setting a bit is idempotent and has no order, so days may come late, twice
or in any order. A month gives its runs: the length of the run at its first active day,
of the run at its last active day, and of its longest run. Runs of consecutive months
merge; where one month's last day touches the next month's first day, the two runs become
one. A user's streaks are that merge over at most one row per month of the calendar.

A late day therefore rewrites the blocks of its own month only, and the streaks of its own
user only.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streakflow.config import checkpoint_dir
from streakflow.operators.streaks import effective_streak
from streakflow.sources import sinks

RUNS = "struct<first:int,last:int,prefix:int,suffix:int,best:int,days:int>"


def month_blocks(daily: DataFrame) -> DataFrame:
    """(user_id, month, bits) of the active days in ``daily``; days without a date are no days."""
    day = F.col("activity_date")
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)
    return (daily.where(day.isNotNull())
            .groupBy("user_id", F.trunc(day, "month").alias("month")).agg(F.bit_or(bit).alias("bits")))


def merge_blocks(*blocks: DataFrame) -> DataFrame:
    """The blocks of all days of several tables of blocks."""
    rows = blocks[0]
    for more in blocks[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("user_id", "month").agg(F.bit_or("bits").alias("bits"))


def _month_runs() -> Column:
    """Runs of one block; days are counted from the epoch. In the binary text the last day comes first."""
    text = F.bin("bits")
    start = F.unix_date("month")
    ones = lambda pattern: F.length(F.regexp_extract(text, pattern, 1))
    return F.struct(
        (start + ones("(0*)$")).alias("first"), (start + F.length(text) - 1).alias("last"),
        ones("(1+)0*$").alias("prefix"), ones("^(1+)").alias("suffix"),
        F.array_max(F.transform(F.split(text, "0+"), F.length)).alias("best"),
        F.bit_count("bits").alias("days")).cast(RUNS)


def _joined(a: Column, b: Column) -> Column:
    """Runs of two stretches of days, ``a`` before ``b``. A stretch is one run if its prefix has all its days."""
    touch = a["last"] + 1 == b["first"]
    over = F.when(touch, a["suffix"] + b["prefix"]).otherwise(F.lit(0))
    return F.struct(
        a["first"].alias("first"), b["last"].alias("last"),
        F.when(touch & (a["prefix"] == a["days"]), a["prefix"] + b["prefix"]).otherwise(a["prefix"]).alias("prefix"),
        F.when(touch & (b["prefix"] == b["days"]), a["suffix"] + b["suffix"]).otherwise(b["suffix"]).alias("suffix"),
        F.greatest(a["best"], b["best"], over).alias("best"), (a["days"] + b["days"]).alias("days")).cast(RUNS)


def streaks_of(blocks: DataFrame, as_of_date: str | dt.date | None = None) -> DataFrame:
    """F2 from blocks: the same columns as ``streaks.streaks``."""
    months = F.array_sort(F.collect_list(F.struct("month", _month_runs().alias("runs"))))
    users = blocks.where("bits <> 0").groupBy("user_id").agg(months.alias("months"))
    runs = F.aggregate(F.slice("months", 2, F.size("months")), F.col("months")[0]["runs"],
                       lambda done, month: _joined(done, month["runs"]))
    out = users.select("user_id", runs.alias("r")).select(
        "user_id", F.col("r.suffix").cast("long").alias("current_streak"), F.col("r.best").cast("long").alias("longest_streak"),
        F.date_from_unix_date("r.last").alias("last_activity_date"), F.col("r.days").cast("long").alias("version"))
    return out if as_of_date is None else effective_streak(out, as_of_date)


def add_days(spark: SparkSession, path: str, daily: DataFrame) -> DataFrame:
    """Adds days to the table of blocks at ``path`` (partitioned by month) and returns the
    users concerned. Only months of the new days are read and rewritten; a batch that
    comes again, also after a crash, changes nothing."""
    checkpoint_dir(spark)
    new = month_blocks(daily).checkpoint(eager=True)
    if sinks.table_exists(spark, path):
        # as many values as the batch has months
        months = [r.month for r in new.select("month").distinct().toLocalIterator()]
        stored = spark.read.parquet(path).where(F.col("month").isin(months)).select(new.columns)
        merged = merge_blocks(stored, new).checkpoint(eager=True)
    else:
        merged = new
    sinks.write_partitioned(merged, path, partition_col="month")
    return new.select("user_id").distinct()


def repair(state: DataFrame, blocks: DataFrame, users: DataFrame) -> DataFrame:
    """``state`` (rows of ``streaks_of``) with the streaks of ``users`` derived anew from their blocks."""
    same = F.col("user_id").eqNullSafe(F.col("_changed"))
    changed = users.select(F.col("user_id").alias("_changed")).distinct()
    kept = state.join(changed, same, "left_anti")
    renewed = streaks_of(blocks.join(changed, same, "left_semi"))
    return kept.select(renewed.columns).unionByName(renewed)
