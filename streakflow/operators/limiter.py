"""F8b, the exact limiter, in parallel.

The limiter is a counter that expires ``ttl`` after the last counted attempt; at
``limit`` further attempts are denied and change nothing. What an attempt meets thus
depends on all attempts before it, but the state is small: a count below the limit
(the attempt before was counted, so its time is known), or full with the time of the
last counted attempt.

1. A user's attempts are cut at gaps of at least ``ttl`` (``rate_segments``); there the
   counter has expired whatever came before. Segments of at most ``limit`` attempts
   are allowed whole, by one aggregate.
2. The others are decided whole from the empty counter up to ``WHOLE`` attempts; longer ones
   are cut into chunks of two ``ttl`` of time. Each chunk gives its transfer
   table: for every state that may come in, the state that goes out. Chunks are
   independent, so one busy user's are computed by many tasks.
3. Per segment the tables are composed in order of time, which gives every chunk its
   state on entry. This step reads tables, never attempts.
4. Every chunk decides its attempts from that state, again independently.

A table has one row a count and one a run of full states with one outcome: at most
``limit`` rows plus the attempts of the chunk's first ``ttl``.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streakflow.config import DEFAULT_LIMITS, Limits
from streakflow.operators.windows import DAY_US, previous_value, running_sum
from streakflow.shipping import ship
from streakflow.sources.sinks import staged

US = 1_000_000


def rate_segments(valid: DataFrame, limits: Limits = DEFAULT_LIMITS, ts: str = "created_at",
                  tie: str = "row_id") -> DataFrame:
    """Cut each user's attempts where the gap to the previous attempt is at
    least the counter lifetime: the counter has expired there whatever came
    before (the last counted attempt is no later than the previous attempt),
    so segments can be folded independently. Adds ``segment``."""
    prev = previous_value(valid, ["user_id"], ts, tie, ts, out="_prev_ts")
    gap = (F.unix_micros(F.col(ts)) - F.unix_micros(F.col("_prev_ts"))) >= limits.rate_window_seconds * US
    # written once: the running sum reads it for its totals and for its rows
    starts = staged(prev.withColumn("_start", F.coalesce(gap, F.lit(True)).cast("long")))
    return running_sum(starts, ["user_id"], ts, tie, F.col("_start"), out="segment", bucket_us=DAY_US) \
        .drop("_prev_ts", "_start")


class Chunk:
    """The ascending times of one chunk; gaps are below ``ttl`` (one segment)."""

    def __init__(self, times: np.ndarray, limit: int, ttl: int):
        self.t, self.limit, self.ttl, n = times, limit, ttl, len(times)
        start = np.arange(n)
        last = start + limit - 1  # where a count that begins here is full
        full = last < n
        after = np.full(n, n)
        after[full] = np.searchsorted(times, times[last[full]] + ttl)
        # a count leads to the next one until none begins inside the chunk
        self.onward = after
        jump = np.where(full & (after < n), after, start)
        while True:
            further = jump[jump]
            if (further == jump).all():
                break
            jump = further
        ends_full = jump + limit - 1 < n
        self.out_count = np.where(ends_full, limit, n - jump)
        self.out_time = np.where(ends_full, times[np.minimum(jump + limit - 1, n - 1)], times[-1])

    def enter(self, count: int, time: int) -> int:
        """Where the first new count begins for a full state, or after a carried count."""
        if count < self.limit:
            return 0 if count == 0 else int(np.searchsorted(self.t, self.t[self.limit - count - 1] + self.ttl)) if self.limit - count <= len(self.t) else len(self.t)
        return int(np.searchsorted(self.t, time + self.ttl))

    def leave(self, count: int, time: int) -> tuple[int, int]:
        """The state after the chunk, for the state before it."""
        n, p = len(self.t), self.enter(count, time)
        if p < n:
            return int(self.out_count[p]), int(self.out_time[p])
        if count == self.limit:
            return count, time
        if count + n <= self.limit:
            return count + n, int(self.t[-1])
        return self.limit, int(self.t[self.limit - count - 1])

    def table(self) -> list[tuple[int, int, int, int]]:
        """(count, latest time, count after, time after); full states by ascending time,
        each row standing for times up to its own. Time after -1: unchanged."""
        rows = [(c, 0, *self.leave(c, 0)) for c in range(self.limit)]
        reach = int(np.searchsorted(self.t, self.t[0] + self.ttl))  # a full state begins a count here or earlier
        found: list[tuple[int, int, int, int]] = []
        for p in range(min(reach + 1, len(self.t))):
            row = (self.limit, int(self.t[p]) - self.ttl, int(self.out_count[p]), int(self.out_time[p]))
            if found and found[-1][2:] == row[2:]:
                found.pop()
            found.append(row)
        return rows + found + [(self.limit, np.iinfo(np.int64).max, self.limit, -1)]

    def allowed(self, count: int, time: int) -> np.ndarray:
        n = len(self.t)
        out = np.zeros(n, bool)
        if 0 < count < self.limit:
            out[:self.limit - count] = True
        p = self.enter(count, time)
        while p < n:
            out[p:p + self.limit] = True
            p = int(self.onward[p])
        return out


_KEYS = ["user_id", "segment"]
_TABLE = ["at", "until", "to_count", "to_time"]
#: A segment of at most so many attempts is one piece, decided from the empty counter.
WHOLE = 10_000


def _pieces(column) -> list[np.ndarray]:
    """The lists of an Arrow column of lists of numbers."""
    at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [flat[i:k] for i, k in zip(at[:-1], at[1:])]


def rate_limit_exact(valid: DataFrame, limits: Limits = DEFAULT_LIMITS, whole: int = WHOLE) -> DataFrame:
    """The reference's limiter, attempt by attempt. Input: valid
    attempts (row_id, user_id, created_at). Output adds ``allowed``.

    A chunk travels as one row with its sorted times, so Python sees many chunks a call. Attempts
    are told apart by a written number of their own, ``row_id`` need not be unique."""
    ship(valid.sparkSession)
    limit, ttl = limits.rate_limit, limits.rate_window_seconds * US
    held = staged(valid.withColumn("_row", F.monotonically_increasing_id()))
    seg = staged(rate_segments(held.select("_row", "row_id", "user_id", "created_at"), limits).select(
        "_row", "row_id", *_KEYS, F.unix_micros("created_at").alias("t")))
    busy = seg.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    chunk = F.when(F.col("_n") > whole, F.floor(F.col("t") / F.lit(2 * ttl))).otherwise(F.lit(0)).cast("long")
    chunked = seg.join(busy, _KEYS).select("_row", "row_id", "t", *_KEYS, (F.col("_n") > whole).alias("long"), chunk.alias("chunk"))
    packed = staged(chunked.repartition(*_KEYS, "chunk").groupBy(*_KEYS, "chunk", "long")
                    .agg(F.sort_array(F.collect_list(F.struct("t", "row_id", "_row"))).alias("_a"))
                    .select(*_KEYS, "chunk", "long", F.col("_a.t").alias("t"), F.col("_a._row").alias("rows")))

    def tables(batches):
        for b in batches:
            found = [np.array(Chunk(t, limit, ttl).table(), dtype=np.int64) for t in _pieces(b.column("t"))]
            lists = [pa.array([x[:, k] for x in found], pa.list_(pa.int64())) for k in range(4)]
            yield pa.RecordBatch.from_arrays([b.column(k) for k in (*_KEYS, "chunk")] + lists, [*_KEYS, "chunk", *_TABLE])

    def compose(key, pdf):
        count, time, rows = 0, 0, []
        for chunk, *columns in pdf.sort_values("chunk")[["chunk", *_TABLE]].itertuples(index=False):
            rows.append((key[0], key[1], chunk, count, time))
            at, until, to_count, to_time = (np.asarray(c) for c in columns)
            k = int(np.searchsorted(at, count))  # counts ascend, full states come last, by ascending time
            if count == limit:
                k += int(np.searchsorted(until[k:], time))
            count, time = int(to_count[k]), time if to_time[k] == -1 else int(to_time[k])
        return pd.DataFrame(rows, columns=["user_id", "segment", "chunk", "count", "time"])

    def denied(batches):
        for b in batches:
            entered = zip(_pieces(b.column("t")), _pieces(b.column("rows")), b.column("count").to_pylist(), b.column("time").to_pylist())
            found = [rows[~Chunk(t, limit, ttl).allowed(count, time)] for t, rows, count, time in entered]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int64())], ["_row"])

    parts = packed.where("long")
    moves = parts.select(*_KEYS, "chunk", "t").mapInArrow(
        tables, "user_id string, segment long, chunk long, " + ", ".join(f"{c} array<long>" for c in _TABLE))
    entries = moves.groupBy(*_KEYS).applyInPandas(compose, "user_id string, segment long, chunk long, count long, time long")
    nothing = F.lit(0).cast("long")
    known = packed.where("not long").select("t", "rows", nothing.alias("count"), nothing.alias("time")).unionByName(
        parts.join(entries, [*_KEYS, "chunk"]).select("t", "rows", "count", "time"))
    # what the busy segments denied; all other attempts are allowed
    over = known.mapInArrow(denied, "_row long").withColumn("_denied", F.lit(True))
    return held.join(over, "_row", "left").withColumn("allowed", F.col("_denied").isNull()).drop("_denied", "_row")
