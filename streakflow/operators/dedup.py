"""Deduplication and enrichment joins."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def dedup_first(df: DataFrame, key: str | Sequence[str] = "idempotency_key",
                order: Sequence[str] = ("created_at", "event_id"), method: str = "aggregate") -> DataFrame:
    """Keep the earliest row per key in ``order`` (ties broken by the
    following order columns).

    ``aggregate`` (default) is ``min_by(row, order)`` per key: a hash
    aggregate with map-side combine, so a key repeated millions of times is
    reduced inside each map task before the shuffle. ``window`` is the
    ``row_number() == 1`` form (one task per key; Catalyst adds a
    WindowGroupLimit).
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = df.columns
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    rest = [c for c in cols if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*").select(*cols)


def drop_seen(batch: DataFrame, history: DataFrame, key: str = "idempotency_key") -> DataFrame:
    """Rows whose key is not yet in ``history`` (anti join on the key;
    Catalyst broadcasts the key side only when its size estimate allows)."""
    return batch.join(history.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def first_writer_wins(batch: DataFrame, history: DataFrame | None = None, key: str = "idempotency_key",
                      order: Sequence[str] = ("created_at", "event_id"), id_col: str = "event_id") -> DataFrame:
    """D3: every batch row with ``is_duplicate`` and ``original_event_id``.

    A row is a duplicate when an earlier row of the batch has its key, or the
    key is already in ``history``; the original is the history row, else the
    batch's first. The first row per key comes from the ``min_by`` aggregate
    (skew-safe); joining it back is an equi-join AQE can split when one key
    is hot.
    """
    firsts = batch.groupBy(key).agg(
        F.min_by(F.col(id_col), F.struct(*[F.col(c) for c in order])).alias("_first_id"))
    out = batch.join(firsts, key, "left")
    if history is not None:
        seen = history.groupBy(key).agg(F.min(id_col).alias("_hist_id"))
        out = out.join(seen, key, "left")
    else:
        out = out.withColumn("_hist_id", F.lit(None).cast("string"))
    is_dup = F.col("_hist_id").isNotNull() | (F.col(id_col) != F.col("_first_id"))
    return (out.withColumn("is_duplicate", F.coalesce(is_dup, F.lit(False)))
               .withColumn("original_event_id", F.when(F.col("is_duplicate"),
                                                       F.coalesce(F.col("_hist_id"), F.col("_first_id"))))
               .drop("_first_id", "_hist_id"))


def unique_dim(dim: DataFrame, key: str = "user_id") -> DataFrame:
    """One row per key (the smallest), so a left join cannot multiply rows."""
    rest = [c for c in dim.columns if c != key]
    return dim.groupBy(key).agg(F.min(F.struct(*rest)).alias("_d")).select(key, "_d.*")


def enrich(events: DataFrame, dim: DataFrame, key: str = "user_id",
           columns: Sequence[str] = ("country", "signup_date", "user_segment")) -> DataFrame:
    """Left join with the user dimension, row count preserved.

    No broadcast hint: the dimension grows with the user base. Spark's
    size estimate (``autoBroadcastJoinThreshold``, and AQE on the real
    shuffle size) decides broadcast vs shuffle join, and AQE splits a hot
    user's partition.
    """
    d = unique_dim(dim.select(key, *columns), key)
    return events.join(d, key, "left")
