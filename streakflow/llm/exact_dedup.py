"""Exact dedup: counting quotient filters, merged losslessly, then byte verification.

Texts are equal when their white-space-normalised bytes are equal.

1. One scan writes a narrow table: id, 64-bit fingerprint, SHA-256 of the
   normalised text.
2. Each partition of it builds a counting quotient filter. A fingerprint's top bits
   are its quotient, the rest its remainder; a quotient's run holds sorted distinct
   remainders with counters. A hot text is one remainder with a large counter.
3. Runs are shuffled by quotient and merged by their sorted remainders. Quotient and
   remainder give back the whole fingerprint, so no filter error arises. Only
   fingerprints counted more than once go on.
4. Only texts under those fingerprints are shuffled: while the fingerprints are few they
   reach the scan by broadcast. Texts are grouped by their bytes, combined before the
   shuffle, so a text that a third of all rows share is one row a task. This is the
   verification: texts that merely collide fall into different groups. With more
   fingerprints than ``most_broadcast``, texts are combined first and then joined.

Cases: null counts as empty; rows that repeat the smallest id of a group are one row
repeated, and exactly one of them is kept; a null id sorts after all others; other
columns are not read; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streakflow.llm.common import cut, map_arrow, normalised, small_side


def _filters(quotient_bits: int):
    shift = np.uint64(64 - quotient_bits)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for batch in batches]
        if not parts:
            return
        prints, counts = np.unique(np.concatenate(parts), return_counts=True)
        if not len(prints):
            return
        quotients = prints >> shift
        remainders = prints & ((np.uint64(1) << shift) - np.uint64(1))
        starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]])
        ends = np.r_[starts[1:], len(prints)]
        yield pa.RecordBatch.from_arrays([
            pa.array(quotients[starts].astype(np.int32)),
            pa.array([remainders[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            pa.array([counts[a:b].astype(np.int64).tobytes() for a, b in zip(starts, ends)], pa.binary()),
        ], names=["quotient", "remainders", "counts"])

    return build


def _merge(quotient_bits: int):
    shift = np.uint64(64 - quotient_bits)

    def rows(batches):
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for quotient, runs in groupby(rows(batches), lambda row: row[0]):  # one quotient in memory at a time
            runs = list(runs)
            remainders = np.concatenate([np.frombuffer(r, np.uint64) for _, r, _ in runs])
            counts = np.concatenate([np.frombuffer(c, np.int64) for _, _, c in runs])
            order = np.argsort(remainders, kind="stable")
            remainders, counts = remainders[order], counts[order]
            starts = np.flatnonzero(np.r_[True, remainders[1:] != remainders[:-1]])
            total = np.add.reduceat(counts, starts)
            again = total > 1
            if again.any():
                prints = (np.uint64(quotient) << shift) | remainders[starts[again]]
                yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.array(total[again])],
                                                 names=["fp", "n_rows"])

    return merge


def repeated_fingerprints(prints: DataFrame, quotient_bits: int = 14) -> DataFrame:
    """(fp, n_rows) of the fingerprints of column ``fp`` that more than one row has.
    A task holds the fingerprints of one input partition or of one quotient; raise
    ``quotient_bits`` with the corpus (14 suits up to some 10^10 rows)."""
    filters = map_arrow(prints.select("fp"), _filters(quotient_bits), "quotient int, remainders binary, counts binary")
    runs = filters.repartition("quotient").sortWithinPartitions("quotient")
    return map_arrow(runs, _merge(quotient_bits), "fp long, n_rows long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", quotient_bits: int = 14,
                most_broadcast: int = 1_000_000) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.
    ``most_broadcast`` bounds the fingerprints (8 bytes each) sent to every executor."""
    text = normalised(text_col)
    base = cut(docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                           text.alias("body")).select("id", "row", F.xxhash64("body").alias("fp"),
                                                      F.sha2("body", 256).alias("sha")))
    again = cut(repeated_fingerprints(base, quotient_bits).select("fp"))
    bodies = docs.select(F.col(id_col).alias("id"), text.alias("body")).withColumn("fp", F.xxhash64("body"))

    def by_bytes_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("fp", "body").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))

    if again.count() <= most_broadcast:
        groups = by_bytes_of(bodies.join(F.broadcast(again), "fp", "left_semi"))
    else:
        groups = by_bytes_of(bodies).join(again, "fp", "left_semi")
    groups = groups.select("fp", F.sha2("body", 256).alias("sha"), "keep_id", "n")
    groups = cut(groups)
    first = (base.join(groups, ["fp", "sha"]).where(F.col("id").eqNullSafe(F.col("keep_id")))
             .groupBy("fp", "sha", "keep_id", "n").agg(F.min("row").alias("keep_row")))
    joined = base.join(first, ["fp", "sha"], "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all its columns) without the rows that repeat an earlier text. Only rows
    that go, or that repeat one id with one text, are looked up; the others pass."""
    verdict = exact_dedup(docs, id_col, text_col)
    odd = (verdict.groupBy(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha"))
           .agg(F.max("kept").alias("__kept"), F.count(F.lit(1)).alias("__n")).where("not __kept or __n > 1"))
    odd = small_side(odd, 500_000)
    keyed = docs.withColumn("__own", F.sha2(normalised(text_col), 256))
    same = keyed[id_col].eqNullSafe(odd["__id"]) & (keyed["__own"] == odd["__sha"])
    passed = keyed.join(odd, same, "left_anti").select(docs.columns)
    first = keyed.join(odd.where("__kept"), same).dropDuplicates(["__id", "__sha"]).select(docs.columns)
    return passed.unionByName(first)
