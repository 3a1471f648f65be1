"""Levelled compaction of a table that gets one folder per micro-batch.

Batch N is the folder ``batch_id=N``. When all batches of an aligned block of ``fan``
(then ``fan`` squared, and so on) are past, the block's folders are merged into one,
``batches=LO-HI``. So a reader opens at most ``fan - 1`` folders a level: their number
grows with the logarithm of the batches, and every row is rewritten once a level.

A folder counts once Spark's ``_SUCCESS`` marker is in it, which is the commit. A merged
folder hides the folders inside its range. Those are deleted when a later batch
compacts, so a reader that has just listed them can finish. A crash at any step leaves
either the old folders or the merged one in force, and the next batch goes on from there.
One writer at a time, as ``foreachBatch`` has it.
"""
from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streakflow.sources import sinks

Span = tuple[int, int]
_FOLDER = re.compile(r"batch_id=(\d+)|batches=(\d+)-(\d+)")


def committed(spark: SparkSession, path: str) -> dict[Span, str]:
    """Folder of every committed range of batches (covered ones included)."""
    found = {}
    for name in sinks.folder_names(spark, path):
        m = _FOLDER.fullmatch(name)
        if m and sinks.path_exists(spark, f"{path}/{name}/_SUCCESS"):
            low = int(m[1] or m[2])
            found[(low, int(m[3] or low))] = f"{path}/{name}"
    return found


def live(spans: dict[Span, str]) -> list[Span]:
    """The ranges that no other one covers, in order (ranges are nested or apart)."""
    out: list[Span] = []
    for low, high in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not out or high > out[-1][1]:
            out.append((low, high))
    return out


def due(spans: list[Span], past: int, fan: int) -> list[Span]:
    """Aligned blocks whose batches are all past (up to ``past``), of the narrowest
    width that has any: wider ones wait for their inner blocks."""
    blocks = set()
    for low, high in spans:
        width = fan
        while width <= high - low + 1:
            width *= fan
        low -= low % width
        if low + width - 1 <= past:
            blocks.add((low, low + width - 1))
    narrowest = min((high - low for low, high in blocks), default=0)
    return sorted(b for b in blocks if b[1] - b[0] == narrowest)


def compact(spark: SparkSession, path: str, past: int, merge: Callable[[DataFrame], DataFrame], fan: int = 8) -> None:
    """Merges every block that is due; ``merge`` turns the rows of some batches into
    rows of the same columns that stand for them."""
    spans = committed(spark, path)
    kept = set(live(spans))
    for span in spans.keys() - kept:
        sinks.delete(spark, spans[span])
    spans = {s: spans[s] for s in kept}
    while blocks := due(live(spans), past, fan):
        for low, high in blocks:
            inside = [spans[s] for s in live(spans) if low <= s[0] and s[1] <= high]
            folder = f"{path}/batches={low}-{high}"
            merge(spark.read.parquet(*inside)).write.mode("overwrite").parquet(folder)
            spans[(low, high)] = folder


def read(spark: SparkSession, path: str) -> DataFrame:
    spans = committed(spark, path)
    return spark.read.parquet(*[spans[s] for s in live(spans)] or [path])
