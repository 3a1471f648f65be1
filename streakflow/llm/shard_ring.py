"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``cells`` equal arcs; a key's hash names its arc, and every shard owns
``vnodes`` points on the ring. A key belongs to the next point clockwise. No shard
takes more than its capacity: keys that reach a full shard go on clockwise to the
next point whose shard has room. With ``epsilon`` 0 the capacities add up to the
number of rows, so all shards fill and row counts differ by one at most; with a
larger ``epsilon`` fewer keys overflow and fewer move when shards are added.

Distribution: Spark counts keys per (arc, salt), a table whose size is fixed by
parameters, never by the data. The driver walks the ring over those counts and
writes, for every (arc, salt), which ranks go to which shard and from which slot on.
Rows get their rank inside (arc, salt) from a window and look the piece up. An arc has
as many salts, drawn from a row number, as its count asks for, so a key that a third
of all rows share is dealt to windows no larger than others.

Cases: a null text has size 1 and the CRC of no bytes; a null id is a key like any
other; repeated rows are separate rows (each has its own slot); other columns are not
read; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

from pyspark.sql import DataFrame, Window, functions as F

from streakflow.llm.common import cut, text_of


def _hash(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("|".join(map(str, parts)).encode(), digest_size=8).digest(), "big")


def ring_points(shards: int, vnodes: int, cells: int) -> list[tuple[int, int]]:
    """(arc, shard) of every virtual node, clockwise."""
    return sorted((_hash("node", s, v) % cells, s) for s in range(shards) for v in range(vnodes))


def capacities(rows: int, shards: int, epsilon: float) -> list[int]:
    if epsilon > 0:
        return [math.ceil((1 + epsilon) * rows / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk_ring(counts: dict[tuple[int, int], int], shards: int, vnodes: int, cells: int,
              epsilon: float) -> list[tuple[int, int, int, int, int, int]]:
    """Pieces (arc, salt, first rank, end rank, shard, first slot) that place every
    counted key. Arcs are served in an order drawn by hash, so that no side of the
    ring is favoured."""
    points = ring_points(shards, vnodes, cells)
    arcs = [a for a, _ in points]
    room = capacities(sum(counts.values()), shards, epsilon)
    load = [0] * shards
    onward = list(range(len(points)))  # the next point that may still have room

    def open_point(i: int) -> int:
        while room[points[i][1]] <= load[points[i][1]]:
            onward[i] = (i + 1) % len(points) if onward[i] == i else onward[onward[i]]
            i = onward[i]
        return i

    pieces = []
    for arc, salt in sorted(counts, key=lambda unit: _hash("unit", *unit)):
        rank, left = 0, counts[arc, salt]
        i = bisect_left(arcs, arc) % len(points)
        while left:
            i = open_point(i)
            shard = points[i][1]
            take = min(left, room[shard] - load[shard])
            pieces.append((arc, salt, rank, rank + take, shard, load[shard]))
            load[shard] += take
            rank, left = rank + take, left - take
    return pieces


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", vnodes: int = 64,
                    cells: int = 1 << 13, per_window: int = 10_000, epsilon: float = 0.0) -> DataFrame:
    """One row per input row: ``id_col``, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    text = text_of(text_col)
    base = cut(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                           F.crc32(text).alias("crc"), F.monotonically_increasing_id().alias("row")))
    keyed = base.withColumn("arc", F.pmod(F.xxhash64("id"), F.lit(cells)).cast("int"))
    arcs = {r.arc: r["count"] for r in keyed.groupBy("arc").count().collect()}  # a row an arc at most
    window = max(per_window, sum(arcs.values()) // cells)  # so there are at most cells salts more than arcs
    salts = spark.createDataFrame([(a, -(-n // window)) for a, n in arcs.items() if n > window], "arc int, salts int")
    # at most ``cells`` rows: a bound set by parameters
    keyed = keyed.join(F.broadcast(salts), "arc", "left").withColumn(
        "salt", F.pmod(F.xxhash64("row"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    counted = keyed.groupBy("arc", "salt").count().collect()  # twice as many rows as arcs at most
    pieces = walk_ring({(r.arc, r.salt): r["count"] for r in counted}, shards, vnodes, cells, epsilon)
    plan = spark.createDataFrame(pieces, "arc int, salt int, first long, until long, shard int, slot0 long")
    order = Window.partitionBy("arc", "salt").orderBy("id", "row")
    ranked = keyed.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    # the plan has two pieces an arc and a few per shard more: a bound set by parameters
    placed = ranked.join(F.broadcast(plan.coalesce(1)), ["arc", "salt"]).where("rank >= first and rank < until")
    return placed.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                         (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot"))
