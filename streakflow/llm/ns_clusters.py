"""Centroid clustering (Lloyd's rounds) with ns-bounds.

Every vector keeps an upper bound for the distance to its own centroid and a lower
bound for each other one, each with the round of its last exact evaluation. All
centroids of all rounds are kept. A bound of round T is loosened in round t by the
norm of the centroid's total displacement between T and t (not by the sum of the
moves in between, which is never smaller). Only centroids whose bounds fail are
measured again, exactly: components are integers, so squared distances are too, and
ties go to the smaller centroid number.

Distribution: a round is one narrow pass over the written state (vector, cluster,
bounds). A task adds up what its moved vectors change in the centroids' sums, Spark
adds those up by (cluster, dimension), and the driver gets clusters x dimensions
numbers. Nothing is shuffled by vector, so a cluster with most vectors is no hot key.
A round's state is dropped when the next one is written; a lost executor costs the
reread of one file.

Cases: vectors of another length, or with null or non-finite components, and null
vectors are left out (a component counts as infinite if ``scale`` times it is); a null id is hashed as no digits and stays; rows that repeat an
id are separate vectors; with fewer vectors than clusters each starts one; empty
clusters keep their centroid; an empty table gives an empty result; a sum that no long
holds is null (components beyond 2^21 are computed with Python's integers); other
columns are not read.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from streakflow.llm.common import cut, discard, map_arrow

_EXACT = float(1 << 21)  # up to here all sums of 64-dimensional products are exact doubles
_LONG = (1 << 63) - 1
_STATE = "id {id}, v binary, cluster int, upper double, upper_at int, lower binary, lower_at binary, distance long, move string"
_NAMES = ["id", "v", "cluster", "upper", "upper_at", "lower", "lower_at", "distance", "move"]


def integers(values: np.ndarray) -> np.ndarray:
    """Integral doubles as int64, or as Python integers where those are too small."""
    if not values.size or np.abs(values).max() <= _EXACT:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def pack(values: np.ndarray) -> bytes:
    """A vector of integral doubles: its item size, then its items (int16 if they fit)."""
    small = np.abs(values).max(initial=0) < 1 << 15
    return (b"2" + values.astype("<i2").tobytes()) if small else (b"8" + values.astype("<f8").tobytes())


def unpack(packed: list[bytes], dims: int) -> np.ndarray:
    if all(p[:1] == b"2" for p in packed):
        joined = np.frombuffer(b"".join(p[1:] for p in packed), "<i2")
        return joined.reshape(len(packed), dims).astype(np.float64)
    return np.array([np.frombuffer(p, "<i2" if p[:1] == b"2" else "<f8", offset=1) for p in packed], np.float64).reshape(len(packed), dims)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of row i to row i (both integral; int64 or object)."""
    gap = vectors - centroids
    return (gap * gap).sum(axis=1)


def doubles(values: np.ndarray) -> np.ndarray:
    """As doubles; Python integers that no double holds become infinite."""
    if values.dtype != object:
        return values.astype(np.float64)
    return np.array([float(x) if abs(x) < 10 ** 308 else math.inf if x > 0 else -math.inf for x in values.ravel()], np.float64).reshape(values.shape)


def upper_bound(d: np.ndarray) -> np.ndarray:
    """No less than the square roots of exact squared distances."""
    return np.sqrt(doubles(d)) * (1 + 1e-9)


def lower_bound(d: np.ndarray) -> np.ndarray:
    """No more than the square roots, in four bytes."""
    return np.nextafter((np.minimum(np.sqrt(doubles(d)), 3e38) * (1 - 1e-6)).astype(np.float32), np.float32(0))


class History:
    """The centroids of all rounds so far, and how far each has moved since each."""

    def __init__(self, rounds: list[list[list[int]]]):
        self.small = all(abs(x) <= _EXACT for c in rounds for v in c for x in v)
        self.all = np.array(rounds, np.int64 if self.small else object)
        self.now = self.all[-1]
        gaps = doubles(self.all - self.now[None])
        with np.errstate(over="ignore"):
            self.moved = np.sqrt((gaps * gaps).sum(axis=2)) * (1 + 1e-9)  # [round, centroid]


def measure(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all vectors to all centroids."""
    if vectors.dtype == np.int64 and centroids.dtype == np.int64:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None]).astype(np.int64)
    return np.array([squared(vectors.astype(object), np.broadcast_to(c, vectors.shape)) for c in centroids.astype(object)], object).T


def nearest(who: np.ndarray, what: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Positions of the smallest (what, which) of every ``who``, by ascending ``who``."""
    if what.dtype == object:
        order = np.array(sorted(range(len(who)), key=lambda x: (who[x], what[x], which[x])), np.int64)
    else:
        order = np.lexsort((which, what, who))
    return order[np.r_[True, who[order][1:] != who[order][:-1]]]


def first_state(vectors: np.ndarray, history: History) -> dict[str, np.ndarray]:
    """Every vector against every centroid of round 0."""
    d = measure(vectors, history.now)
    n, k = d.shape
    rows = np.arange(n)
    own = nearest(np.repeat(rows, k), d.ravel(), np.tile(np.arange(k), n)) % k
    return {"cluster": own, "upper": upper_bound(d[rows, own]), "upper_at": np.zeros(n, np.int64),
            "lower": lower_bound(d), "lower_at": np.zeros(d.shape, np.uint8)}


def next_state(vectors: np.ndarray, s: dict[str, np.ndarray], history: History) -> dict[str, np.ndarray]:
    """The nearest centroids of the newest round, by bounds first and exactly where they fail."""
    t, k = len(history.all) - 1, len(history.now)
    s = {name: values.copy() for name, values in s.items()}
    own, rows = s["cluster"], np.arange(len(vectors))
    upper = s["upper"] + history.moved[s["upper_at"], own]
    lower = s["lower"].astype(np.float64) - history.moved[s["lower_at"], np.arange(k)[None]]
    lower[rows, own] = np.inf
    open_ = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
    if not len(open_):
        return s
    exact = squared(vectors[open_], history.now[own[open_]])
    s["upper"][open_], s["upper_at"][open_] = upper_bound(exact), t
    i, j = np.nonzero(lower[open_] <= s["upper"][open_][:, None])
    there = squared(vectors[open_[i]], history.now[j])
    s["lower"][open_[i], j], s["lower_at"][open_[i], j] = lower_bound(there), t
    who, what, which = np.r_[np.arange(len(open_)), i], np.concatenate([exact, there]), np.r_[own[open_], j]
    best = nearest(who, what, which)
    changed = which[best] != own[open_]
    at = open_[changed]
    s["lower"][at, own[at]], s["lower_at"][at, own[at]] = lower_bound(exact[changed]), t
    own[at], s["upper"][at] = which[best][changed], upper_bound(what[best][changed])
    return s


def _moves(vectors: np.ndarray, before: np.ndarray, after: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """What moved vectors change: (centroid, [count, sum of each component])."""
    for side, sign in ((before, -1), (after, 1)):
        moved = (before != after) & (side >= 0)
        for c in np.unique(side[moved]):
            own = vectors[moved & (side == c)]
            yield int(c), [sign * int(x) for x in [len(own), *own.sum(axis=0).tolist()]]


def _add(total: dict[int, list[int]], cluster: int, sums: list[int]) -> None:
    total[cluster] = [a + b for a, b in zip(total[cluster], sums)] if cluster in total else sums


def _sum_rows(total: dict[int, list[int]], id_type: pa.DataType) -> pa.RecordBatch:
    n = len(total)
    empty = {"id": pa.nulls(n, id_type), "v": pa.nulls(n, pa.binary()), "upper": pa.nulls(n, pa.float64()), "upper_at": pa.nulls(n, pa.int32()),
             "lower": pa.nulls(n, pa.binary()), "lower_at": pa.nulls(n, pa.binary()), "distance": pa.nulls(n, pa.int64()),
             "cluster": pa.array(list(total), pa.int32()), "move": pa.array([" ".join(map(str, x)) for x in total.values()], pa.string())}
    return pa.RecordBatch.from_arrays([empty[c] for c in _NAMES], names=_NAMES)


def _pass(dims: int, rounds, final: bool):
    """One round over the state; over bare vectors the first one. The last round alone
    measures every vector against its centroid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        history, total, id_type = History(rounds.value), {}, pa.null()
        k = len(history.now)
        for batch in batches:
            id_type = batch.column(0).type
            batch = batch.filter(batch.column(1).is_valid())  # without the rows that carry sums
            for start in range(0, batch.num_rows, 8192):
                part = batch.slice(start, 8192)
                vectors = integers(unpack(part.column(1).to_pylist(), dims))
                if not history.small:
                    vectors = vectors.astype(object)
                if part.num_columns == 2:
                    before, s = np.full(len(vectors), -1), first_state(vectors, history)
                else:
                    own = {c: part.column(_NAMES.index(c)) for c in ("cluster", "upper", "upper_at", "lower", "lower_at")}
                    s = {c: own[c].to_numpy(zero_copy_only=False) for c in ("cluster", "upper", "upper_at")}
                    s |= {c: np.frombuffer(b"".join(own[c].to_pylist()), kind).reshape(-1, k) for c, kind in (("lower", np.float32), ("lower_at", np.uint8))}
                    s["cluster"] = before = s["cluster"].astype(np.int64)
                    s = next_state(vectors, s, history)
                for c, sums in _moves(vectors, before, s["cluster"]):
                    _add(total, c, sums)
                exact = squared(vectors, history.now[s["cluster"]]).tolist() if final else [None] * len(vectors)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(s["cluster"].astype(np.int32)), pa.array(s["upper"]),
                    pa.array(s["upper_at"].astype(np.int32)), pa.array([r.tobytes() for r in s["lower"]], pa.binary()),
                    pa.array([r.tobytes() for r in s["lower_at"]], pa.binary()),
                    pa.array([d if d is not None and d <= _LONG else None for d in exact], pa.int64()), pa.nulls(len(vectors), pa.string())], names=_NAMES)
        if total:
            yield _sum_rows(total, id_type)

    return run


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each cluster, in whole numbers of any size."""
    total: dict[int, list[int]] = {}
    for batch in batches:
        for c, move in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            _add(total, c, list(map(int, move.split())))
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([" ".join(map(str, x)) for x in total.values()], pa.string())],
                                     names=["cluster", "move"])


def _seeds(vectors: DataFrame, clusters: int, seed: str, dims: int) -> list[list[int]]:
    """The vectors with the smallest hashes: a bounded top-k (``clusters`` rows a task)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("hash"), "v").orderBy("hash", "v").limit(clusters).collect()
    return [[int(x) for x in integers(unpack([bytes(r.v)], dims))[0]] for r in rows]


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(1)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        rows = flat.reshape(batch.num_rows, -1) if batch.num_rows else []
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack(r) for r in rows], pa.binary())], names=["id", "v"])


def cluster_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, clusters: int = 40,
                    rounds: int = 5, scale: float = 256.0, seed: str = "2") -> tuple[DataFrame, list[list[int]]]:
    """(one row per kept vector: id, cluster, distance; the final centroids)."""
    spark = table.sparkSession
    scaled = F.transform(F.col(vec_col).cast("array<double>"), lambda x: _floor(x, scale))
    fits = (F.size(vec_col) == dims) & F.forall(F.col(vec_col).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * F.lit(scale)) < F.lit(float("inf"))))
    id_type = table.schema[id_col].dataType.simpleString()
    kept = table.where(F.col(vec_col).isNotNull()).where(fits).select(F.col(id_col).alias("id"), scaled.alias("v"))
    vectors = cut(map_arrow(kept, _pack_rows, f"id {id_type}, v binary"))
    history = [_seeds(vectors, clusters, seed, dims)]
    if not history[0]:
        return spark.createDataFrame([], f"id {id_type}, cluster int, distance long"), []
    state = vectors
    sums = {c: [0] * (dims + 1) for c in range(len(history[0]))}
    for t in range(rounds + 1):
        shared = spark.sparkContext.broadcast(history)
        after = cut(map_arrow(state, _pass(dims, shared, t == rounds), _STATE.format(id=id_type)))
        discard(state)
        state = after
        if t < rounds:
            moves = after.where("move is not null").select("cluster", "move").repartition("cluster")
            for r in map_arrow(moves, _total, "cluster int, move string").collect():  # a row a cluster
                _add(sums, r.cluster, list(map(int, r.move.split())))
            history = [*history, [[x // sums[c][0] for x in sums[c][1:]] if sums[c][0] else old for c, old in enumerate(history[-1])]]
    return state.where("v is not null").select("id", "cluster", "distance"), history[-1]


def _floor(x, scale: float):
    """floor(scale * x) as a double; values beyond 2^52 are whole already."""
    y = x * F.lit(scale)
    return F.when(F.abs(y) < F.lit(float(1 << 52)), F.floor(y).cast("double")).otherwise(y)


def clustered(table: DataFrame, id_col: str = "vec_id", **how) -> DataFrame:
    """One row per kept vector: ``id_col``, cluster, distance, cluster_inertia, inertia,
    centroid_sha256."""
    spark = table.sparkSession
    placed, centroids = cluster_vectors(table, id_col, **how)
    total = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    sums = {r.cluster: int(r.s) if r.s is not None else None for r in total.collect()}  # one row a cluster
    whole = sum(s for s in sums.values() if s is not None)
    fit = lambda s: s if s is not None and s <= _LONG else None
    rows = [(c, fit(sums.get(c)), fit(whole), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
            for c, v in enumerate(centroids) if c in sums]
    schema = T.StructType.fromDDL("cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row a cluster: the broadcast's size is set by a parameter
    return placed.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
