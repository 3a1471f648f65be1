"""Suffix-array dedup: removes every byte covered by a string of ``length`` bytes that
also starts earlier (in a smaller document id, or earlier in the same document).

1. Anchors. Of the 32-grams inside every ``length``-byte window the one with the
   smallest hash (leftmost of equals) is the window's anchor, so equal windows have
   equal anchors at equal places. Consecutive windows with one anchor are a run; its
   context is the text they cover.
2. Anchors are shuffled as numbers (32-gram hash, context hash, extents, place). Equal
   contexts under one hash: all but the first repeat it whole. Each task does this
   for its own rows first, so a text that a third of all rows share costs one row a
   task. Hashes with one context are done here, which is most of them.
3. Hashes with different contexts (where copies begin, end or differ): their distinct
   contexts are fetched and meet in one task. There the suffix array of all contexts
   is built in two stages (``suffix_sort``); neighbours whose common prefix has
   ``length`` bytes are equal windows, and of each such class all but the earliest
   are removed.
4. Removed stretches are gathered by document and joined once.

Cases: null counts as empty and keeps nothing; texts shorter than ``length`` keep all;
rows that repeat an id and its text are one document, each reported alike; texts that
share an id are ordered by their hash; a null id comes after all others (real ids lie below 2^62); other columns
are not read; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streakflow.llm.common import by_bytes, cut, map_arrow, small_side, text_of
from streakflow.llm.suffix_sort import adjacent_agree, suffix_array

_U = np.uint64
_GRAM = 32
_P, _Q = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_FIELDS = "kind int, key long, ctx long, left int, size int, id long, th long, start long"
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]
_SPAN, _ANCHOR, _FETCH = 0, 1, 2
_LAST = (1 << 63) - 1
_NONE = 1 << 62  # ids from here on stand for null (real ids are smaller)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(29))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(32))


class Powers:
    """Powers of _Q and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[_U(1), np.full(n, _U(_Q))])
                self.down = np.cumprod(np.r_[_U(1), np.full(n, _U(pow(_Q, -1, 1 << 64)))])
        return self.up, self.down


def anchor_runs(text: np.ndarray, ends: np.ndarray, length: int, powers: Powers):
    """For documents concatenated in ``text`` (``ends``: where each ends): arrays
    (document, first window, last window, anchor, gram hash, context hash)."""
    n = len(text)
    begins = np.r_[0, ends[:-1]]
    if n < length:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, _U)] * 2
    h, factor, width = text.astype(_U) + _U(1), _P, 1
    while width < _GRAM:  # the hash of 2w bytes from two hashes of w bytes
        h = h[:len(h) - width] * _U(factor) + h[width:]
        factor, width = factor * factor & 0xFFFFFFFFFFFFFFFF, width * 2
    h = _mix(h)
    low = (h & ~_U(0xFFFFFFFF)) | np.arange(len(h), dtype=_U)
    span, width = length - _GRAM + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:len(low) - width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    of = np.repeat(np.arange(len(ends)), ends - begins)[:len(low)]
    valid = np.arange(len(low)) + length <= ends[of]
    window = np.flatnonzero(valid)
    anchor = (low[window] & _U(0xFFFFFFFF)).astype(np.int64)
    doc = of[window]
    if not len(window):
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, _U)] * 2
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]
    first = np.flatnonzero(new)
    p1, p2 = window[first], window[np.r_[first[1:] - 1, len(window) - 1]]
    up, down = powers(n + 1)
    total = np.cumsum(np.r_[_U(0), _mix(text.astype(_U) + _U(77)) * up[:n]], dtype=_U)
    context = (total[p2 + length] - total[p1]) * down[p1]
    return [doc[first], p1, p2, anchor[first], h[anchor[first]], _mix(context)]


def _settle(c: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Anchors in order of key, context and place; which of them stand first in their
    context, and which repeat the first one elsewhere."""
    order = np.lexsort((c["start"], c["th"], c["id"], c["size"], c["left"], c["ctx"], c["key"]))
    c = {k: v[order] for k, v in c.items()}
    changes = [c[k][1:] != c[k][:-1] for k in ("key", "ctx", "left", "size")]
    first = np.r_[True, np.logical_or.reduce(changes)]
    head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    again = ~first & ((c["id"] != c["id"][head]) | (c["th"] != c["th"][head]) | (c["start"] != c["start"][head]))
    return c, first, again


def _batch(kind: int, c: dict[str, np.ndarray], which: np.ndarray) -> pa.RecordBatch:
    n = int(which.sum())
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32))] + [pa.array(c[k][which]) for k in _NAMES[1:]], names=_NAMES)


def _span_keys(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Spans pass through the shuffle by anchor; a key of their own spreads them."""
    return c | {"key": _mix(c["id"].view(_U) ^ c["start"].view(_U)).view(np.int64)}


def _emit_anchors(length: int, most: int = 200_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, count = Powers(), [], 0

        def settle():
            c, first, again = _settle({k: np.concatenate([x[k] for x in held]) for k in held[0]})
            yield _batch(_ANCHOR, c, first)
            yield _batch(_SPAN, _span_keys(c), again)

        for batch in batches:
            for part in by_bytes(batch, 2, 512 << 10):
                bodies = part.column(2).cast(pa.binary()).to_pylist()
                text = np.frombuffer(b"".join(bodies), np.uint8)
                ends = np.cumsum([len(b) for b in bodies])
                doc, p1, p2, anchor, key, ctx = anchor_runs(text, ends, length, powers)
                begin = np.r_[0, ends[:-1]][doc] if len(doc) else doc
                ids, th = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                held.append({"key": key.view(np.int64), "ctx": ctx.view(np.int64), "left": (anchor - p1).astype(np.int32),
                             "size": (p2 + length - p1).astype(np.int32), "id": ids[doc], "th": th[doc], "start": p1 - begin})
                count += len(doc)
                if count >= most:
                    yield from settle()
                    held, count = [], 0
        if count:
            yield from settle()

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans go on; anchors under one key become spans, fetches or nothing."""
    held: dict[str, np.ndarray] | None = None

    def settle(c):
        span = c["kind"] == _SPAN
        if span.any():
            yield _batch(_SPAN, c, span)
        if span.all():
            return
        c, first, again = _settle({k: v[~span] for k, v in c.items()})
        yield _batch(_SPAN, c, again)
        key, firsts = c["key"], first.astype(np.int64)
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        several = np.repeat(np.add.reduceat(firsts, edge), np.diff(np.r_[edge, len(key)])) > 1
        yield _batch(_FETCH, c, first & several)

    for batch in batches:  # sorted by key; cut between keys
        own = {k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(_NAMES)}
        held = own if held is None else {k: np.concatenate([held[k], own[k]]) for k in own}
        if not len(held["key"]) or held["key"][0] == held["key"][-1]:
            continue
        end = int(np.flatnonzero(held["key"] != held["key"][-1])[-1]) + 1
        yield from settle({k: v[:end] for k, v in held.items()})
        held = {k: v[end:] for k, v in held.items()}
    if held is not None and len(held["key"]):
        yield from settle(held)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "left", "id", "th", "start", "body"]
    for batch in batches:
        for part in by_bytes(batch, 2):
            for i, th, body, wants in zip(*(c.to_pylist() for c in [*part.columns[:2], part.column(2).cast(pa.binary()), part.column(3)])):
                yield pa.RecordBatch.from_arrays([
                    pa.array([w["key"] for w in wants], pa.int64()), pa.array([w["left"] for w in wants], pa.int32()),
                    pa.array([i] * len(wants), pa.int64()), pa.array([th] * len(wants), pa.int64()),
                    pa.array([w["start"] for w in wants], pa.int64()),
                    pa.array([body[w["start"]:w["start"] + w["size"]] for w in wants], pa.binary())], names=names)


def equal_windows(contexts: list[bytes], places: list[tuple], length: int) -> list[tuple[int, int, int]]:
    """(context, first, end) stretches of contexts whose every window also starts at an
    earlier place. ``places``: (document order, start) of each context."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    begin = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int32)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    order = suffix_array(text, -(-length // 8) * 8)
    owner = np.repeat(np.arange(len(contexts), dtype=np.int32), sizes)
    inside = order - begin[owner[order]] + length <= sizes[owner[order]]
    order = order[inside]  # suffixes too short for a window may stand between equal ones
    if not len(order):
        return []
    same = adjacent_agree(text, order, length)
    group = np.cumsum(~same, dtype=np.int32)
    rank = {p: r for r, p in enumerate(sorted({p[:-1] for p in places}))}
    doc = np.array([rank[p[:-1]] for p in places], np.int32)[owner[order]]
    at = np.array([p[-1] for p in places], np.int64)[owner[order]] + order - begin[owner[order]]
    line = np.lexsort((at, doc, group))
    group, doc, at, order = group[line], doc[line], at[line], order[line]
    head = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], np.arange(len(group)), 0))
    later = (doc != doc[head]) | (at != at[head])
    hit = np.sort(order[later])
    if not len(hit):
        return []
    jump = np.r_[True, (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])]
    first = np.flatnonzero(jump)
    last = np.r_[first[1:] - 1, len(hit) - 1]
    return [(int(owner[a]), int(a - begin[owner[a]]), int(b - begin[owner[a]]) + length) for a, b in zip(hit[first], hit[last])]


def _compare(length: int, most: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def settle():
            found = equal_windows([h[5] for h in held], [(h[2], h[3], h[4]) for h in held], length)
            return pa.RecordBatch.from_arrays([
                pa.array([held[o][2] for o, _, _ in found], pa.int64()), pa.array([held[o][3] for o, _, _ in found], pa.int64()),
                pa.array([held[o][4] + a for o, a, _ in found], pa.int64()), pa.array([held[o][4] + b for o, _, b in found], pa.int64())],
                names=["id", "th", "start", "end"])

        for batch in batches:  # sorted by key: contexts of one key stay together
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= most and row[0] != held[-1][0]:
                    yield settle()
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield settle()

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in by_bytes(batch, 1):
            kept, spans = [], []
            for body, cuts in zip(part.column(1).cast(pa.binary()).to_pylist(), part.column(2).to_pylist()):
                merged: list[list[int]] = []
                for cut_ in sorted((c["start"], c["end"]) for c in cuts or ()):
                    if merged and cut_[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], cut_[1])
                    else:
                        merged.append(list(cut_))
                at, parts = 0, []
                for a, b in merged:
                    parts.append(body[at:a])
                    at = b
                kept.append(b"".join([*parts, body[at:]]))
                spans.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([len(b) for b in part.column(1).cast(pa.binary()).to_pylist()], pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes, spans (removed stretches, in bytes) and
    kept (binary: the remaining bytes)."""
    text = text_of(text_col)
    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), text.alias("text"))
    # ids that stand for several rows: only there is the text's hash part of the document's
    # name (63 bits, and null ids get 62 more in the place of the id)
    several = small_side(plain.groupBy("id").count().where("count > 1").select(F.col("id").alias("several")))
    named = plain.join(several, plain["id"] == several["several"], "left")
    unnamed = F.col("id") == _LAST
    source = named.select(
        F.when(unnamed, F.lit(_NONE) + F.shiftrightunsigned(F.xxhash64(F.lit("id"), "text"), 2)).otherwise(F.col("id")).alias("id"),
        F.when(F.col("several").isNull(), F.lit(0)).otherwise(F.shiftrightunsigned(F.xxhash64("text"), 1)).alias("th"), "text")
    anchors = map_arrow(source.where(F.octet_length("text") >= length), _emit_anchors(length), _FIELDS)
    found = cut(map_arrow(anchors.repartition("key").sortWithinPartitions("key"), _meet, _FIELDS))
    wants = (found.where(F.col("kind") == _FETCH).groupBy("id", "th")
             .agg(F.collect_list(F.struct("key", "left", "size", "start")).alias("wants")))  # within one document
    # most documents want something as the corpus grows: always joined by shuffle
    wants = cut(wants).hint("merge")
    fetched = source.join(wants, ["id", "th"]).dropDuplicates(["id", "th"]).select("id", "th", "text", "wants")
    contexts = map_arrow(fetched, _fetch, "key long, left int, id long, th long, start long, body binary")
    windows = map_arrow(contexts.repartition("key").sortWithinPartitions("key"), _compare(length), "id long, th long, start long, end long")
    spans = found.where(F.col("kind") == _SPAN).select("id", "th", "start", (F.col("start") + F.col("size")).alias("end"))
    spans = spans.unionByName(windows).groupBy("id", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    # nearly every document has some as the corpus grows: always joined by shuffle
    joined = source.join(cut(spans).hint("merge"), ["id", "th"], "left").select("id", "text", "spans")
    done = map_arrow(joined, _removed, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return done.select(F.when(F.col("id") < _NONE, F.col("id")).alias(id_col), "n_bytes", "spans", "kept")
