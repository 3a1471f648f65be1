"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection.

A document's set holds the 64-bit hashes of its distinct word shingles. Two documents
link when 100 * |intersection| >= threshold * |union|; equal sets are one node.

1. First scan: size, fingerprint and bitmap of every set, and a sketch that counts
   shingles by hash cell. Cells far above the mean are *common*.
2. Second scan: all sets are ordered alike, common shingles last, the rest by hash.
   Linked sets share one of their first ``n - ceil(t n) + 1`` shingles (prefix rule),
   so each such shingle is a *tile* of the sets that may meet there. Inside a tile,
   sets are ordered by size and only pairs within the size ratio meet.
3. Bitmaps: a set's bitmap is the parity of its hashes by bit, of 2 to 4 bits a
   shingle; a longer one folds onto a shorter one. As
   |x and y| <= (|x| + |y| - popcount(bx xor by)) / 2, most pairs end here: by a fold
   of 1,024 bits inside the tile, before a pair is written, then by the whole bitmaps.
4. The sorted arrays of the remaining pairs are intersected.
5. Before all pairs of a tile are met, each set's best partners are verified (those
   it stands next to in most tiles) and joined to components. Then only pairs of
   different components meet, so a group of near copies does not cost its square.
   No pair that could add a link between components is left out.

Whole documents are rescanned only where a pair has passed the bitmaps. The sketch's
size is a parameter; its common cells reach the tasks as one bit per cell.

Cases: null text counts as empty; a text with fewer words than a shingle is one
shingle, its whole word sequence; a set without shingles links with nothing; repeated
rows are equal sets; other columns are not read; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from streakflow.llm.common import Memo, by_bytes, cut, map_arrow, small_side, text_of
from streakflow.llm.components import components

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_CHUNK = 1 << 14  # sketch counters a row
_FOLD = 1024  # bits of the bitmap that rows of a tile carry


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Shingler:
    """Texts (as bytes) to sorted arrays of shingle hashes."""

    def __init__(self, width: int):
        import xxhash

        self.width = width
        digest = xxhash.xxh3_64_intdigest
        self.words = Memo(lambda words: [digest(w.lower()) for w in words])

    def __call__(self, some: list[bytes]) -> list[np.ndarray]:
        split = [text.split() for text in some]  # bytes split at ASCII white space only
        self.words.learn(set().union(*split))
        return [self._set(np.fromiter(map(self.words.__getitem__, words), _U, len(words))) for words in split]

    def _set(self, words: np.ndarray) -> np.ndarray:
        width = min(self.width, len(words))
        if not width:
            return words
        hashes = np.full(len(words) - width + 1, width, _U)
        for k in range(width):
            hashes = _mix(hashes * _ODD + words[k:len(words) - width + 1 + k])
        return np.unique(hashes)


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64).tolist())


def bitmap(hashes: np.ndarray) -> bytes:
    bits = max(_FOLD, 1 << (2 * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold(bits: bytes) -> bytes:
    """A bitmap folded to 1,024 bits."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint8).reshape(-1, _FOLD // 8), axis=0).tobytes()


def overlap_bound(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """No fewer than the shingles two sets share."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return (n_a + n_b - int(np.bitwise_count(x ^ y).sum())) // 2


def linked(share: int, n_a: int, n_b: int, threshold: int) -> bool:
    return 100 * share >= threshold * (n_a + n_b - share)


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _scan_sets(width: int, sketch_bits: int):
    shift = _U(64 - sketch_bits)
    names = ["row", "n", "f1", "f2", "bitmap", "fold", "chunk", "cells", "counts", "id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, id_type = Shingler(width), np.zeros(1 << sketch_bits, np.int32), pa.int64()
        for batch in batches:
            id_type = batch.column(2).type
            for part in by_bytes(batch, 1):
                sets = shingler(_bytes(part.column(1)))
                counts += np.bincount((np.concatenate([np.empty(0, _U), *sets]) >> shift).astype(np.int64), minlength=len(counts)).astype(np.int32)
                prints = [fingerprint(s) for s in sets]
                none, bitmaps = pa.nulls(len(sets), pa.binary()), [bitmap(s) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
                    pa.array([p[1] for p in prints], pa.int64()), pa.array(bitmaps, pa.binary()),
                    pa.array(map(fold, bitmaps), pa.binary()), pa.nulls(len(sets), pa.int32()), none, none, part.column(2)], names=names)
        for chunk in np.unique(np.flatnonzero(counts) // _CHUNK):
            own = counts[chunk * _CHUNK:(chunk + 1) * _CHUNK]
            cells = np.flatnonzero(own)
            own = own.astype(np.min_scalar_type(int(own.max())))
            dense = 2 * len(cells) + len(cells) * own.itemsize > len(own) * own.itemsize
            cells, own = (cells[:0], own) if dense else (cells, own[cells])
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([
                none, none, none, none, pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([chunk], pa.int32()),
                pa.array([cells.astype(np.uint16).tobytes()], pa.binary()), pa.array([bytes([own.itemsize]) + own.tobytes()], pa.binary()),
                pa.nulls(1, id_type)], names=names)

    return run


def _sum_chunks(common_above: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, cells, counts in zip(*(c.to_pylist() for c in batch.columns)):
                own = total.setdefault(chunk, np.zeros(_CHUNK, np.int64))
                counts = np.frombuffer(counts[1:], f"u{counts[0]}")
                if cells:
                    own[np.frombuffer(cells, np.uint16)] += counts.astype(np.int64)
                else:  # all cells of the chunk
                    own[:len(counts)] += counts.astype(np.int64)
        for chunk, own in sorted(total.items()):
            common = np.flatnonzero(own > common_above)
            if len(common):
                yield pa.RecordBatch.from_arrays([pa.array(common + chunk * _CHUNK, pa.int64())], names=["cell"])

    return run


def _prefix_rows(width: int, threshold: int, sketch_bits: int, common):
    shift = _U(64 - sketch_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(width), set()
        bits = np.unpackbits(np.frombuffer(common.value, np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            for part in by_bytes(batch, 0):
                keys, first, second, sizes, lengths = [], [], [], [], []
                for own in shingler(_bytes(part.column(0))):
                    n, mark = len(own), fingerprint(own)
                    if not n or mark in seen:  # equal sets meet once a task
                        continue
                    seen.add(mark)
                    take = n - -(-threshold * n // 100) + 1
                    last = bits[(own >> shift).astype(np.int64)]
                    keys.append(np.concatenate([own[~last], own[last]])[:take])
                    first.append(mark[0])
                    second.append(mark[1])
                    sizes.append(n)
                    lengths.append(take)
                if keys:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(first, lengths), pa.int64()),
                        pa.array(np.repeat(second, lengths), pa.int64()), pa.array(np.repeat(sizes, lengths), pa.int64())],
                        names=["key", "f1", "f2", "n"])

    return run


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of a stream sorted by the first one, cut only between its values."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = own if held is None else [np.concatenate(x) for x in zip(held, own)]
        if not len(held[0]) or held[0][0] == held[0][-1]:
            continue
        end = np.flatnonzero(held[0] != held[0][-1])[-1] + 1
        yield [c[:end] for c in held]
        held = [c[end:] for c in held]
    if held is not None and len(held[0]):
        yield held


def _meet_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tiles with at least two sets, each with the set after it in an order
    drawn anew for every tile (null at the end)."""
    for key, f1, f2, n in _whole_groups(batches):
        order = np.lexsort((f2, f1, _mix(f1.view(_U) ^ (key.view(_U) * _ODD)), key))
        key, f1, f2, n = key[order], f1[order], f2[order], n[order]
        fresh = np.r_[True, (key[1:] != key[:-1]) | (f1[1:] != f1[:-1]) | (f2[1:] != f2[:-1])]
        key, f1, f2, n = key[fresh], f1[fresh], f2[fresh], n[fresh]
        same = np.r_[key[1:] == key[:-1], False]
        alive = same | np.r_[False, same[:-1]]
        after = [pa.array(np.roll(c, -1)[alive], mask=~same[alive]) for c in (f1, f2, n)]
        yield pa.RecordBatch.from_arrays([pa.array(c[alive]) for c in (key, f1, f2, n)] + after,
                                         names=["key", "f1", "f2", "n", "g1", "g2", "m"])


def cross_pairs(key: np.ndarray, n: np.ndarray, root: np.ndarray, bits: np.ndarray, threshold: int, block: int = 1 << 18):
    """Positions (i, j) of rows of one tile that have different roots, sizes within the
    ratio and folded bitmaps (``bits``: rows of 64-bit words) that allow a link, in
    blocks. Rows ascend by key and size. Rows of a tile's most frequent root do not
    meet each other, so only the others are walked."""
    if not len(key):
        return
    tile = np.cumsum(np.r_[0, (key[1:] != key[:-1]).astype(np.int64)])
    order = np.lexsort((root, tile))
    starts = np.flatnonzero(np.r_[True, (tile[order][1:] != tile[order][:-1]) | (root[order][1:] != root[order][:-1])])
    sizes = np.diff(np.r_[starts, len(key)])
    best = np.lexsort((sizes, tile[order][starts]))
    best = best[np.r_[tile[order][starts][best][1:] != tile[order][starts][best][:-1], True]]
    walked = root != root[order][starts][best][tile]
    scale = 200 * (int(n.max()) + 1)
    low = np.searchsorted(tile * scale + 100 * n, tile * scale + threshold * n, "left")
    high = np.searchsorted(tile * scale + threshold * n, tile * scale + 100 * n, "right")
    walk = np.flatnonzero(walked)
    spans = (high - low)[walk]
    done = np.cumsum(spans)
    start = 0
    while start < len(walk):
        before = done[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(done, before + block, "right")))
        own, some = spans[start:stop], walk[start:stop]
        i = np.repeat(some, own)
        j = np.repeat(low[some], own) + np.arange(len(i)) - np.repeat(np.cumsum(own) - own, own)
        meet = (root[i] != root[j]) & ((i < j) | ~walked[j])
        i, j = i[meet], j[meet]
        total = n[i] + n[j]
        share = (total - np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)) // 2
        meet = 100 * share >= threshold * (total - share)
        yield i[meet], j[meet]
        start = stop


def _meet_all(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, f1, f2, n, root, folded in _whole_groups(batches):
            order = np.lexsort((n, key))
            key, f1, f2, n, root = key[order], f1[order], f2[order], n[order], root[order]
            bits = np.frombuffer(b"".join(folded[order].tolist()), _U).reshape(len(key), -1)
            for i, j in cross_pairs(key, n, root, bits, threshold):
                swap = (f1[i] > f1[j]) | ((f1[i] == f1[j]) & (f2[i] > f2[j]))
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                pairs = np.unique(np.stack([f1[i], f2[i], f1[j], f2[j]], 1), axis=0)
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, c])) for c in range(4)], names=_PAIR)

    return run


def _pass_bitmaps(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, x, y = (batch.column(c).to_pylist() for c in range(4, 8))
            good = [100 * min(p, q) >= threshold * max(p, q) and linked(overlap_bound(u, v, p, q), p, q, threshold)
                    for p, q, u, v in zip(n_a, n_b, x, y)]
            yield batch.select(_PAIR).filter(pa.array(good, pa.bool_()))

    return run


def _intersect(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                p, q = np.frombuffer(x, _U), np.frombuffer(y, _U)
                good.append(linked(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q), threshold))
            yield batch.select(_PAIR).filter(pa.array(good, pa.bool_()))

    return run


def _set_arrays(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for part in by_bytes(batch, 0):
                sets = shingler(_bytes(part.column(0)))
                prints = [fingerprint(s) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["f1", "f2", "hashes"])

    return run


_PAIR = ["a1", "a2", "b1", "b2"]
_PAIRS = "a1 long, a2 long, b1 long, b2 long"


def _both_sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` with ``columns`` of ``table`` (keyed by f1, f2) for either side."""
    for side in "ab":
        own = table.select(F.col("f1").alias(f"{side}1"), F.col("f2").alias(f"{side}2"),
                           *[F.col(c).alias(f"{side}_{c}") for c in columns])
        pairs = pairs.join(own, [f"{side}1", f"{side}2"])
    return pairs.select(*_PAIR, *[f"{side}_{c}" for c in columns for side in "ab"])


def _verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int,
            threshold: int) -> DataFrame:
    """(a, b) node numbers of the pairs that link."""
    near = cut(map_arrow(_both_sides(pairs, nodes, "n", "bitmap"), _pass_bitmaps(threshold), _PAIRS))
    prints = near.select(F.col("a1").alias("f1"), F.col("a2").alias("f2")).unionByName(
        near.select(F.col("b1").alias("f1"), F.col("b2").alias("f2"))).distinct()
    wanted = small_side(prints.join(nodes, ["f1", "f2"]).select("id").distinct())
    some = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__text"))
    some = some.join(wanted, some["__id"].eqNullSafe(wanted["id"])).select("__text")
    # a repeated id may bring other texts along: sets are joined by what they are
    sets = cut(map_arrow(some, _set_arrays(width), "f1 long, f2 long, hashes binary").dropDuplicates(["f1", "f2"]))
    links = map_arrow(_both_sides(near, sets, "hashes"), _intersect(threshold), _PAIRS)
    return cut(_both_sides(links, nodes, "node").select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, threshold: int = 85,
                       sketch_bits: int = 21, partners: int = 16) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id (the smallest id that
    links reach, its own included).

    ``sketch_bits`` should grow with the logarithm of the corpus (21 suits some 10^7
    documents); it and ``partners`` change the work, never the result."""
    text = text_of(text_col).alias("__text")
    id_type = dict(docs.select(F.col(id_col).alias("id")).dtypes)["id"]
    scan = cut(map_arrow(docs.select(F.monotonically_increasing_id().alias("row"), text, F.col(id_col).alias("id")),
                         _scan_sets(width, sketch_bits), "row long, n long, f1 long, f2 long, bitmap binary, fold binary, chunk int, "
                         f"cells binary, counts binary, id {id_type}"))
    base = scan.where("chunk is null").select("row", "id", "n", "f1", "f2", "bitmap", "fold")
    total = base.agg(F.sum("n")).first()[0] or 0
    chunks = scan.where("chunk is not null").select("chunk", "cells", "counts").repartition("chunk")
    mean = total / (1 << sketch_bits)
    above = mean + 8 * mean ** 0.5 + 24  # far outside what chance puts into a cell
    cells = map_arrow(chunks, _sum_chunks(above), "cell long").collect()  # at most 2^sketch_bits numbers
    bits = np.zeros(1 << sketch_bits, np.uint8)
    bits[[r.cell for r in cells]] = 1
    common = docs.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())

    first = base.where("n > 0").groupBy("f1", "f2").agg(F.min("row").alias("row"))
    nodes = cut(base.join(first, ["f1", "f2", "row"]).withColumnRenamed("row", "node"))
    prefix = map_arrow(docs.select(text), _prefix_rows(width, threshold, sketch_bits, common), "key long, f1 long, f2 long, n long")
    tiles = cut(map_arrow(prefix.repartition("key").sortWithinPartitions("key"), _meet_neighbours,
                          "key long, f1 long, f2 long, n long, g1 long, g2 long, m long"))

    ahead = F.struct("f1", "f2") < F.struct("g1", "g2")
    met = tiles.where(F.col("g1").isNotNull() & (100 * F.least("n", "m") >= threshold * F.greatest("n", "m"))).select(
        *[F.when(ahead, F.col(x)).otherwise(F.col(y)).alias(name)
          for name, x, y in (("a1", "f1", "g1"), ("a2", "f2", "g2"), ("b1", "g1", "f1"), ("b2", "g2", "f2"))])
    met = met.groupBy(*_PAIR).agg(F.count(F.lit(1)).alias("tiles_shared"))
    # a set stands in at most prefix-many tiles, so these windows are no larger than a document
    place = [F.row_number().over(Window.partitionBy(f"{s}1", f"{s}2").orderBy(F.desc("tiles_shared"), *_PAIR)) for s in "ab"]
    best = met.withColumn("p", place[0]).withColumn("q", place[1]).where(F.least("p", "q") <= partners).select(*_PAIR)
    early = _verify(best, nodes, docs, id_col, text_col, width, threshold)

    grouped = nodes.select("f1", "f2", "node", "fold").join(components(early), "node", "left").select(
        "f1", "f2", F.coalesce("root", "node").alias("root"), "fold")
    meeting = tiles.select("key", "f1", "f2", "n").join(grouped, ["f1", "f2"]).select("key", "f1", "f2", "n", "root", "fold")
    pairs = map_arrow(meeting.repartition("key").sortWithinPartitions("key"), _meet_all(threshold), _PAIRS).distinct()
    late = _verify(pairs, nodes, docs, id_col, text_col, width, threshold)

    roots = components(early.unionByName(late))
    placed = base.drop("bitmap", "fold").join(nodes.select("f1", "f2", "node"), ["f1", "f2"], "left").join(roots, "node", "left")
    placed = cut(placed.select("id", "n", F.when(F.col("n") > 0, F.coalesce("root", "node")).alias("root")))
    lowest = placed.where("root is not null").groupBy("root").agg(F.min("id").alias("low"))
    return placed.join(lowest, "root", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("low", "id").alias("component_id"))
