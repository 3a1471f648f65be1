"""Benchmark decontamination by spaced seeds.

Texts are sequences of lower-case words (runs of letters and digits). A mask fixes
some of a few consecutive positions and ignores the others, so a seed still matches
where a word at an ignored position was replaced. An item's masks depend on its length:
whichever words of a window differ, as many as ``share`` admits, one mask fits beside
them, so no leak is missed. The seeds of all test items and of
all documents are joined by hash; a hit gives a document, an item and their alignment.
Along each alignment the words are then compared: the item has leaked if some
``window`` consecutive words of it agree in at least ``share`` percent.

Only DataFrame expressions; no Python runs on executors. Document seeds are exploded
as (id, text hash, position, seed), never with the text. The seeds of the test items are
counted and broadcast below a bound, joined by shuffle beyond it. Word arrays are built
again only for documents that were hit.

Cases: null or empty texts have no seed; an item shorter than ``window`` must agree as a
whole in ``share`` percent; one of fewer than ``least_words`` (five) words says nothing by
occurring somewhere, so it leaks only where it is the whole text; repeated
rows are one (id, text) and give one result per item; equal items each give a row; other
columns are not read; empty tables give an empty result.
"""
from __future__ import annotations

import zlib
from functools import lru_cache, reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, functions as F

from streakflow.llm.common import cut, small_side, text_of

Mask = tuple[int, ...]
#: Sets of masks (positions that count), those with the most words first: for 2 of 12 words that
#: differ, 2 of 10, 1 of 6 and 1 of 5.
MASKS: tuple[tuple[Mask, ...], ...] = (
    ((0, 3, 4, 6, 7, 8), (0, 1, 2, 6, 8, 9), (0, 2, 3, 4, 5, 8)), ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7)),
    ((0, 1, 2, 3), (0, 1, 3, 4)), ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 4), (0, 1, 2, 4)))


def fits(masks: tuple[Mask, ...], size: int, wrong: set[int]) -> bool:
    """Whether a mask lies somewhere in ``size`` words without touching those that differ."""
    return any(wrong.isdisjoint(at + k for k in mask) for mask in masks for at in range(size - mask[-1]))


@lru_cache
def masks_for(size: int, differ: int) -> tuple[Mask, ...]:
    """Masks of which one fits whichever ``differ`` of ``size`` consecutive words differ."""
    if 0 < differ and comb(size, differ) <= 10_000:
        for masks in MASKS:
            if all(fits(masks, size, set(wrong)) for wrong in combinations(range(size), differ)):
                return masks
    return (tuple(range(max(1, size // (differ + 1)))),)  # the longest of differ + 1 parts or more is untouched


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _seeds(table: DataFrame, masks: list[Mask], *keys: str) -> DataFrame:
    """(keys, pos, seed) of every mask at every position of column ``words`` where it lies
    inside. The shifted word hashes are zipped and exploded, so that the seeds are plain
    expressions over one row and stay in generated code."""
    hashed = table.select(*keys, F.transform("words", lambda w: F.xxhash64(w)).alias("h")).where(F.size("h") > 0)
    shifted = F.arrays_zip(*[F.slice("h", k + 1, F.size("h")) for k in range(1 + max(mask[-1] for mask in masks))])
    rows = hashed.select(*keys, F.posexplode(shifted).alias("pos", "at"))
    of_mask = [F.when(F.col("at")[str(mask[-1])].isNotNull(), F.xxhash64(
        F.lit(zlib.crc32(repr(mask).encode())), *[F.col("at")[str(offset)] for offset in mask])) for mask in masks]
    return rows.select(*keys, "pos", F.explode(F.array(*of_mask)).alias("seed")).where("seed is not null")


def _agreement(window: int, share: int) -> tuple[Column, Column, Column]:
    """Of an alignment: agreeing words, the best window's agreeing words, whether it leaks."""
    same = F.transform("item_words", lambda w, j: F.coalesce(
        F.when(F.col("diag") + j >= 0, F.get("words", F.col("diag") + j)) == w, F.lit(False)).cast("int"))
    length = F.least(F.lit(window), F.size("same"))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("same") - length + 1), lambda s: F.aggregate(
        F.slice("same", s, length), F.lit(0), lambda total, x: total + x)))
    return same, best, F.col("best_window") * 100 >= length * share


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text", window: int = 12, share: int = 80, least_words: int = 5) -> DataFrame:
    """One row per document and leaked item: ``id_col``, ``item_id``, n_agree (words that
    agree along the best alignment), n_item_words, best_window, doc_word (where in the
    document's words the item's first word lies or would lie) and text_hash."""
    text = text_of(text_col)
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    tests = cut(items.select(F.col(item_id).alias("item"), words(text_of(item_text)).alias("words"))
                .where(F.size("words") > 0).distinct())
    size = F.least(F.size("words"), F.lit(window))
    sizes = sorted(r.size for r in tests.select(size.alias("size")).distinct().collect()) or [window]  # at most ``window`` numbers
    of_size: dict[tuple[Mask, ...], list[int]] = {}
    for n in sizes:
        of_size.setdefault(masks_for(n, n - -(-n * share // 100)), []).append(n)
    item_seeds = reduce(DataFrame.unionAll, [_seeds(tests.where(size.isin(own)), list(masks), "item") for masks, own in of_size.items()])
    test_seeds = small_side(item_seeds.select("item", F.col("pos").alias("item_pos"), "seed").distinct(), 5_000_000)
    masks = sorted({mask for some in of_size for mask in some})
    doc_seeds = _seeds(source.select("id", "text_hash", words(F.col("text")).alias("words")), masks, "id", "text_hash")
    hits = cut(doc_seeds.join(test_seeds, "seed")
               .select("id", "text_hash", "item", (F.col("pos") - F.col("item_pos")).alias("diag")).distinct())
    hit = small_side(hits.select(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct())
    hit_docs = source.join(hit, source["id"].eqNullSafe(hit["hit_id"]) & (source["text_hash"] == hit["hit_hash"]))
    hit_docs = hit_docs.groupBy("id", "text_hash").agg(F.min("text").alias("text"))  # repeated rows
    pairs = hits.withColumnRenamed("id", "own").withColumnRenamed("text_hash", "own_hash")
    pairs = hit_docs.join(pairs, F.col("id").eqNullSafe(F.col("own")) & (F.col("text_hash") == F.col("own_hash")))
    pairs = pairs.join(tests.withColumnRenamed("words", "item_words"), "item")
    same, best, leaked = _agreement(window, share)
    # written in between: a lambda would otherwise split the text anew for every word
    aligned = cut(pairs.select("id", "text_hash", "item", "diag", "item_words", words(F.col("text")).alias("words")))
    aligned = aligned.where((F.size("item_words") >= least_words) | (F.col("words") == F.col("item_words")))
    compared = cut(aligned.select("id", "text_hash", "item", "diag", same.alias("same")))
    scored = compared.withColumn("best_window", best).where(leaked)
    top = F.struct("best_window", F.aggregate("same", F.lit(0), lambda total, x: total + x).alias("n_agree"),
                   F.size("same").alias("n_item_words"), (-F.col("diag")).alias("back"))
    return scored.groupBy("id", "item", "text_hash").agg(F.max(top).alias("top")).select(
        F.col("id").alias(id_col), F.col("item").alias(item_id), "top.n_agree", "top.n_item_words", "top.best_window",
        (-F.col("top.back")).alias("doc_word"), "text_hash")


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` (all columns) without the rows into which an item has leaked."""
    found = leaks(docs, items, id_col, text_col, **options).select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"))
    found = small_side(found.distinct())
    keyed = docs.withColumn("__own", F.xxhash64(text_of(text_col)))
    return keyed.join(found, keyed[id_col].eqNullSafe(found["__id"]) & (keyed["__own"] == found["__hash"]), "left_anti").drop("__own")
