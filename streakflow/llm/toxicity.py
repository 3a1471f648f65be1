"""Toxicity: a subword-bag classifier.

A text is the bag of its words (white-space pieces, lower-cased, marks at the ends
taken off, look-alike digits and signs inside read as letters, other signs dropped);
a word counts as often as it occurs, so a share of words does not fall with length.
A word is the mean of the vectors of its character 4- to 6-grams, boundary marks
included, and of the whole word, all hashed into one table. A text is the mean of its
words, and a linear softmax over two classes turns it into a score. Table and softmax
are trained jointly in numpy; every toxic training text also enters once with all its
words misspelt, so that n-grams, not whole words, carry the weight. Only grams whose share of
texts differs between the labels beyond chance (``min_z`` standard errors; down to 3 where a
small sample leaves fewer than ``least_grams``) get a vector,
and every fifth training text stops the rounds before the others are learnt by heart.

Training uses a bounded sample: up to ``rows_per_label`` documents labelled toxic
and twice as many labelled clean, those with the smallest hash of their id, texts over ``max_train_bytes``
excepted. The sample is all that reaches the driver. Scoring reads every whole text
of every row in one narrow pass: since mean and softmax input are linear, a word's
share of the logit is a number, computed once per distinct word.

Cases: null or empty text, or one without words, is scored by the bias alone; labels
that are null are not used; with labels of one class or none, or texts that tell nothing
about them, every score is the share of toxic labels (0.5 without any label); a document
labelled both ways enters twice.
"""
from __future__ import annotations

import math
import re
import uuid
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from streakflow.llm.common import Memo, by_bytes, map_arrow, text_of, texts
from streakflow.llm.word_table import gather, give_back, kept

_LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
#: A mean counts so many zero vectors besides the words, so a few words alone stay near the bias.
PADDING = 10
_SCALE = 100.0  # of the softmax's input: means over hundreds of words are small
_OTHER = re.compile(r"[\W\d_]+")


def clean(piece: str) -> str:
    """A word in its basic shape; empty if it has no letter."""
    if piece.isalpha():
        return piece
    inner = piece.strip("0123456789_.,;:!?\"'()[]{}<>|*&%$#@+-=/\\~^`")
    return _OTHER.sub("", inner.translate(_LOOKALIKE)) if any(map(str.isalpha, inner)) else ""


def grams(word: str, buckets: int, shortest: int = 4, longest: int = 6) -> np.ndarray:
    """Buckets of a word's n-grams and of the word itself (first)."""
    return np.array([c % buckets for c in _checksums(word, shortest, longest)], np.int32)


def _checksums(word: str, shortest: int = 4, longest: int = 6) -> list[int]:
    marked, crc = f"<{word}>", zlib.crc32
    if marked.isascii():  # a slice of the bytes is the bytes of the slice
        raw = marked.encode()
        return [crc(b"=" + raw[1:-1])] + [crc(raw[i:i + n]) for n in range(shortest, longest + 1) for i in range(len(raw) - n + 1)]
    found = [f"={word}"] + [marked[i:i + n] for n in range(shortest, longest + 1) for i in range(len(marked) - n + 1)]
    return [crc(g.encode("utf-8", "surrogatepass")) for g in found]


def misspell(word: str) -> str:
    """The word with one inner letter dropped, doubled, swapped with the next or
    replaced; which, the word's checksum says."""
    if len(word) < 4:
        return word
    draw = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    i = 1 + draw % (len(word) - 2)
    return (word[:i] + word[i + 1:], word[:i] + word[i] + word[i:], word[:i] + word[i + 1] + word[i] + word[i + 2:],
            word[:i] + "aeiou"[draw // 64 % 5] + word[i + 1:])[draw // 16 % 4]


@dataclass
class Model:
    word_score: np.ndarray  # per bucket: the part of logit(toxic) - logit(clean)
    bias: float

    def shares(self, words: list[str]) -> list[float]:
        """What each word adds to the logit before the mean over words is taken."""
        n, table, out = len(self.word_score), self.word_score.tolist(), []
        for w in words:
            found = _checksums(w)
            out.append(sum([table[c % n] for c in found]) / len(found))
        return out


def _bag(counted: Iterator[tuple[str, int]]) -> Counter[str]:
    """Occurrences of every word; pieces without one are left out."""
    bag = Counter()
    for word, k in counted:
        if word:
            bag[word] += k
    return bag


@dataclass
class Examples:
    """Training texts as sparse rows: gram, weight and row of every entry."""
    used: np.ndarray  # buckets by gram number
    index: np.ndarray
    value: np.ndarray
    row: np.ndarray
    label: np.ndarray
    group: np.ndarray  # a text and its misspelt twin share one


def examples(rows: list[tuple[str, int]], buckets: int, min_z: float, least_grams: int = 2000, least_z: float = 3.0) -> Examples:
    # texts are held as word numbers; their grams, many times as many, are made text by text
    number_of, flat, sizes, bags, target, group = {}, array("i"), [], [], [], []
    for number, (text, label) in enumerate(rows):
        own = _bag((clean(p), k) for p, k in Counter(text.lower().split()).items())
        for variant in (own, _bag((misspell(w), k) for w, k in own.items())) if label else (own,):
            words = sorted(variant)
            if not words:
                continue
            for w in words:
                if w not in number_of:
                    number_of[w] = len(sizes)
                    found = grams(w, buckets)
                    flat.frombytes(found.tobytes())
                    sizes.append(len(found))
            bags.append((np.array([number_of[w] for w in words], np.int32), np.array([variant[w] for w in words], np.int32)))
            target.append(label)
            group.append(number)
    del number_of
    flat, sizes = np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32), np.array(sizes, np.int64)
    starts = np.cumsum(sizes) - sizes
    y = np.array(target, np.int64)
    texts_with = np.zeros((2, buckets), np.int32)
    for (words, _), label in zip(bags, target):
        texts_with[label, np.unique(flat[gather(starts[words], sizes[words])])] += 1
    # grams that the labels hold equally often, as far as the sample can tell, have no vector
    n = np.maximum(1, np.bincount(y, minlength=2))[:, None]
    share, whole = texts_with / n, texts_with.sum(axis=0) / n.sum()
    apart, error = np.abs(share[1] - share[0]), np.sqrt(whole * (1 - whole) * (1 / n[0] + 1 / n[1]))
    often = (texts_with.sum(axis=0) >= 5) & (apart > 0)
    used = np.flatnonzero(often & (apart >= min_z * error))
    while len(used) < least_grams and min_z > least_z:  # few texts have large errors
        min_z = max(least_z, min_z - 0.5)
        used = np.flatnonzero(often & (apart >= min_z * error))
    place = np.full(buckets, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    index, value, size = [], [], []
    for words, counts in bags:
        lengths = sizes[words]
        ids = place[flat[gather(starts[words], lengths)]]
        weight = np.repeat(counts / (lengths * (counts.sum() + PADDING)), lengths)[ids >= 0]
        ids = ids[ids >= 0]
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        begins = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else ids
        index.append(ids[begins])
        value.append(np.add.reduceat(weight[order], begins).astype(np.float32) if len(ids) else np.zeros(0, np.float32))
        size.append(len(begins))
    return Examples(used, np.concatenate([np.zeros(0, np.int32), *index]), np.concatenate([np.zeros(0, np.float32), *value]), np.repeat(np.arange(len(size), dtype=np.int32), size), y, np.array(group))


def fit_examples(x: Examples, buckets: int, dim: int = 8, rounds: int = 240, rate: float = 0.05, decay: float = 0.005, damping: float = 1.0,
                 stop_share: float = 0.2, toxic_weight: float = 0.5, seed: int = 7) -> tuple[Model, int]:
    """Fits table and softmax jointly by Adam on the cross-entropy, both labels weighing
    alike. Every fifth text stops the rounds: the model of the round that fits them best
    is kept. A gram's step is damped against the strongest gram's, so that grams with
    little evidence move little (plain Adam moves all alike)."""
    rng = np.random.default_rng(seed)
    back = rng.permutation(x.group.max() + 1)[x.group] < stop_share * (x.group.max() + 1)
    for label in (0, 1):  # a label that lies on one side alone is drawn for itself
        own = x.label == label
        if back[own].all() or not back[own].any():
            texts_of = rng.permutation(np.unique(x.group[own]))
            back[own] = np.isin(x.group[own], texts_of[:math.ceil(stop_share * (len(texts_of) - 1))])
    table = rng.standard_normal((len(x.used), dim)) * 0.01
    head = rng.standard_normal((dim, 2)) * 0.5
    bias = np.zeros(2)
    weigh = lambda which: np.where(x.label == 1, toxic_weight / max(1, (which & (x.label == 1)).sum()), (1 - toxic_weight) / max(1, (which & (x.label == 0)).sum())) * which
    learn, watch = weigh(~back), weigh(back)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (table, head, bias)]
    best = (np.inf, 0, None, None)
    for step in range(1, rounds + 1):
        # mean and head commute, so buckets are scored first; of two classes only the
        # difference of the softmax inputs counts
        odds = _SCALE * np.bincount(x.row, x.value * (table @ (head[:, 1] - head[:, 0]))[x.index], len(x.label)) + bias[1] - bias[0]
        odds = np.clip(odds, -50, 50)
        loss = float((watch * np.logaddexp(0, np.where(x.label == 1, -odds, odds))).sum())
        if loss < best[0]:
            best = (loss, step, _SCALE * (table @ (head[:, 1] - head[:, 0])), float(bias[1] - bias[0]))
        elif step > best[1] + 40:
            break
        slope = (1 / (1 + np.exp(-odds)) - x.label) * learn
        pull = _SCALE * np.bincount(x.index, x.value * slope[x.row], len(x.used))
        pull = np.stack([-pull, pull], 1)
        for k, (param, grad) in enumerate(((table, pull @ head.T), (head, table.T @ pull), (bias, np.array([-1, 1]) * slope.sum()))):
            m, v = state[k]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            size = np.sqrt(v / (1 - 0.99 ** step))
            param -= rate * (m / (1 - 0.9 ** step)) / (size + (damping * size.max() if k == 0 else 0) + 1e-9)
        table *= 1 - decay
    scores = np.zeros(buckets, np.float32)
    scores[x.used] = best[2]
    return Model(scores, best[3]), best[1]


def train(rows: list[tuple[str, int]], buckets: int = 1 << 18, min_z: float = 5.0, seed: int = 7, **how) -> Model:
    rows = [rows[i] for i in np.random.default_rng(seed).permutation(len(rows))]
    n_toxic = sum(y for _, y in rows)
    odds = (n_toxic + 0.5) / (len(rows) - n_toxic + 0.5) if rows else 1.0
    share = Model(np.zeros(1, np.float32), float(np.log(odds)))
    if not rows or n_toxic in (0, len(rows)):
        return share
    found = examples(rows, buckets, min_z)
    if not len(found.used):  # nothing tells the labels apart
        return share
    model, best_round = fit_examples(found, buckets, seed=seed, **how)
    return model if best_round > 1 else share  # the first round's model is the random start


def training_rows(docs: DataFrame, labels: DataFrame, eligible: Column, id_col: str, text_col: str, label_col: str,
                  rows_per_label: int, max_train_bytes: int) -> list[tuple[str, int]]:
    """The bounded sample, on the driver: at most 3 x rows_per_label texts."""
    usable = labels.where(eligible & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).distinct()
    order = [F.xxhash64("__id"), F.col("__id")]
    picked = usable.where("__y = 1").orderBy(*order).limit(rows_per_label).unionAll(
        usable.where("__y = 0").orderBy(*order).limit(2 * rows_per_label))
    text = text_of(text_col)
    small = docs.where(F.octet_length(text) <= max_train_bytes).select(F.col(id_col).alias("__id"), text.alias("__text"))
    found = small.join(F.broadcast(picked), "__id").select("__id", "__y", "__text")
    rows = sorted((r["__id"], r["__y"], r["__text"]) for r in found.toLocalIterator())
    return [(t, y) for _, y, t in rows]


def _mean(bag: Counter[str], pieces: dict[str, float | None]) -> float:
    """The mean of what a text's words add, every occurrence counted."""
    found = [(pieces[p], k) for p, k in bag.items()]
    shares, counts = [x for x, _ in found if x is not None], [k for x, k in found if x is not None]
    return math.sumprod(shares, counts) / (sum(counts) + PADDING)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` plus ``out`` (double, 0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f.name for f in docs.schema]
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    own = uuid.uuid4().hex

    def memo() -> Memo:
        fitted = shared.value
        words = Memo(fitted.shares, 500_000)

        def adds(pieces: list[str]) -> list[float | None]:
            bases = list(map(clean, pieces))
            words.learn({w for w in bases if w})
            return [words[w] if w else None for w in bases]

        return Memo(adds, 500_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, pieces = shared.value, kept(own, memo)  # the memo serves all tasks of a worker
        for batch in batches:
            for part in by_bytes(batch, len(names), 1 << 20):
                bags = [Counter(t.lower().split()) for t in texts(part.column(len(names)))]
                pieces.learn(set().union(*bags))
                logits = np.array([fitted.bias + _mean(bag, pieces) for bag in bags])
                scores = 1.0 / (1.0 + np.exp(-np.clip(logits, -50.0, 50.0)))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(names)], pa.array(scores, pa.float64())],
                                                 names=[*names, out])

    return map_arrow(docs.select(*[F.col(f"`{n}`") for n in names], text_of(text_col).alias("__text")), run, schema, keeps=True)


def held_out(id_col: str = "doc_id") -> Column:
    """Every fifth id by checksum, kept away from training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rows_per_label: int = 1200, max_train_bytes: int = 1 << 15) -> Model:
    model = train(training_rows(docs, labels, ~held_out(id_col), id_col, text_col, label_col, rows_per_label, max_train_bytes))
    give_back()  # the driver goes on without the sample
    return model
