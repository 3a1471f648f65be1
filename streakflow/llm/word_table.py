"""A worker's table of distinct words and what a tokenizer makes of each.

Texts are cut into words by Arrow, words become row numbers of the table, and token
arrays are gathered by row number. The table outlives a task (Spark reuses Python
workers) and is emptied at a limit, which costs recomputation and changes nothing."""
from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of several stretches, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class WordTable:
    """``learn(words)`` returns the words in any order, the number of items of each, and
    a dictionary of flat item arrays (all cut by the same sizes)."""

    def __init__(self, learn: Callable[[list[str]], tuple[list[str], np.ndarray, dict[str, np.ndarray]]], limit: int = 800_000):
        self.learn, self.limit, self.before_clear = learn, limit, None
        self.generation = 0
        self._clear()

    def _clear(self) -> None:
        self.generation += 1
        self.rows: dict[str, int] = {}
        self.sizes = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.items: dict[str, np.ndarray] = {}

    def __call__(self, words: pa.Array) -> np.ndarray:
        """The row number of every word."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # faster than by scalars
        rows = np.fromiter(map(self.rows.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(rows < 0)
        if self.rows and len(self.rows) + len(missing) > self.limit:
            if self.before_clear:  # what a task has noted by row number
                self.before_clear()
            self._clear()
            missing = np.arange(len(distinct))
        if len(missing):
            new = distinct if len(missing) == len(distinct) else [distinct[k] for k in missing.tolist()]
            ordered, sizes, items = self.learn(list(new))  # which may sort its list
            first, at = len(self.sizes), int(self.sizes.sum())
            self.rows.update(zip(ordered, range(first, first + len(ordered))))
            self.sizes = np.concatenate([self.sizes, sizes])
            self.starts = np.concatenate([self.starts, at + np.cumsum(sizes) - sizes])
            self.items = {k: np.concatenate([self.items[k], v]) if k in self.items else v for k, v in items.items()}
            rows[missing] = np.fromiter(map(self.rows.__getitem__, new), np.int64, len(new))
        return rows[coded.indices.to_numpy(zero_copy_only=False)]

    def expand(self, rows: np.ndarray, name: str) -> np.ndarray:
        return self.items[name][gather(self.starts[rows], self.sizes[rows])]


_KEPT: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """One object a worker process, made when a task first asks for it."""
    if key not in _KEPT:
        release()  # tables of an earlier query need not stay beside a new one's
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Drops what ``kept`` holds: a worker outlives the query whose tables these are."""
    if _KEPT:
        _KEPT.clear()
        give_back()


def give_back() -> None:
    """Memory that is free again goes back to the system, where that can be asked for."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
