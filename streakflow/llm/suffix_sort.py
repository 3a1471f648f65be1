"""Two-stage suffix sorting in numpy, to a limited depth.

A suffix is of type B when it is smaller than the suffix that starts one position
later, else of type A. Only type-B suffixes are sorted directly (by eight bytes at a
time, ties alone going on to the next eight). The others are induced: scanning the
buckets of first bytes upwards, the position before every suffix met is of type A or
not, and if it is, it goes next into its own byte's bucket. Buckets are scanned with
array operations; a bucket is gone over again for runs of its own byte."""
from __future__ import annotations

import numpy as np


def type_b(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors (the last one is not)."""
    n = len(text)
    rises = np.zeros(n, bool)
    rises[:-1] = text[:-1] < text[1:]
    decides = np.arange(n, dtype=np.int32)  # the next position whose neighbours differ
    decides[:-1][text[:-1] == text[1:]] = n - 1
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    return rises[decides]


def _words(text: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes from every position on as one big-endian number."""
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    two = (padded[:-1].astype(np.uint16) << np.uint16(8)) | padded[1:]
    four = (two[:-2].astype(np.uint32) << np.uint32(16)) | two[2:]
    return (four[:-4].astype(np.uint64) << np.uint64(32)) | four[4:]


def _sort_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` ordered by the first ``depth`` bytes (whole words) after them."""
    if not len(at):
        return at
    first = words[at]
    order = at[np.argsort(first, kind="stable")]
    del first
    tied_at, group = np.arange(len(order), dtype=np.int32), None
    value = words[order]
    for offset in range(8, depth, 8):
        new = np.r_[True, value[1:] != value[:-1]] if group is None else np.r_[True, (group[1:] != group[:-1]) | (value[1:] != value[:-1])]
        alone = new & np.r_[new[1:], True]
        number = np.cumsum(new)
        tied_at, group = tied_at[~alone], number[~alone]
        if not len(tied_at):
            break
        own = order[tied_at]
        value = words[own + offset]
        again = np.lexsort((value, group))
        order[tied_at], value = own[again], value[again]
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (uint8) by their suffixes, to ``depth`` bytes at least;
    suffixes that agree that far stand together in any order."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int32)
    is_b = type_b(text)
    direct = _sort_directly(np.flatnonzero(is_b).astype(np.int32), _words(text, depth), depth)
    starts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1], np.int32))  # the end is smaller than any byte
    out = []
    for byte in range(256):
        induced = np.concatenate([np.zeros(0, np.int32), *waiting[byte]])
        waiting[byte] = []
        parts, wave = [induced], induced
        while len(wave):  # type-A suffixes whose successor starts with the same byte
            before = wave[wave > 0] - 1
            wave = before[(text[before] == byte) & ~is_b[before]]
            parts.append(wave)
        bucket = np.concatenate([*parts, direct[starts[byte]:starts[byte + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~is_b[before] & (text[before] > byte)]
        if len(before):
            order = np.argsort(text[before], kind="stable")
            before = before[order]
            edges = np.flatnonzero(np.r_[True, text[before][1:] != text[before][:-1]])
            for a, b in zip(edges, np.r_[edges[1:], len(before)]):
                waiting[text[before[a]]].append(before[a:b])
    return np.concatenate(out)


def adjacent_agree(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For every entry of a suffix order, whether it shares its first ``length`` bytes
    with the entry before it, that is, whether their common prefix is that long. Only
    pairs that agree so far are compared further."""
    padded = np.concatenate([text, np.zeros(length + 8, np.uint8)])
    words = _words(padded, 0)
    same = np.zeros(len(order), bool)
    open_ = np.arange(1, len(order), dtype=np.int32)
    for offset in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        open_ = open_[words[order[open_] + offset] == words[order[open_ - 1] + offset]]
    same[open_] = True
    return same
