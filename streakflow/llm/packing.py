"""Packing of tokenized documents into training sequences by dynamic programming.

Documents stay in order, one after the other; the only question is where the stream is
cut into sequences of at most ``width`` tokens. A cut may stand after a document or a
sentence (after any token only where neither comes for a whole width, and at the
stream's end). The cuts minimise padding plus truncation penalties:

    cost[j] = penalty[j] + min over i of cost[i] + padding(position[j] - position[i])

A sequence is padded to ``width``, so the minimum over the window is that of
``cost[i] + position[i]``, kept in a monotone queue (amortised constant time). A
sequence whose length is a power of two is not padded; those few lengths are looked up.

Distribution: one narrow pass, no shuffle: every input partition is a stream of its
own, worked through in blocks of a few million tokens; the last windows of a block are
cut again with the next one. A document may span many sequences, never partitions.
Sequence numbers carry the partition's number above 33 bits.

Cases: null counts as empty (its end mark alone); repeated rows are packed each; null
ids are kept; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from streakflow.llm.common import by_bytes, map_arrow, text_of, tokenizer_path
from streakflow.llm.token_count import _pre_tokens, proven_tokens
from streakflow.llm.word_table import WordTable, gather, kept

#: Marks that end a sentence (fixed values).
_ENDS = ".!?…。！？"


class WordIds:
    """Ids of texts by a word tokenizer that drops white space, one process."""

    def __init__(self, spec: str, proven: frozenset[str]):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers as pre

        self.tokenizer = Tokenizer.from_str(spec)
        pattern = next(p["pattern"]["Regex"] for p in json.loads(spec)["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern + r"|\n").findall
        # below U+0250 this split and lower-casing are the library's (as in token_count)
        self.simple = re.compile("[\0-ɏ]*").fullmatch
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre.Sequence([pre.WhitespaceSplit(), pre.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.tokenizer.model.end_of_word_suffix
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.last[[i for name, i in names.items() if name.endswith(suffix)]] = True
        ends = set(_ENDS)
        self.ends_sentence = np.zeros(len(self.last), bool)
        self.ends_sentence[[i for name, i in names.items() if name.endswith(suffix) and set(name[:-len(suffix)]) & ends]] = True
        pieces = list(proven)
        self.flat, self.sizes = self._merge(pieces)
        self.sizes = np.r_[self.sizes, 0]  # the line break between words has no ids
        self.line = len(pieces)
        self.numbers = {**dict(zip(pieces, range(self.line))), "\n": self.line}
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join(["[\x1c-\x1f]", *map(re.escape, special)])
        self.table = WordTable(self._learn)

    def _merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, how many of each) of pre-tokens (none holds white space), many in one call."""
        joined = [" ".join(pieces[k:k + 2000]) for k in range(0, len(pieces), 2000)]
        flat = np.concatenate([np.zeros(0, np.int32), *(np.array(e.ids, np.int32) for e in self.merges.encode_batch_fast(joined, add_special_tokens=False))])
        ends = np.flatnonzero(self.last[flat]) + 1
        assert len(ends) == len(pieces)
        return flat, np.diff(ends, prepend=0)

    def _learn(self, words: list[str]) -> tuple[list[str], np.ndarray, dict[str, np.ndarray]]:
        joined = "\n".join(words)
        simple = words if self.simple(joined) else [w for w in words if self.simple(w)]
        parts = self.split(joined.lower() if simple is words else "\n".join(simple).lower())
        if simple:
            parts.append("\n")
        if simple is not words:
            other = [w for w in words if not self.simple(w)]
            for w in other:
                parts += [*_pre_tokens(self.tokenizer, w), "\n"]
            words = simple + other
        rest = list(set(parts) - self.numbers.keys())
        flat, sizes = self._merge(rest)
        numbers = {**self.numbers, **dict(zip(rest, range(self.line + 1, self.line + 1 + len(rest))))}
        at = np.fromiter(map(numbers.__getitem__, parts), np.int64, len(parts))
        flat, sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
        starts, sizes = (np.cumsum(sizes) - sizes)[at], sizes[at]
        return words, np.diff(np.cumsum(sizes)[at == self.line], prepend=0), {"ids": flat[gather(starts, sizes)]}

    def __call__(self, some: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(token count of every text, all ids)."""
        some = some.cast(pa.large_string())
        odd = pc.match_substring_regex(some, self.odd).to_numpy(zero_copy_only=False).astype(bool)
        words = pc.ascii_split_whitespace(pc.if_else(pa.array(~odd), some, "") if odd.any() else some)
        flat = words.flatten()
        rows = self.table(flat) if len(flat) else np.zeros(0, np.int64)
        sizes = np.r_[0, np.cumsum(self.table.sizes[rows])]
        ends = sizes[np.r_[0, np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64))]]
        ids = self.table.expand(rows, "ids") if len(rows) else np.zeros(0, np.int32)
        if not odd.any():
            return np.diff(ends), ids
        own = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.int32) if o else ids[a:b]
               for t, o, a, b in zip(some.to_pylist(), odd, ends[:-1], ends[1:])]
        return np.array([len(x) for x in own]), np.concatenate(own)


def best_cuts(position: np.ndarray, penalty: np.ndarray, width: int) -> list[int]:
    """Indexes of the cuts to take, the last candidate included. ``position`` ascends from
    0 (the stream's begin) by at most ``width`` a step."""
    n = len(position)
    index = np.full(int(position[-1]) + 1, -1, np.int32)
    index[position] = np.arange(n)
    powers = [1 << k for k in range(width.bit_length()) if 1 << k <= width]
    froms, tos = [], []
    for power in powers:  # where a sequence of this length may end
        to = np.flatnonzero(position >= power)
        at = index[position[to] - power]
        froms.append(at[at >= 0])
        tos.append(to[at >= 0])
    tos, froms = np.concatenate(tos), np.concatenate(froms)
    order = np.argsort(tos, kind="stable")
    edges = np.searchsorted(tos[order], np.arange(n + 1)).tolist()
    froms = froms[order].tolist()
    where, extra = position.tolist(), penalty.tolist()
    cost, back = [0] * n, [0] * n
    queue = deque([0])
    key = [0] * n  # cost + position: what the window's minimum is taken of
    for j in range(1, n):
        here = where[j]
        while where[queue[0]] < here - width:
            queue.popleft()
        i = queue[0]
        best = key[i] + width - here
        for k in froms[edges[j]:edges[j + 1]]:
            if cost[k] <= best:
                best, i = cost[k], k
        cost[j] = best = best + extra[j]
        back[j] = i
        key[j] = best = best + here
        while queue and key[queue[-1]] >= best:
            queue.pop()
        queue.append(j)
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


class Packer:
    """The stream of one partition: documents in, pieces out."""

    def __init__(self, width: int, sentence: np.ndarray, sentence_cut: int, token_cut: int, first_sequence: int):
        self.width, self.sentence, self.sentence_cut, self.token_cut = width, sentence, sentence_cut, token_cut
        self.sequence = first_sequence
        self.ids = np.zeros(0, np.int32)
        self.docs: list[tuple] = []  # (id, whole length) of documents not yet passed on
        self.ends = np.zeros(0, np.int64)  # where each ends in self.ids
        self.skipped = 0  # tokens of the first one that are passed on already

    def add(self, doc_ids: list, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.ends = np.concatenate([self.ends, len(self.ids) + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])
        self.docs += zip(doc_ids, sizes.tolist())

    def _candidates(self, final: bool) -> tuple[np.ndarray, np.ndarray]:
        n, width = len(self.ids), self.width
        kind = np.zeros(n + 1, np.int8)  # 1: any token, 2: sentence, 3: document
        kind[1:][self.sentence[self.ids]] = 2
        kind[self.ends] = 3
        kind[[0, n]] = 3
        if final:  # any length is a sum of powers of two, so the rest needs no padding
            tail = kind[max(1, n - 2 * width):]
            tail[tail == 0] = 1
        at = np.flatnonzero(kind)
        for k in np.flatnonzero(np.diff(at) > width):
            kind[at[k] + width:at[k + 1]:width] = 1
        at = np.flatnonzero(kind)
        return at, np.array([0, self.token_cut, self.sentence_cut, 0])[kind[at]]

    def pack(self, final: bool) -> dict[str, list]:
        """The pieces of the sequences that are settled; the rest waits for more tokens."""
        out = {name: [] for name in ("doc", "start", "length", "crc", "total", "sequence", "offset")}
        n = len(self.ids)
        if not n or (not final and n < 16 * self.width):
            return out
        position, penalty = self._candidates(final)
        cuts = position[best_cuts(position, penalty, self.width)]
        if not final:
            cuts = cuts[cuts <= n - 4 * self.width]
        done = int(cuts[-1])
        borders = np.union1d(cuts, self.ends[self.ends < done])
        begins = np.r_[0, borders[:-1]]
        doc = np.searchsorted(self.ends, begins, "right")
        sequence = np.searchsorted(cuts, begins, "right")
        doc_begin = np.r_[-self.skipped, self.ends[:-1]][doc]
        raw = self.ids.astype("<u4")
        out["doc"] = [self.docs[d][0] for d in doc]
        out["total"] = [self.docs[d][1] for d in doc]
        out["start"] = (begins - doc_begin).tolist()
        out["length"] = (borders - begins).tolist()
        out["crc"] = [zlib.crc32(raw[a:b]) for a, b in zip(begins.tolist(), borders.tolist())]
        out["sequence"] = (self.sequence + sequence).tolist()
        out["offset"] = (begins - np.r_[0, cuts[:-1]][sequence]).tolist()
        self.sequence += len(cuts)
        passed = int(np.searchsorted(self.ends, done, "right"))
        begin = int(self.ends[passed - 1]) if passed else -self.skipped
        self.ids, self.docs, self.ends, self.skipped = self.ids[done:], self.docs[passed:], self.ends[passed:] - done, done - begin
        return out


_PIECES = [("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType()),
           ("sequence_id", T.LongType()), ("offset", T.LongType())]


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4096, end_id: int = 2,
                   sentence_cut: int = 4, token_cut: int = 32, path: str | None = None, token_ids: bool = False) -> DataFrame:
    """One row per piece of a document: ``id_col``, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with ``token_ids`` the ids themselves.

    ``sentence_cut`` and ``token_cut`` are the padding tokens that a cut inside a
    document, after a sentence or elsewhere, is worth."""
    from tokenizers import Tokenizer

    with open(path or tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((spec, proven_tokens(Tokenizer.from_str(spec))))  # bounded by the vocabulary
    fields = [docs.schema[id_col], *(T.StructField(n, t) for n, t in _PIECES)]
    if token_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("word_ids", hash(shared.value[0])), lambda: WordIds(*shared.value))
        packer = Packer(width, encoder.ends_sentence, sentence_cut, token_cut, TaskContext.get().partitionId() << 33)
        kind = pa.int64()

        def pieces(final: bool) -> pa.RecordBatch:
            ids = packer.ids
            p = packer.pack(final)
            columns = [pa.array(p["doc"], kind), *(pa.array(p[c], pa.int64()) for c in ("start", "length", "crc", "total", "sequence", "offset"))]
            if token_ids:
                ends = np.cumsum([0, *p["length"]], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[:ends[-1]], pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            kind = batch.column(0).type
            for part in by_bytes(batch, 1, 8 << 20):
                sizes, ids = encoder(part.column(1))
                at = np.cumsum(sizes)
                packer.add(part.column(0).to_pylist(), sizes + 1, np.insert(ids, at, end_id))
                yield pieces(False)
        yield pieces(True)

    return map_arrow(docs.select(id_col, text_of(text_col).alias("__text")), run, T.StructType(fields), keeps=True)
