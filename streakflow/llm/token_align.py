"""Alignment of the tokens of two tokenizers by interval coalescing.

A is a byte-level BPE, B a piece BPE that marks spaces; both cover the bytes of
space + text. All tokens of A and B are sorted together by start (``lexsort``), the
running maximum of their ends is taken (``maximum.accumulate``), and a group breaks
where a start reaches that maximum: there both tokenizations end a token. Inside a
group, overlaps are expanded to links, one for each pair of overlapping tokens.

Both tokenizers begin a token at a single space between two other characters (checked
for B's vocabulary when it is loaded; true of A's split pattern), so no group crosses
one. Texts are cut there and each distinct segment is aligned once per worker table.

The corpus-wide count of an id pair is the number of its links. First pass: every task
counts the pairs of its own texts, Spark adds the counts up by pair. Second pass: the
links' counts come from a sorted array where the pairs are few enough to broadcast
(``broadcast_pairs``, checked), and else from an equi-join of (document, pair) rows,
combined per document before the shuffle, with every pair dealt to ``salts`` tasks.

Cases: null and empty texts, and texts whose tokens do not give back their bytes (a
literal U+2581), have no tokens: zeros and an empty string; special strings are plain
text; repeated rows are aligned each; null ids are kept; an empty table gives an empty
result; other columns are not read.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from streakflow.llm.bpe_codec import as_piece, build_model
from streakflow.llm.common import by_bytes, cut, map_arrow, text_of, tokenizer_path
from streakflow.llm.word_table import WordTable, gather, kept

_SPACE = "▁"


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group numbers of the tokens in order of (start, tokenizer), that order, and which
    entries of it open a group. Token i of B is number len(a) + i."""
    start, end = np.r_[a_start, b_start], np.r_[a_end, b_end]
    of_b = np.r_[np.zeros(len(a_start), np.int8), np.ones(len(b_start), np.int8)]
    order = np.lexsort((of_b, start))
    reach = np.maximum.accumulate(end[order])
    opens = np.r_[True, start[order][1:] >= reach[:-1]] if len(order) else np.zeros(0, bool)
    return np.cumsum(opens) - 1, order, opens


def links(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of overlapping tokens; either side tiles its bytes in order, so a token's
    partners are neighbours."""
    first = np.searchsorted(b_end, a_start, "right")
    count = np.searchsorted(b_start, a_end, "left") - first
    return np.repeat(np.arange(len(a_start)), count), gather(first, count)


def proven_strings(spec: str) -> dict[str, int]:
    """Strings that A, given them alone, turns into one token (by the library itself)."""
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(spec)
    a.encode_special_tokens = True
    known = list({a.decode([i]) for i in a.get_vocab(with_added_tokens=False).values()})
    return {text: e.ids[0] for text, e in zip(known, a.encode_batch_fast(known, add_special_tokens=False)) if len(e.ids) == 1}


class Aligner:
    """Segments of one process: ids, groups and links."""

    def __init__(self, spec: str, model: bytes, proven: dict[str, int], strings: bool = True, limit: int = 400_000):
        import re

        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte alphabet's own bytes (fixed values)
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        vocabulary = json.loads(spec)["model"]["vocab"]
        added = {t.content: i for i, t in self.a.get_added_tokens_decoder().items()}
        self.a_bytes = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
        for name, i in vocabulary.items():
            self.a_bytes[i] = name.encode() if name in added else bytes(map(byte.__getitem__, name))
        # Below U+0250 this split is the library's, and merging by rank is what sentencepiece
        # does with a model of the ranks (tested); other segments go through the library.
        import public_tokenizers

        self.simple = re.compile("[\0-\u024f]*").fullmatch
        self.split, self.proven = regex.compile(public_tokenizers.PATTERN).findall, proven
        self.ranked = sentencepiece.SentencePieceProcessor(model_proto=build_model({t: i for i, t in enumerate(self.a_bytes) if t and i not in added.values()}))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        # a piece with a space mark after another character would cross the segments
        self.whole_only = any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        self.a_size, self.b_size = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        # white space of either regular-expression library, in Arrow's own
        space = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
        self.odd = f"^ | $|{space} | {space}|^$|{_SPACE}"
        self.cut = regex.compile(r"(?<=\S) (?=\S)").split
        self.table = WordTable(self._learn, limit)
        self.with_strings = strings
        self.facts: dict[str, np.ndarray] = {}
        self.strings: list[bytes] = []

    def segments(self, text: str) -> list[str]:
        if not text or _SPACE in text:
            return []
        return [text] if self.whole_only else self.cut(text)

    def _ids_a(self, words: list[str], simple: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of tokens of each segment, all ids), many segments a call; the first
        ``simple`` ones are simple."""
        parts = self.split(" " + " ".join(words[:simple])) if simple else []
        known = self.proven
        rest = list(set(parts) - known.keys())
        ids = dict(zip(rest, self.ranked.encode([as_piece(p.encode()) for p in rest], num_threads=1)))
        first = list(chain.from_iterable([(known[p],) if p in known else ids[p] for p in parts]))
        words_ = words[simple:]
        joined = [" " + " ".join(words_[k:k + 2000]) for k in range(0, len(words_), 2000)] if not self.whole_only else [" " + w for w in words_]
        ids = np.concatenate([np.array(first, np.int64), *(np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(joined, add_special_tokens=False))])
        ends = np.cumsum([1 + len(w.encode("utf-8", "surrogatepass")) for w in words])
        last = np.searchsorted(np.cumsum(self.a_size[ids]), ends, "left") + 1
        return np.diff(last, prepend=0), ids

    def _learn(self, words: list[str]) -> tuple[list[str], np.ndarray, dict[str, np.ndarray]]:
        if not self.table.rows:
            self.facts, self.strings = {}, []
        if self.whole_only:
            simple = 0
        elif self.simple("".join(words)):
            simple = len(words)
        else:
            words.sort(key=lambda w: self.simple(w) is None)
            simple = sum(self.simple(w) is not None for w in words)
        n_a, a = self._ids_a(words, simple)
        b_lists = self.b.encode(words, num_threads=1)
        n_b = np.array([len(x) for x in b_lists], np.int64)
        b = np.fromiter(chain.from_iterable(b_lists), np.int64, int(n_b.sum()))
        whole = [(" " + w).encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(w) for w in whole], np.int64)
        good = self._gives_back(self.a_bytes, self.a_size, a, n_a, whole, size) & self._gives_back(self.b_bytes, self.b_size, b, n_b, whole, size)
        if not good.all():
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b, size = n_a * good, n_b * good, size * good
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_start, b_start = a_end - self.a_size[a], b_end - self.b_size[b]
        group, order, opens = coalesce(a_start, a_end, b_start, b_end)
        of_a, of_b = np.repeat(np.arange(len(words)), n_a), np.repeat(np.arange(len(words)), n_b)
        owner = np.r_[of_a, of_b][order]
        n_groups = np.bincount(owner[opens], minlength=len(words))
        i, j = links(a_start, a_end, b_start, b_end)
        n_links = np.bincount(of_a[i], minlength=len(words))
        facts = {"good": good, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links}
        self.facts = {k: np.concatenate([self.facts[k], v]) if k in self.facts else v for k, v in facts.items()}
        if self.with_strings:
            self.strings += self._strings(group, order, np.r_[a, b], len(a), np.bincount(owner, minlength=len(words)))
        return words, n_links, {"pair": a[i] << 32 | b[j]}

    @staticmethod
    def _gives_back(table: list[bytes], sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray, whole: list[bytes], size: np.ndarray) -> np.ndarray:
        """Which segments the tokens' bytes give back: all at once, and one by one only
        if that fails."""
        ends = np.cumsum(sizes[ids])
        last = np.cumsum(counts)
        if (counts > 0).all() and (ends[last - 1] == np.cumsum(size)).all() and b"".join(map(table.__getitem__, ids.tolist())) == b"".join(whole):
            return np.ones(len(whole), bool)
        listed = ids.tolist()
        return np.array([b"".join(map(table.__getitem__, listed[e - c:e])) == w for e, c, w in zip(last.tolist(), counts.tolist(), whole)], bool)

    def _strings(self, group: np.ndarray, order: np.ndarray, ids: np.ndarray, n_a: int, sizes: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;`` of every segment, each group closed by a semicolon."""
        line = np.lexsort((order, group))  # A before B inside a group, either in text order
        group, order = group[line], order[line]
        of_b = order >= n_a
        last = np.r_[group[1:] != group[:-1], True] if len(group) else np.zeros(0, bool)
        turn = np.r_[of_b[1:] != of_b[:-1], False] if len(group) else last
        mark = np.where(last, 2, np.where(turn, 1, 0))
        tokens = pc.binary_join_element_wise(pa.array(ids[order]).cast(pa.string()), pa.array([",", "|", ";"]).take(pa.array(mark)), "")
        ends = np.cumsum(np.r_[0, sizes])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens)
        return pc.binary_join(lists, "").cast(pa.binary()).to_pylist()

    def rows(self, some: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(table rows of all segments, where each text's begin (one more than texts),
        which texts have tokens)."""
        some = some.cast(pa.large_string())
        odd = pc.match_substring_regex(some, self.odd).to_numpy(zero_copy_only=False).astype(bool) | self.whole_only
        cuts = pc.split_pattern(some, " ")
        sizes = pc.list_value_length(cuts).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = cuts.flatten()
        if odd.any():
            own = {k: self.segments(some[k].as_py()) for k in np.flatnonzero(odd).tolist()}
            keep = flat.filter(pa.array(np.repeat(~odd, sizes)))
            sizes[odd] = [len(x) for x in own.values()]
            # the odd texts' segments stand behind the others' and are put in place by row
            flat = pa.concat_arrays([keep, pa.array(list(chain.from_iterable(own.values())), pa.large_string())])
        rows = self.table(flat) if len(flat) else np.zeros(0, np.int64)
        if odd.any():
            placed = np.empty_like(rows)
            late = np.repeat(odd, sizes)
            placed[~late], placed[late] = rows[:len(keep)], rows[len(keep):]
            rows = placed
        ends = np.r_[0, np.cumsum(sizes)]
        bad = np.cumsum(np.r_[0, ~self.facts["good"][rows]]) if len(rows) else np.zeros(1, np.int64)
        return rows, ends, (bad[ends[1:]] == bad[ends[:-1]]) & (ends[1:] > ends[:-1])


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.cumsum(np.r_[0, values])
    return total[ends[1:]] - total[ends[:-1]]


def _aligner(shared, strings: bool = True) -> Aligner:
    return kept(("aligner", strings, hash(shared[:2])), lambda: Aligner(*shared, strings, 400_000 if strings else 800_000))


def _count_pairs(shared):
    """Partial counts of the id pairs. Segments are counted by table row; pairs are
    expanded when the table is emptied and at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared.value, strings=False)
        table, ready, often = aligner.table, [], np.zeros(0, np.int64)

        def expand() -> None:
            nonlocal often
            rows = np.flatnonzero(often)
            if len(rows):
                pairs, index = np.unique(table.expand(rows, "pair"), return_inverse=True)
                counts = np.bincount(index, np.repeat(often[rows], table.sizes[rows]), len(pairs)).astype(np.int64)  # exact below 2^53
                ready.append(pa.RecordBatch.from_arrays([pa.array(pairs >> 32), pa.array(pairs & 0xFFFFFFFF), pa.array(counts)], names=["a", "b", "n"]))
            often = np.zeros(0, np.int64)

        table.before_clear = expand
        try:
            for batch in batches:
                for part in by_bytes(batch, 0):
                    rows, ends, good = aligner.rows(part.column(0))
                    own = np.bincount(rows[np.repeat(good, np.diff(ends))], minlength=len(table.sizes))
                    own[:len(often)] += often
                    often = own
                    yield from ready
                    ready.clear()
            expand()
            yield from ready
        finally:
            table.before_clear = None

    return run


class PairCounts:
    """For every table row, the sum of its links' counts and how many are their B id's best."""

    def __init__(self, table: WordTable, key: np.ndarray, n: np.ndarray, best: np.ndarray):
        self.table, self.key, self.n, self.best = table, key, n, best
        self.generation, self.facts = -1, {}

    def __call__(self, rows: np.ndarray, name: str) -> np.ndarray:
        if self.generation != self.table.generation:
            self.generation, self.facts = self.table.generation, {"count_sum": np.zeros(0, np.int64), "n_best": np.zeros(0, np.int64)}
        done = len(self.facts["n_best"])
        if done < len(self.table.sizes):
            new = np.arange(done, len(self.table.sizes))
            pairs = self.table.expand(new, "pair")
            at = np.minimum(np.searchsorted(self.key, pairs), max(0, len(self.key) - 1))
            known = self.key[at] == pairs if len(self.key) else np.zeros(len(pairs), bool)  # else of an earlier task's rows
            ends = np.cumsum(np.r_[0, self.table.sizes[new]])
            for c, values in (("count_sum", self.n), ("n_best", self.best)):
                own = np.where(known, values[at], 0) if len(self.key) else np.zeros(len(pairs), np.int64)
                self.facts[c] = np.concatenate([self.facts[c], _sums(own, ends)])
        return self.facts[name][rows]


_DIGEST = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()),
           ("n_best", T.LongType()), ("count_sum", T.LongType()), ("groups", T.StringType()), ("groups_sha256", T.StringType())]


def _columns(aligner: Aligner, rows: np.ndarray, ends: np.ndarray, good: np.ndarray, whole: bool) -> dict[str, pa.Array]:
    out = {c: pa.array(_sums(aligner.facts[c][rows], ends) * good if len(rows) else np.zeros(len(good), np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")}
    strings, listed, at = aligner.strings, rows.tolist(), ends.tolist()
    own = [b"".join(map(strings.__getitem__, listed[p:q]))[:-1] if g else b"" for p, q, g in zip(at, at[1:], good.tolist())]
    out["groups_sha256"] = pa.array([hashlib.sha256(s).hexdigest() if s else "" for s in own], pa.string())
    out["groups"] = pa.array(own, pa.binary()).cast(pa.string()) if whole else pa.nulls(len(own), pa.string())
    return out


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None,
          broadcast_pairs: int = 4_000_000, salts: int = 16, groups: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, and with ``groups`` the groups as a string."""
    spark = docs.sparkSession
    spec, model = _read(a_path or tokenizer_path("byte_bpe_50k.json")).decode(), _read(b_path or tokenizer_path("piece_bpe_32k.model"))
    shared = spark.sparkContext.broadcast((spec, model, proven_strings(spec)))  # bounded by the vocabularies
    text = text_of(text_col).alias("__text")
    counted = map_arrow(docs.select(text), _count_pairs(shared), "a long, b long, n long", keeps=True)
    pairs = cut(counted.groupBy("a", "b").agg(F.sum("n").alias("n")))
    few = pairs.count() <= broadcast_pairs
    fields = [docs.schema[id_col], *(T.StructField(n, t) for n, t in _DIGEST if groups or n != "groups")]
    names = [f.name for f in fields]
    top = pairs.groupBy("b").agg(F.max("n").alias("top"))  # a row an id of B at most
    best = pairs.join(F.broadcast(top), "b").select("a", "b", "n", (F.col("n") == F.col("top")).cast("long").alias("best"))
    if few:
        table = best.select(F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("key"), "n", "best").toArrow()  # at most broadcast_pairs rows of 24 bytes
        key, n, flag = (table[c].to_numpy() for c in ("key", "n", "best"))
        order = np.argsort(key)
        found = spark.sparkContext.broadcast((key[order], n[order], flag[order]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = _aligner(shared.value)
            counts = PairCounts(aligner.table, *found.value)
            for batch in batches:
                for part in by_bytes(batch, 1):
                    rows, ends, good = aligner.rows(part.column(1))
                    out = _columns(aligner, rows, ends, good, groups)
                    for name in ("count_sum", "n_best"):
                        out[name] = pa.array(_sums(counts(rows, name), ends) * good)
                    yield pa.RecordBatch.from_arrays([part.column(0), *(out[c] for c in names[1:])], names=names)

        return map_arrow(docs.select(id_col, text), run, T.StructType(fields), keeps=True)

    # many pairs: documents send theirs, each once with its multiplicity
    digest = [f for f in fields if f.name not in ("n_best", "count_sum")]
    spread = T.StructType([*digest, T.StructField("__row", T.LongType()), T.StructField("__a", T.LongType()),
                           T.StructField("__b", T.LongType()), T.StructField("__n", T.LongType())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared.value)
        for batch in batches:
            for part in by_bytes(batch, 1):
                rows, ends, good = aligner.rows(part.column(1))
                out = _columns(aligner, rows, ends, good, groups)
                n, none = part.num_rows, pa.int64()
                yield pa.RecordBatch.from_arrays([part.column(0), *(out[f.name] for f in digest[1:]), part.column(2), pa.nulls(n, none), pa.nulls(n, none), pa.nulls(n, none)],
                                                 names=spread.names)
                for k in np.flatnonzero(good):
                    distinct, often = np.unique(aligner.table.expand(rows[ends[k]:ends[k + 1]], "pair"), return_counts=True)
                    m = len(distinct)
                    yield pa.RecordBatch.from_arrays([pa.nulls(m, part.column(0).type), *(pa.nulls(m, out[f.name].type) for f in digest[1:]),
                                                      pa.array(np.full(m, part.column(2)[int(k)].as_py())), pa.array(distinct >> 32), pa.array(distinct & 0xFFFFFFFF),
                                                      pa.array(often)], names=spread.names)

    numbered = docs.select(id_col, text, F.monotonically_increasing_id().alias("__row"))
    both = cut(map_arrow(numbered, emit, spread, keeps=True))
    salt = F.pmod(F.xxhash64("__row"), F.lit(salts)).cast("int")
    dealt = best.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    own = both.where("__a is not null").select("__row", "__a", "__b", "__n", salt.alias("salt"))
    summed = own.join(dealt, (own["__a"] == dealt["a"]) & (own["__b"] == dealt["b"]) & (own["salt"] == dealt["salt"])) \
        .groupBy("__row").agg(F.sum(F.col("__n") * F.col("best")).alias("n_best"), F.sum(F.col("__n") * F.col("n")).alias("count_sum"))
    base = both.where("__a is null").drop("__a", "__b", "__n")
    return base.join(summed, "__row", "left").select(*[F.coalesce(c, F.lit(0)).alias(c) if c in ("n_best", "count_sum") else F.col(c) for c in names])
