"""Token counts with a whole-token shortcut.

Offline, on the driver, every vocabulary string is put through the tokenizer's own
normaliser, pre-tokeniser and merges; those that stay one pre-token and come out as
one token are proven. At run time a proven pre-token counts one, and only the rest
is merged. The tokenizer removes white space and no pre-token spans it, so texts
are cut at white space and each distinct word is counted once per worker memo.

Texts that hold a special string, or one of the control characters U+001C-U+001F
(white space to Python, not to the tokenizer), go through the library whole.

Cases: null counts as empty (0 bytes, 0 tokens); repeated rows count alike; other
columns of any name are not read.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from streakflow.llm.common import Memo, by_bytes, map_arrow, text_of, texts, tokenizer_path


#: Bytes that stand for themselves in the byte alphabet of byte-level BPE (fixed
#: values); the others follow from U+0100 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


def _pre_tokens(tokenizer, text: str) -> list[str]:
    """The raw pre-tokens of one text, by the library."""
    normal = tokenizer.normalizer.normalize_str(text)
    return [normal[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]


def proven_tokens(tokenizer) -> frozenset[str]:
    """Strings that the tokenizer, given them alone, leaves one pre-token and turns
    into one token."""
    suffix = tokenizer.model.end_of_word_suffix or ""
    found = set()
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        piece = entry[:len(entry) - len(suffix)]
        try:
            text = bytes(_BYTE_OF[c] for c in piece).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if entry.endswith(suffix) and _pre_tokens(tokenizer, text) == [text] and len(tokenizer.model.tokenize(piece)) == 1:
            found.add(text)
    return frozenset(found)


class Counter:
    """Token counts of texts in one process."""

    def __init__(self, spec: str, proven: frozenset[str]):
        import json
        import re

        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(spec)
        self.proven = proven
        pattern = next(p["pattern"]["Regex"] for p in json.loads(spec)["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern).findall
        # Below U+0250 the two regex libraries and lower-casing agree on every character
        # (tested), and no two of them compose; other words are split by the library.
        self.simple = re.compile("[\0-\u024f]*").fullmatch
        self.merges = Tokenizer(self.tokenizer.model)  # merges alone: no normaliser, no split
        self.merges.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join(["[\x1c-\x1f]", *map(re.escape, special)])).search
        self.words = Memo(self._count, 400_000)

    def _count(self, words: list[str]) -> list[int]:
        parts = [self.split(w.lower()) if self.simple(w) else _pre_tokens(self.tokenizer, w) for w in words]
        rest = list({p for pieces in parts for p in pieces if p not in self.proven})
        merged = dict(zip(rest, (len(e.ids) for e in self.merges.encode_batch_fast(rest, add_special_tokens=False))))
        return [sum(merged.get(p, 1) for p in pieces) for pieces in parts]

    def count_all(self, some: list[str]) -> list[int]:
        words = [None if self.odd(t) else t.split() for t in some]
        self.words.learn(set(chain.from_iterable(w for w in words if w)))
        return [len(self.tokenizer.encode(text, add_special_tokens=False).ids) if own is None
                else sum(map(self.words.__getitem__, own)) for text, own in zip(some, words)]


def count_tokens(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",),
                 path: str | None = None) -> DataFrame:
    """``carry`` columns plus n_bytes and n_tokens (long) of the whole text.

    One narrow pass, no shuffle. Broadcast: the tokenizer file and the proven
    strings, both bounded by the vocabulary."""
    from tokenizers import Tokenizer

    with open(path or tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((spec, proven_tokens(Tokenizer.from_str(spec))))
    schema = T.StructType([docs.schema[c] for c in carry]
                          + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value)
        for batch in batches:
            for part in by_bytes(batch, len(carry)):
                tokens = counter.count_all(texts(part.column(len(carry))))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(carry)], part.column(len(carry) + 1),
                                                  pa.array(tokens, pa.int64())], names=[*carry, "n_bytes", "n_tokens"])

    text = text_of(text_col)
    return map_arrow(docs.select(*carry, text.alias("__text"), F.octet_length(text).cast("long").alias("__bytes")), run, schema)
