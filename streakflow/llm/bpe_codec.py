"""Byte-level BPE encoding and decoding through a sentencepiece model that is
serialised straight from a rank vocabulary.

Every vocabulary entry (a byte string) becomes one piece: each byte is one character
(visible ASCII itself, any other byte ``b`` U+0100 + b), its score is minus its rank,
and the normaliser is the identity. sentencepiece merges the adjacent pair with the best score, leftmost
first, which is the rank order of byte-level BPE. Texts are split into pre-tokens
first, and each distinct pre-token is encoded alone; a pre-token that is itself a
vocabulary entry is that one token. Decoding maps ids back to pieces and pieces
back to bytes.

Cases: a null text counts as empty and gives no ids; null ids decode to empty
bytes; repeated rows are encoded alike; an id outside the vocabulary is an error.
Only the named columns are read, so other columns of any name do not matter.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from streakflow.llm.common import Memo, by_bytes, map_arrow, text_of, texts, tokenizer_path

# Visible ASCII stands for itself, any other byte b for the character U+0100 + b.
_TO_CHARS = {b: chr(b if 0x20 < b < 0x7F else 0x100 + b) for b in range(256)}
_SPACE = _TO_CHARS[0x20]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token, a space, its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def as_piece(token: bytes) -> str:
    return token.decode("latin-1").translate(_TO_CHARS)


def as_bytes(piece: str) -> bytes:
    return bytes(ord(c) & 0xFF for c in piece)


def build_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece model. Piece i is the token of rank i (ranks
    that no token has are unused pieces); the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model, by_rank = pb.ModelProto(), {rank: token for token, rank in ranks.items()}
    for rank in range(max(by_rank, default=-1) + 1):
        piece = model.pieces.add()
        if rank in by_rank:
            piece.piece, piece.score = as_piece(by_rank[rank]), -float(rank)
        else:
            piece.piece, piece.type = f"<unused{rank}>", pb.ModelProto.SentencePiece.UNUSED
    unknown = model.pieces.add()
    unknown.piece, unknown.type = "<unk>", pb.ModelProto.SentencePiece.UNKNOWN
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.unk_id = len(model.pieces) - 1
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Encoder:
    """Texts to ids in one process."""

    def __init__(self, model: bytes, pattern: str):
        import re

        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids = list(range(self.model.get_piece_size()))  # one int object per id, shared by the memo
        unknown = self.model.unk_id()
        self.whole = {self.model.id_to_piece(i): (i,) for i in self.ids if i != unknown}
        self.split = regex.compile(pattern).findall
        # A single space between two other characters always starts a new pre-token of
        # such patterns, so texts are cut there and each distinct segment is encoded once.
        self.odd_space = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
        self.cut = regex.compile(r"(?<=\S) (?=\S)").split
        self.first = Memo(self._encode, 10_000)
        self.rest = Memo(lambda segments: self._encode([" " + s for s in segments]), 250_000)

    def _pieces(self, segment: str) -> list[str]:
        head, word = (_SPACE, segment[1:]) if segment[:1] == " " else ("", segment)
        if word.isalpha():  # mostly one pre-token, or one and a mark
            return [head + word if word.isascii() else head + as_piece(word.encode("utf-8", "surrogatepass"))]
        if word[-1:] in (".", ",") and word[:-1].isalpha():
            return [head + as_piece(word[:-1].encode("utf-8", "surrogatepass")), word[-1]]
        return [as_piece(t.encode("utf-8", "surrogatepass")) for t in self.split(segment)]

    def _encode(self, segments: list[str]) -> list[tuple[int, ...]]:
        """The ids of segments: each is split into pre-tokens, whole vocabulary entries
        are looked up, the others go to sentencepiece in one call."""
        parts = list(map(self._pieces, segments))
        known = self.whole
        rest = list(set(chain.from_iterable(parts)) - known.keys())
        merged = dict(zip(rest, self.model.encode(rest, num_threads=1))) if rest else {}
        share = self.ids.__getitem__
        return [tuple(chain.from_iterable(known.get(p) or map(share, merged[p]) for p in pieces)) for pieces in parts]

    def _cut(self, text: str) -> list[str]:
        if self.odd_space(text) or "  " in text or " \n" in text or "\n " in text:
            return self.cut(text)
        return text.split(" ")

    def encode_all(self, some: list[str]) -> list[np.ndarray]:
        cuts = list(map(self._cut, some))
        self.first.learn({segments[0] for segments in cuts})
        self.rest.learn(set(chain.from_iterable(segments[1:] for segments in cuts)))
        return [np.fromiter(chain(self.first[segments[0]], chain.from_iterable(map(self.rest.__getitem__, segments[1:]))),
                            np.int32) for segments in cuts]


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in ids], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *ids]), pa.int32()))


def _bytes_of(lists: pa.Array, table: pa.Array) -> pa.Array:
    tokens = table.take(lists.flatten())
    if tokens.null_count:
        raise ValueError("an id that the vocabulary lacks")
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    parts = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), tokens)
    return pc.binary_join(parts, pa.scalar(b"", pa.large_binary())).cast(pa.binary())


def _byte_table(model: bytes) -> pa.Array:
    """The bytes of every id, read back from the model's pieces (null: no token)."""
    import sentencepiece

    reader = sentencepiece.SentencePieceProcessor(model_proto=model)
    return pa.array([None if reader.is_unknown(i) or reader.is_unused(i) else as_bytes(reader.id_to_piece(i))
                     for i in range(reader.get_piece_size())], pa.large_binary())


def _model(ranks_path: str | None) -> bytes:
    return build_model(read_ranks(ranks_path or tokenizer_path("byte_bpe_multi_50k.tiktoken")))


def encode(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), out: str = "token_ids",
           decoded: str | None = None, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``carry`` columns plus ``out`` (array<int>): the ids of the whole text; with
    ``decoded``, also that column (binary), the ids' decoding.

    The model is built on the driver and travels as one broadcast of about a
    megabyte: its size is that of the vocabulary, never of the data. One narrow
    pass, no shuffle; a worker holds one Arrow batch and a bounded memo."""
    import public_tokenizers

    model = docs.sparkSession.sparkContext.broadcast(_model(ranks_path))
    split = pattern or public_tokenizers.PATTERN
    names = [*carry, out, *([decoded] if decoded else [])]
    schema = T.StructType([docs.schema[c] for c in carry] + [T.StructField(out, T.ArrayType(T.IntegerType()))]
                          + ([T.StructField(decoded, T.BinaryType())] if decoded else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value, split)
        table = _byte_table(model.value) if decoded else None
        for batch in batches:
            for part in by_bytes(batch, len(carry), 1 << 20):
                lists = _id_lists(encoder.encode_all(texts(part.column(len(carry)))))
                back = [_bytes_of(lists, table)] if decoded else []
                yield pa.RecordBatch.from_arrays([*part.columns[:len(carry)], lists, *back], names=names)

    return map_arrow(docs.select(*carry, text_of(text_col).alias("__text")), run, schema)


def decode(encoded: DataFrame, ids_col: str = "token_ids", carry: tuple[str, ...] = ("doc_id",), out: str = "decoded",
           ranks_path: str | None = None) -> DataFrame:
    """``carry`` columns plus ``out`` (binary): the bytes that the ids stand for.
    Binary, because ids need not end at a character's end."""
    model = encoded.sparkSession.sparkContext.broadcast(_model(ranks_path))
    schema = T.StructType([encoded.schema[c] for c in carry] + [T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _byte_table(model.value)
        for batch in batches:
            back = _bytes_of(batch.column(len(carry)), table)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carry)], back], names=[*carry, out])

    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    return map_arrow(encoded.select(*carry, ids.alias("__ids")), run, schema)
