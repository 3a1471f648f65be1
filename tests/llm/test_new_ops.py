"""Clustering, packing and token alignment against brute force and the libraries."""
import functools
import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from streakflow.llm import ns_clusters, packing, token_align

# --- 11: centroid clustering --------------------------------------------------------------

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("cluster", T.StringType()), T.StructField("v", T.StringType()), T.StructField("id", T.StringType())])


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, "c", "v", "i") for i, e in rows], VECTORS).repartition(3)


def lloyd(rows, dims, clusters, rounds):
    """Plain rounds in whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    by_hash = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in by_hash[:clusters]]
    for t in range(rounds + 1):
        own = [min((sum((x - y) ** 2 for x, y in zip(v, m)), k) for k, m in enumerate(c)) for _, v in kept]
        if t < rounds:
            groups = [[v for (_, v), (_, k) in zip(kept, own) if k == j] for j in range(len(c))]
            c = [[sum(x) // len(g) for x in zip(*g)] if g else m for g, m in zip(groups, c)]
    total = sum(d for d, _ in own)
    return Counter((i, k, d, sum(e for e, j in own if j == k), total, hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest())
                   for (i, _), (d, k) in zip(kept, own))


def clusters_of(spark, rows, dims, clusters, rounds):
    out = ns_clusters.clustered(vectors(spark, rows), dims=dims, clusters=clusters, rounds=rounds)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return Counter(tuple(r) for r in out.collect())


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 6))
    rows = [(i, (centres[i % 9] + rng.normal(scale=0.4, size=6)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)]  # many equal vectors
    assert clusters_of(spark, rows, 6, 12, 5) == lloyd(rows, 6, 12, 5)


def test_clusters_odd_vectors(spark):
    rows = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, 0.25]), (3, None), (4, []), (5, [1.0]), (6, [None, 1.0]), (7, [math.nan, 0.0]),
            (8, [math.inf, 0.0]), (None, [3.0, 4.0]), (9, [-0.001, 1e-9]), (10, [0.0, -0.0]), (11, [1.0, 2.0, 3.0])]
    assert clusters_of(spark, rows, 2, 4, 3) == lloyd(rows, 2, 4, 3)
    assert clusters_of(spark, rows, 2, 40, 2) == lloyd(rows, 2, 40, 2)  # more clusters than vectors
    assert clusters_of(spark, [(3, None)], 2, 4, 3) == Counter()


def test_clusters_of_large_components(spark):
    rows = [(i, [float((i * 37) % 11) * 1e5, float(i)]) for i in range(40)]
    assert clusters_of(spark, rows, 2, 5, 4) == lloyd(rows, 2, 5, 4)
    huge = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [1.0, 1.0]), (4, [1.0, 2.0])]
    got = ns_clusters.clustered(vectors(spark, huge), dims=2, clusters=3, rounds=2).collect()
    assert {r.vec_id for r in got} == {1, 2, 3, 4}


def test_bounds_spare_measurements_and_never_lie():
    rng = np.random.default_rng(1)
    points = (rng.normal(size=(8, 16))[rng.integers(0, 8, 2000)] * 300 + rng.normal(size=(2000, 16)) * 60).astype(np.int64)
    rounds = [points[:8].tolist()]
    state = ns_clusters.first_state(points, ns_clusters.History(rounds))
    for _ in range(6):
        rounds.append([(points[state["cluster"] == c].sum(0) // max(1, (state["cluster"] == c).sum())).tolist() for c in range(8)])
        history = ns_clusters.History(rounds)
        before = state["lower_at"].copy()
        state = ns_clusters.next_state(points, state, history)
        d = ns_clusters.measure(points, history.now)
        assert (state["cluster"] == d.argmin(1)).all()
    assert (state["lower_at"] == before).mean() > 0.5  # most bounds held without a measurement


# --- 12: packing ----------------------------------------------------------------------------

@functools.cache
def library(name):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path(name))


def library_ids(text):
    return [*library("word_bpe_49k.json").encode(text or "", add_special_tokens=False).ids, 2]


def check_pieces(pieces, rows, width):
    """Every id in one piece, gapless sequences, whole documents; the padding."""
    want, got = Counter(), {}
    for i, t in rows:
        want[i, tuple(library_ids(t))] += 1
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.length == len(p.ids) > 0 and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        got.setdefault(p.sequence_id, []).append(p)
    padding, docs, open_ = 0, Counter(), {}
    for pieces_ in got.values():
        at = 0
        for p in pieces_:
            assert p.offset == at
            at += p.length
            own = open_.setdefault((p.doc_id, p.doc_tokens), []) if p.start else []
            assert p.start == len(own)
            own = own + list(p.ids)
            if len(own) == p.doc_tokens:
                docs[p.doc_id, tuple(own)] += 1
                own = []
            open_[p.doc_id, p.doc_tokens] = own
        assert at <= width
        padding += 0 if at & (at - 1) == 0 else width - at
    assert docs == want and not any(open_.values())
    return padding


def test_packing_of_odd_documents(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One. Two! Three? <|endoftext|> four\x1c x."), (5, "Ünïcode 日本。語！ İstanbul ΣΑΣ ς é"),
            (6, "word " * 700), (7, "a b. " * 500), (8, "same"), (8, "same"), (None, "no id"), (9, "1234567 it's don't !!!???")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, length string, offset int")
    for parts in (1, 4):
        out = packing.pack_documents(docs.repartition(parts), width=64, token_ids=True).collect()
        assert check_pieces(out, rows, 64) <= 64 * parts  # a cut inside a document is worth 32 here
    assert packing.pack_documents(docs.where("doc_id = 77")).count() == 0


def test_packing_equals_the_library_on_random_text(spark):
    import random

    r = random.Random(3)
    marks = ["a", "B", "é", "ß", "Σ", "İ", "1", "٣", ".", "!", "'s", "'", " ", "  ", "\n", "\t", " ", " ", "日", "😀", "́", "ﬀ", "\x85", "\x1f", "don't"]
    rows = [(k, "".join(r.choice(marks) for _ in range(r.randint(0, 60)))) for k in range(3000)]
    out = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), width=512, token_ids=True).collect()
    check_pieces(out, rows, 512)


def plain_costs(position, penalty, width):
    cost = [0]
    for j in range(1, len(position)):
        gaps = [(cost[i], position[j] - position[i]) for i in range(j) if position[j] - position[i] <= width]
        cost.append(penalty[j] + min(c + (0 if g & (g - 1) == 0 else width - g) for c, g in gaps))
    return cost


def test_cuts_are_optimal():
    rng = np.random.default_rng(2)
    for _ in range(200):
        width = int(rng.choice([8, 16, 30, 64]))
        position = np.r_[0, np.cumsum(rng.integers(1, width + 1 if rng.random() < 0.5 else 5, rng.integers(1, 80)))]
        position = position[np.r_[True, np.diff(position) <= width]]
        penalty = rng.choice([0, 4, 32], len(position))
        cuts = packing.best_cuts(position, penalty, width)
        begin, cost = 0, 0
        for j in cuts:
            gap = int(position[j] - position[begin])
            assert 0 < gap <= width
            cost += int(penalty[j]) + (0 if gap & (gap - 1) == 0 else width - gap)
            begin = j
        assert cuts[-1] == len(position) - 1 and cost == plain_costs(position.tolist(), penalty.tolist(), width)[-1]


def test_packing_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = packing.pack_documents(docs, token_ids=True).collect()
    padding = check_pieces(out, [(r.doc_id, r.text) for r in docs.collect()], 4096)
    assert padding <= 0.005 * sum(p.length for p in out)


# --- 13: token alignment ----------------------------------------------------------------------

def plain_alignment(rows):
    """Whole texts through both libraries, boundary sets, all pairs."""
    import public_tokenizers as P
    import sentencepiece

    a = library("byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
    texts, counts = [], Counter()
    for i, text in rows:
        groups, pairs, ids_a, ids_b = [], [], [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            ta = [bytes(byte[c] for c in a.id_to_token(k)) for k in ids_a]
            tb = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
            if b"".join(ta) == b"".join(tb) == (" " + text).encode():
                ea, eb = np.cumsum([len(x) for x in ta]).tolist(), np.cumsum([len(x) for x in tb]).tolist()
                p = q = 0
                for end in sorted(set(ea) & set(eb)):
                    u, v = ea.index(end, p) + 1, eb.index(end, q) + 1
                    groups.append(",".join(map(str, ids_a[p:u])) + "|" + ",".join(map(str, ids_b[q:v])))
                    for x in range(p, u):
                        for y in range(q, v):
                            if ea[x] - len(ta[x]) < eb[y] and eb[y] - len(tb[y]) < ea[x]:
                                pairs.append((ids_a[x], ids_b[y]))
                    p, q = u, v
            else:
                ids_a, ids_b = [], []
        counts.update(pairs)
        texts.append((i, len(ids_a), len(ids_b), groups, pairs))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return Counter((i, m, n, len(g), len(p), sum(counts[x] == top[x[1]] for x in p), sum(counts[x] for x in p),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, m, n, g, p in texts)


ALIGN_ROWS = [(1, None), (2, ""), (3, " "), (4, "  \n x"), (5, "It's a  test,\n\n and\tmore: 12345 déjà vu 日本 😀"), (6, "a ▁ b"), (7, "<|endoftext|> </s> <0x0A>"),
              (8, "same same"), (8, "same same"), (None, "no id"), (9, "x " * 300 + "unbelievable antidisestablishmentarianism"), (10, "\x00 \x1c a\x85  b"), (11, " lead"), (12, "trail ")]


def aligned(docs, **how):
    out = token_align.align(docs, **how)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r) for r in out.collect())


def test_alignment_of_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in ALIGN_ROWS], "doc_id long, text string, n_a string, b int").repartition(3)
    want = plain_alignment(ALIGN_ROWS)
    assert aligned(docs) == want
    assert aligned(docs, broadcast_pairs=0) == want  # the way for very many pairs
    assert aligned(docs.where("doc_id = 99")) == Counter()


def test_alignment_of_random_texts(spark):
    import random

    r = random.Random(7)
    marks = ["a", "bc", "the", "é", "ß", "1", "23", ".", "!", "'s", "'", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "日", "😀", "\u0301", "\ufb00", "\x85", "\x1f", "don't", " "]
    rows = [(k, "".join(r.choice(marks) for _ in range(r.randint(0, 40)))) for k in range(1500)]
    assert aligned(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)) == plain_alignment(rows)


def test_alignment_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert aligned(docs) == plain_alignment([(r.doc_id, r.text) for r in docs.collect()])


def test_groups_come_back_as_strings(spark):
    docs = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    row = token_align.align(docs, groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 and row.groups.count(";") == row.n_groups - 1


def test_word_ids_are_learnt_as_arrays_in_any_mix():
    """Known, new, non-Latin and repeated words in one batch, with a table that is emptied on the
    way: the library's ids, and merges come as flat arrays instead of one tuple a word."""
    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    from streakflow.llm.common import tokenizer_path
    from streakflow.llm.packing import WordIds
    from streakflow.llm.token_count import proven_tokens

    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    library = Tokenizer.from_str(spec)
    ids = WordIds(spec, proven_tokens(library))
    flat, sizes = ids._merge(["hello", "zzqx"])
    assert flat.dtype == np.int32 and len(sizes) == 2 and sizes.sum() == len(flat)
    ids.table.limit = 12
    for batch in (["The cat sat.", "Ünïted привет, мир! zzqx-zzqx", ""], ["the the THE cat's 12,5 %", "日本語 text", "one two"],
                  ["one more привет zzqx-zzqx", "a\nb\tc  d", "cat."], [""], ["The cat sat."]):
        counts, got = ids(pa.array(batch))
        want = [library.encode(t, add_special_tokens=False).ids for t in batch]
        assert counts.tolist() == [len(w) for w in want] and got.tolist() == [i for w in want for i in w]
