import math
import zlib
from collections import Counter

import numpy as np

from pairscore.llm.bpe import encoder
from pairscore.llm.common import Staged
from pairscore.llm.packing import B, K1, Index, Statistics, corpus_statistics, fill_windows, pack, tokens
from pairscore.llm.queries import tokenizer_path

from .helpers import documents


def padding(sequences, window):
    total = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window
        total += 0 if at & (at - 1) == 0 else window - at
    return total


def test_each_token_once_and_no_padding():
    rng = np.random.default_rng(0)
    for _ in range(60):
        docs = [rng.integers(0, 300, rng.integers(1, int(rng.choice([5, 60, 700])))).astype("<u4") for _ in range(rng.integers(1, 60))]
        window = int(rng.choice([16, 64, 128]))
        seen, sequences = [np.zeros(len(d), int) for d in docs], {}
        for doc, start, length, sequence, offset in fill_windows(docs, window):
            seen[doc][start : start + length] += 1
            sequences.setdefault(sequence, []).append((offset, length))
        assert all((s == 1).all() for s in seen)
        assert padding(sequences, window) == 0


def test_neighbours_share_a_window():
    topic = lambda k, n: np.arange(100 * k, 100 * k + n, dtype="<u4")
    docs = [topic(1, 50), topic(2, 50), topic(3, 50), topic(2, 40), topic(1, 40), topic(3, 40)]
    first = {}
    for doc, _, _, sequence, _ in fill_windows(docs, 90):
        first.setdefault(sequence, set()).add(doc)
    assert first == {0: {0, 4}, 1: {1, 3}, 2: {2, 5}}


def test_pieces_hold_the_documents_tokens(spark):
    rows = [(1, "some words here"), (1, "some words here"), (2, None), (None, "x"), (3, "long text of words " * 3000), *((i, f"text number {i}") for i in range(10, 60))]
    got = pack(documents(spark, rows).selectExpr("*", "1 as shard"), tokenizer_path(), shard_tokens=5_000).collect()
    enc, sequences, left = encoder(tokenizer_path()), {}, {}
    tokens = {}
    for doc_id, text in rows:
        tokens[doc_id] = np.frombuffer(enc.encode(text) + b"\2\0\0\0", "<u4")
        left[doc_id] = left.get(doc_id, 0) + len(tokens[doc_id])
    for r in got:
        ids = tokens[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        left[r.doc_id] -= r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert not any(left.values()) and padding(sequences, 4096) == 0
    assert pack(documents(spark, []), tokenizer_path()).collect() == []


def test_scores_are_bm25_of_the_whole_corpus():
    rng = np.random.default_rng(3)
    corpus = [rng.zipf(1.5, rng.integers(1, 80)).clip(max=60).astype("<u4") for _ in range(60)]
    own, all_ = corpus[:25], [Counter(d.tolist()) for d in corpus]
    df = Counter(t for d in all_ for t in d)
    mean = sum(map(len, corpus)) / len(corpus)

    def bm25(q, d):
        total = 0.0
        for t in all_[q]:
            idf = math.log((len(corpus) - df[t] + 0.5) / (df[t] + 0.5))
            if idf > 0 and all_[d][t]:
                total += idf * all_[d][t] * (K1 + 1) / (all_[d][t] + K1 * (1 - B + B * len(corpus[d]) / mean))
        return total

    index = Index(own, Statistics.of(corpus))
    for q in range(25):
        assert np.allclose(np.delete(index.scores(q), q), [bm25(q, d) for d in range(25) if d != q])


def test_windows_are_filled_greedily_by_score():
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 40, rng.integers(1, 30)).astype("<u4") for _ in range(40)]
    index, unused, want = Index(docs), set(range(40)), []
    doc, start, room, sequence = 0, 0, 64, 0
    while unused:  # a window: the seed's rest, then the nearest unused documents, ties to the earlier one
        if doc is None:
            doc, start = min(unused), 0
        unused.discard(doc)
        want.append((doc, start, len(docs[doc]) - start, sequence, 0))
        room, seed, doc = 64 - (len(docs[doc]) - start), doc, None
        for near in sorted(unused, key=lambda d: (-index.scores(seed)[d], d)):
            if not room:
                break
            take = min(room, len(docs[near]))
            want.append((near, 0, take, sequence, 64 - room))
            unused.discard(near)
            room -= take
            if take < len(docs[near]):
                doc, start = near, take
        if not room:
            sequence += 1
    got = [p for p in fill_windows(docs, 64) if p[3] < sequence]
    assert got == [p for p in want if p[3] < sequence]


def test_statistics_count_all_documents(spark):
    rows = [(i, text) for i, text in enumerate(["a b a", "b c", None, "", "c c c d", "b"] * 7)]
    found = tokens(documents(spark, rows).repartition(5), tokenizer_path(), Staged(spark))
    got, enc = corpus_statistics(found), encoder(tokenizer_path())
    lists = [np.frombuffer(enc.encode(t) + b"\2\0\0\0", "<u4") for _, t in rows]
    want = Statistics.of(lists)
    assert got.n == want.n == 42 and abs(got.mean - want.mean) < 1e-9
    assert (got.df[: len(want.df)] == want.df).all() and not got.df[len(want.df) :].any()


def test_near_copies_share_a_shard_and_copies_are_spread(spark):
    rng = np.random.default_rng(6)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (3000, 6))]
    rows = []
    for i in range(120):
        text = [words[j] for j in rng.integers(0, 3000, 150)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(text[:-1]))]
    rows += [(1000 + i, "one text that very many rows have " * 20) for i in range(300)]
    got = pack(documents(spark, rows), tokenizer_path(), shard_tokens=20_000).collect()
    shard = {r.doc_id: r.sequence_id >> 20 for r in got if r.start == 0}
    assert len(set(shard.values())) > 8
    assert sum(shard[2 * i] == shard[2 * i + 1] for i in range(120)) > 90
    assert len({shard[1000 + i] for i in range(300)}) > 1
