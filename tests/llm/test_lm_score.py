import math
import random
import zlib
from collections import Counter

import numpy as np
import xxhash

from pairscore.llm import lm_score as module
from pairscore.llm.lm_score import BUCKETS, fit_weights, lm_score

from .helpers import documents


def tokens(text):
    return (text or "").encode().lower().split() + [b"\0end"]


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 if doc_id is not None else 0


def corpus():
    rng = random.Random(5)
    follow = {w: [f"w{rng.randrange(60)}" for _ in range(3)] for w in (f"w{i}" for i in range(60))}
    rows = []
    for i in range(400):
        w = [f"w{rng.randrange(60)}"]
        for _ in range(rng.randrange(1, 60)):
            w.append(rng.choice(follow.get(w[-1], ["w0"])) if rng.random() < 0.8 else f"r{rng.randrange(500)}")
        rows.append((i, " ".join(w)))
    return [*rows, (1000, None), (1001, ""), (None, "W1 w2"), (3, rows[3][1])]


def test_base_is_exact_and_model_is_better_and_matches_brute_force(spark, monkeypatch):
    rows = corpus()
    got = lm_score(documents(spark, rows).selectExpr("*", "1 as fold", "2 as chunk", "3 as p")).collect()
    assert len(got) == len(rows)
    counts, pairs = Counter(), Counter()
    for d, t in rows:
        if fold(d) != 1:
            w = tokens(t)
            counts.update(w)
            pairs.update(zip([b"\0end", *w], w))
    n, v = sum(counts.values()), len(counts)
    by_id = {}
    for r in got:
        by_id[r.doc_id] = r
    base = lambda w: math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1)))
    for d, t in rows:
        r, w = by_id[d], tokens(t)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), sum(counts[x] > 0 for x in w), n, fold(d) == 1)
        assert math.isclose(r.base_score, sum(map(base, w)), rel_tol=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)  # both below 0
    # the model itself, with weights learned by the same rule from plain counts
    fit, deleted, words = Counter(), Counter(), Counter()
    for d, t in rows:
        w = tokens(t)
        if fold(d) in (0, 3, 4):
            fit.update(zip([b"\0end", *w], w))
            words.update(w)
        elif fold(d) == 2:
            deleted.update(zip([b"\0end", *w], w))
    bucket = lambda c: 0 if c == 0 else min(int(math.log2(c)) + 1, BUCKETS - 1)
    n_fit = sum(words.values())
    rough = lambda x: 2 ** (round(4 * math.log2(x)) / 4) if x > 0 else 0.0
    events = [(bucket(words[a]), rough(fit[a, b] / max(words[a], 1)), rough(words[b] / n_fit), c) for (a, b), c in deleted.items()]
    weights = fit_weights(*map(np.array, list(zip(*events))[:3]), 1 / (v + 1), np.array([e[3] for e in events], float))
    for d, t in rows[:50]:
        w, total = tokens(t), 0.0
        for a, b in zip([b"\0end", *w], w):
            lam = weights[bucket(counts[a])]
            total += math.log10(lam[0] * pairs[a, b] / max(counts[a], 1) + lam[1] * counts[b] / n + lam[2] / (v + 1))
        assert math.isclose(by_id[d].score, total, rel_tol=1e-6)


def test_many_small_chunks_and_shards_give_the_same(spark, monkeypatch):
    rows = corpus()
    whole = {r.doc_id: r for r in lm_score(documents(spark, rows)).collect()}
    monkeypatch.setattr(module, "SHARD", 500)
    for r in lm_score(documents(spark, rows)).collect():
        assert math.isclose(r.score, whole[r.doc_id].score, rel_tol=1e-9) and r.n_known == whole[r.doc_id].n_known


def test_empty_table(spark):
    assert lm_score(documents(spark, [])).collect() == []


def test_weights_are_distributions():
    weights = fit_weights(np.array([1, 1, 3]), np.array([0.5, 0.0, 0.2]), np.array([0.1, 0.1, 0.0]), 0.01, np.array([5.0, 2.0, 1.0]))
    assert np.allclose(weights.sum(axis=1), 1) and (weights >= 0).all()


def test_scores_follow_an_independent_model(spark):
    """Counts, buckets and expectation-maximisation written anew, from the definition and without bins."""
    rows = corpus()
    train = [(d, tokens(t)) for d, t in rows if fold(d) != 1]
    kept = [w for d, w in train if fold(d) != 2]
    grams = lambda lists: Counter(g for w in lists for g in zip([b"\0end", *w], w))
    some, all_ = (Counter(x for w in lists for x in w) for lists in (kept, [w for _, w in train]))
    some_pairs, all_pairs, held = grams(kept), grams([w for _, w in train]), grams([w for d, w in train if fold(d) == 2])
    n_some, n_all, floor = sum(some.values()), sum(all_.values()), 1 / (len(all_) + 1)
    octave = lambda c: len(bin(c)) - 2 if c else 0
    parts = lambda pairs, single, n, a, b: (pairs[a, b] / single[a] if single[a] else 0.0, single[b] / n, floor)
    mix = {}
    for o in range(24):
        events = [(parts(some_pairs, some, n_some, a, b), c) for (a, b), c in held.items() if octave(some[a]) == o]
        lam = [1 / 3] * 3 if o else [0, 0.5, 0.5]
        for _ in range(400 if events else 0):
            sums = [0.0] * 3
            for p, c in events:
                total = sum(x * y for x, y in zip(lam, p))
                for i in range(3):
                    sums[i] += c * lam[i] * p[i] / total
            lam = [x / sum(sums) for x in sums]
        mix[o] = lam if events else mix.get(o - 1, lam)
    got = {r.doc_id: r.score for r in lm_score(documents(spark, rows)).collect()}
    for d, t in rows:
        w = tokens(t)
        want = sum(math.log10(sum(x * y for x, y in zip(mix[octave(all_[a])], parts(all_pairs, all_, n_all, a, b)))) for a, b in zip([b"\0end", *w], w))
        assert math.isclose(got[d], want, rel_tol=0.01, abs_tol=0.02), (d, got[d], want)


def test_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK", 20_000)
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(150_000))
    rows = [(1, long), (2, long), (3, "x" * 300_000), (4, "w1 w2")]
    got = {r.doc_id: r for r in lm_score(documents(spark, rows)).collect()}
    assert [got[i].n_tokens for i in (1, 2, 3, 4)] == [150_001, 150_001, 2, 3]
    assert math.isclose(got[1].base_score, got[2].base_score, rel_tol=1e-9) and math.isclose(got[1].score, got[2].score, rel_tol=1e-9)


def hot_pair_corpus():
    """Documents of which every fifth token is the second word of one pair."""
    rng = random.Random(8)
    return [(i, " ".join(x for _ in range(40) for x in ("hot", "pair", *(f"w{rng.randrange(4000)}" for _ in range(3))))) for i in range(600)]


def test_rows_of_a_hot_pair_stay_with_their_chunks(spark, monkeypatch):
    rows = hot_pair_corpus()
    monkeypatch.setattr(module, "CHUNK", 8_000)
    docs = module._folded(documents(spark, rows))
    none, shards = np.zeros(0, np.uint64), 60
    wide = np.array([xxhash.xxh3_64_intdigest(b"hot")], np.uint64)  # its contexts differ, and so they are dealt
    n = sum(len(tokens(t)) for _, t in rows)

    def largest():
        sizes = module._bigrams(docs, shards, none, wide).selectExpr("p", "coalesce(octet_length(rows), 0) / 2 as n").groupBy("p").sum("n").collect()
        return max(r[1] for r in sizes)

    assert largest() < 4 * n / shards
    monkeypatch.setattr(module, "LEAST_NEAR", 1 << 31)
    assert largest() > n / 6  # as without the rule


def test_a_hot_pair_is_scored_the_same_wherever_its_rows_are(spark, monkeypatch):
    rows = [*((d + 2000, t) for d, t in hot_pair_corpus()), *corpus()[:-1]]
    monkeypatch.setattr(module, "CHUNK", 8_000)
    monkeypatch.setattr(module, "SHARD", 2_000)
    near = {r.doc_id: r for r in lm_score(documents(spark, rows)).collect()}
    monkeypatch.setattr(module, "LEAST_NEAR", 1 << 31)
    far = {r.doc_id: r for r in lm_score(documents(spark, rows)).collect()}
    assert near.keys() == far.keys()
    for d in near:
        assert math.isclose(near[d].score, far[d].score, rel_tol=1e-9) and math.isclose(near[d].base_score, far[d].base_score, rel_tol=1e-9)
        assert (near[d].n_known, near[d].n_tokens) == (far[d].n_known, far[d].n_tokens)
