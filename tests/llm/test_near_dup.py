import random

import numpy as np

from pairscore.llm import components as parts, near_dup
from pairscore.llm.common import Staged
from pairscore.llm.near_dup import hashed_prefix, links_within, near_duplicates, prefix_size

from .helpers import counted, documents, near_classes


def edited(words, rng, share):
    return [w if rng.random() > share else f"e{rng.randrange(10**6)}" for w in words]


def corpus(rng):
    passage = [f"p{i}" for i in range(60)]
    rows, i = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.choice([1, 2, 6])):
            rows.append((i, " ".join(edited(base, rng, rng.choice([0, 0.01, 0.02, 0.05])))))
            i += 1
        rows.append((i, " ".join(base + passage)))
        i += 1
    hub = [f"h{j}" for j in range(150)]
    rows += [(i + j, " ".join(edited(hub, rng, 0.02))) for j in range(60)]
    return rows


def test_components_match_brute_force(spark):
    for seed in range(3):
        rows = corpus(random.Random(seed))
        got = near_duplicates(documents(spark, rows)).collect()
        want = [(d, *x) for (d, _), x in zip(rows, near_classes(rows))]
        assert sorted(map(tuple, got)) == sorted(want)


def test_nulls_short_texts_and_repeats(spark):
    rows = [(5, "A b c"), (3, "a  B\tc"), (9, ""), (8, None), (7, " \n "), (5, "A b c"), (None, "a b c"), (4, "a b"), (6, "É b c"), (2, "é b c")]
    got = near_duplicates(documents(spark, rows)).collect()
    want = [(5, 1, 3), (3, 1, 3), (9, 0, 9), (8, 0, 8), (7, 0, 7), (5, 1, 3), (None, 1, 3), (4, 1, 4), (6, 1, 6), (2, 1, 2)]
    assert counted(got) == counted(want)


def test_empty_table_and_clashing_columns(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    rows = documents(spark, [(1, "a b c d e f"), (2, "a b c d e f")]).selectExpr("*", "1 as node", "2 as root", "3 as gram", "4 as size")
    assert sorted(map(tuple, near_duplicates(rows).collect())) == [(1, 2, 1), (2, 2, 1)]


def test_links_connect_what_is_similar():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 190, replace=False), rng.integers(0, 2**63, 5, dtype=np.uint64)])) for _ in range(80)]
    parent = list(range(80))
    for a, b in links_within(sets, sets, 80):
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)
        parent = [parent[a] if p == parent[b] else p for p in parent]
    for a in range(80):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                assert parent[a] == parent[b]


def test_large_classes_are_verified_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "TASK", 1_000)
    rng = random.Random(7)
    rows = corpus(rng) + [(1000 + j, " ".join(edited([f"k{i}" for i in range(200)], rng, 0.005 * (j % 5)))) for j in range(40)]
    got = near_duplicates(documents(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted((d, *x) for (d, _), x in zip(rows, near_classes(rows)))


def test_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK", 30_000)
    rng = random.Random(8)
    long = [f"w{rng.randrange(50_000)}" for _ in range(120_000)]
    rows = [(3, " ".join(long)), (2, " ".join(edited(long, rng, 0.01))), (1, " ".join(long[:100_000])), (4, "x" * 500_000), (5, "x" * 500_000 + " y")]
    got = near_duplicates(documents(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted((d, *x) for (d, _), x in zip(rows, near_classes(rows)))


def test_similar_sets_share_a_prefix_under_every_order():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(5, 200))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.08], rng.integers(0, 2**63, n // 12, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        for seed in near_dup.ORDERS:
            x, y = hashed_prefix(a, seed, 80), hashed_prefix(b, seed, 80)
            assert len(x) == min(len(a), prefix_size(len(a), 80))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert len(np.intersect1d(x, y))


def test_components_of_stars_and_paths(spark, monkeypatch):
    monkeypatch.setattr(parts, "HUB", 10)
    rng = random.Random(2)
    edges = [(0, i) for i in range(1, 200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 60)] + [(2059, 5)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in parts.components(spark.createDataFrame(edges, "u long, v long").repartition(7), Staged(spark)).collect()}
    assert got == {**{i: 0 for i in range(1, 200)}, **{2000 + i: 0 for i in range(60)}, **{1001 + i: 1000 for i in range(60)}}
