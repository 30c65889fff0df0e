import numpy as np
from pyspark.sql import functions as F

from pairscore.llm.ann import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    order = np.lexsort((ids, d))
    return [(int(ids[i]), float(d[i])) for i in order if ids[i] != ids[q]][:k]


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 32))
    x = np.concatenate([centres[rng.integers(0, 40, 1500)] + 0.05 * rng.standard_normal((1500, 32)), rng.standard_normal((1500, 32))])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    ids = np.arange(len(x))
    rows = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)], SCHEMA)
    got = nearest(rows, F.col("vec_id") % 100 == 0).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    x = x.astype(np.float64)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in exact(ids, x, q)}) for q in range(0, 3000, 100))
    assert hits / 300 >= 0.9
    for q, list_ in found.items():
        assert len(list_) == 10 and list_ == sorted(list_, key=lambda p: (p[1], p[0]))
        for i, score in list_:
            assert abs(score - np.sqrt(((x[i] - x[q]) ** 2).sum())) < 1e-12


def test_copies_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], 0) for i in range(30)] + [(100, [1.0, 2.0], 0), (200, None, 0), (300, [0.0, 0.0], 0), (400, [nan, 1.0], 0), (500, [inf, 1.0], 0), (600, [None, 1.0], 0), (None, [1.0, 2.0], 0), (7, [1.0, 2.0], 0), (700, [], 0)]
    got = nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, block=8).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert by_query == {0: [(i, i, 0.0) for i in range(1, 11)], 100: [(i + 1, i, 0.0) for i in range(10)]}


def test_fewer_than_k_and_empty(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.9, 0.1], 0)], SCHEMA).withColumn("key", F.lit(1)).withColumn("v", F.lit(2))
    assert [(r.query_id, r.rank, r.vec_id) for r in nearest(rows, F.col("vec_id") == 0).collect()] == [(0, 1, 1)]
    assert nearest(rows.limit(0), F.col("vec_id") == 0).collect() == []


def test_short_lists_are_completed(spark):
    few = [(i, [float(10 ** (i % 5)), float((-3) ** i)], 0) for i in range(8)]  # fewer candidates than k, far apart
    got = nearest(spark.createDataFrame(few, SCHEMA), F.lit(True)).collect()
    x = np.array([v for _, v, _ in few])
    for q in range(8):
        list_ = [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q]
        assert [i for i, _ in list_] == [i for i, _ in exact(np.arange(8), x, q)]
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.standard_normal((400, 16)) * 0.01, rng.standard_normal((1, 16)) * 50])  # the last one stands alone
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))], SCHEMA)
    got = nearest(rows, F.col("vec_id") == 400, block=150).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [i for i, _ in exact(np.arange(401), x.astype(np.float32).astype(np.float64), 400)]


def test_scattered_vectors_get_whole_lists(spark):
    """A few far-out vectors among many: no query may come back with fewer than k."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 24))
    x[rng.choice(3000, 150, replace=False)] *= 6
    for kind in ("float", "double"):
        rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], f"vec_id long, embedding array<{kind}>, label int")
        got = nearest(rows, F.col("vec_id") % 100 == 0, block=400).collect()
        held = x if kind == "double" else x.astype(np.float32).astype(np.float64)
        hits = 0
        for q in range(0, 3000, 100):
            list_ = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
            assert [r for r, _, _ in list_] == list(range(1, 11))
            assert all(abs(s - np.sqrt(((held[i] - held[q]) ** 2).sum())) < 1e-12 for _, i, s in list_)
            hits += len({i for _, i, _ in list_} & {i for i, _ in exact(np.arange(3000), held, q)})
        assert hits / 300 >= 0.9
