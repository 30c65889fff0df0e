"""Matching many rows at once, while keys are numbers."""

import random

import numpy as np
from pyspark.sql import functions as F

from pairscore.operators import evaluate as ev
from pairscore.plans import queries
from pairscore.schemas import ENTITY


def keyed(rows):
    items = [keys for row in rows for keys in row]
    return ev._Keyed(*(np.array(x, dtype=np.int64) for x in (
        [r for r, row in enumerate(rows) for _ in row], [i for i, keys in enumerate(items) for _ in keys], [k for keys in items for k in keys])))


def test_many_rows_as_row_by_row(monkeypatch):
    rng, calls = random.Random(3), []
    one = ev.first_free
    monkeypatch.setattr(ev, "first_free", lambda a, b: calls.append(1) or one(a, b))
    side = lambda n, k: [rng.sample(range(k), rng.randint(0, 2)) for _ in range(n)]
    rows = [(side(rng.randint(0, 6), k), side(rng.randint(0, 6), k)) for k in (2, 3, 5, 9, 60) for _ in range(60)]
    rows += [([[i, 900 + i] for i in range(9)], [[i] for i in range(8, -1, -1)])] * 5 + [([], []), ([[1]] * 300, [[1]] * 200)]
    found = ev.matched(*(keyed(x) for x in zip(*rows)), len(rows)).tolist()
    assert found == [j for a, b in rows for j in one(a, b)]
    assert 0 < len(calls) < len(rows) / 1.2  # rows without rivals are matched together


def test_no_rows_and_no_keys():
    assert ev.matched(keyed([]), keyed([]), 0).tolist() == [] and ev.matched(keyed([[[], []]]), keyed([[]]), 1).tolist() == [-1, -1]


def test_pairs_are_scored_as_prepared_lists(spark):
    rng = random.Random(5)
    names = ["A", "a", "B", "Ｂ", "C", " ", "D"]

    def entity():
        pick = lambda n: [rng.choice(names) for _ in range(rng.randint(0, n))]
        links = [(rng.choice(["携带", "near", "位于"]), rng.choice([*names, "", None])) for _ in range(rng.randint(0, 3))]
        return (rng.choice(names), rng.choice(["x", "y"]), pick(3), {k: rng.choice(names) for k in pick(2)}, links, [])

    rows = [(i, *([entity() for _ in range(rng.randint(0, 5))] for _ in "ab")) for i in range(120)]
    given = spark.createDataFrame(rows, f"id int, a array<{ENTITY}>, b array<{ENTITY}>")
    apart = ev.score_lists(given.select("id", ev.prepared(F.col("a")).alias("ref"), ev.prepared(F.col("b")).alias("pred")))
    both = ev.score_lists(given.select("id", ev.prepared_pair(F.col("a"), F.col("b")).alias("x")).select("id", "x.*"))
    told = lambda df: df.select("id", "ref", "pred", "entity_match", "relation_match", *ev.LEVELS, "errors").orderBy("id").collect()
    assert told(both) == told(apart)


def test_scores_try_no_pairs_of_keys(spark):
    plan = queries.evaluated(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_overlap" not in plan and "array_contains" not in plan
