import zlib

import numpy as np
from pyspark.sql import functions as F

from pairscore.llm.common import table
from pairscore.llm.quality import FEATURES, fit_forest, fit_quality, fold, score_quality, statistics

from .helpers import documents

SF = "/root/testdata/sf0.01"


def test_forest_learns_and_ties_are_harmless():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 5))
    x[:, 4] = 1.0
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0)).astype(float)
    forest = fit_forest(x[:1500], y[:1500])
    assert ((forest.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert fit_forest(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3
    assert (fit_forest(x, np.ones(2000)).score(x[:3]) > 0.9).all()


def test_statistics_of_any_text():
    for text in (None, "", " ", "\n\n", "x" * 100_000, "\x00￿😀", "a | b | c"):
        values = statistics(text)
        assert len(values) == len(FEATURES) and np.isfinite(values).all()


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = score_quality(docs, fit_quality(docs, labels)).join(labels, "doc_id").withColumn("fold", fold(F.col("doc_id")))
    held = [r for r in scored.collect() if r.fold == 0]
    assert all(r.fold == zlib.crc32(str(r.doc_id).encode()) % 5 for r in held)
    assert sum((r.score >= 0.3) == bool(r.quality) for r in held) / len(held) > 0.93


def test_odd_rows(spark):
    rows = documents(spark, [(1, None), (1, None), (None, ""), (2, "words " * 20_000)]).selectExpr("*", "1 as score", "2 as label")
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 0, 0), (2, 0, 0), (2, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    got = score_quality(rows, fit_quality(rows, labels)).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert score_quality(documents(spark, []), fit_quality(rows, labels.limit(0))).collect() == []


def test_the_sample_is_of_labels_with_a_document(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    strangers = spark.range(10**6, 10**6 + 5000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "0 as toxic")
    few = labels.where("quality is not null").count() // 2
    both = [fit_quality(docs, x, sample_rows=few) for x in (labels, labels.unionByName(strangers, allowMissingColumns=True))]
    assert len(both[0].roots) > 0 and (both[0].threshold == both[1].threshold).all() and (both[0].value == both[1].value).all()


def slow_forest(x, y, trees, depth, rate, bins, l2, least):
    """The same trees grown row by row and node by node, and scored by walking each."""
    edges = [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).tolist())) for j in range(x.shape[1])]
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)

    def grow(rows, d, g, h):
        leaf = rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + l2)
        best = (1e-6, None)
        for j in range(x.shape[1] if d < depth else 0):
            for e in edges[j]:
                left, right = [i for i in rows if x[i, j] <= e], [i for i in rows if x[i, j] > e]
                gl, hl, gr, hr = (sum(v[i] for i in side) for side in (left, right) for v in (g, h))
                if hl >= least and hr >= least:
                    gain = gl * gl / (hl + l2) + gr * gr / (hr + l2) - (gl + gr) ** 2 / (hl + hr + l2)
                    if gain > best[0] + 1e-12:
                        best = (gain, (j, e, left, right))
        if best[1] is None:
            return leaf
        j, e, left, right = best[1]
        return (j, e, grow(left, d + 1, g, h), grow(right, d + 1, g, h))

    def walk(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(list(range(len(y))), 0, y - p, p * (1 - p))
        margin = margin + np.array([walk(tree, row) for row in x])
    return 1 / (1 + np.exp(-margin))


def test_forest_is_the_slow_one():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((120, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.3 * rng.standard_normal(120) > 0.2).astype(float)
    form = dict(trees=3, depth=3, rate=0.3, bins=8, l2=2.0, least=2.0)
    assert np.allclose(fit_forest(x, y, **form).score(x), slow_forest(x, y, **form), atol=1e-9)


def test_repeated_ids_give_one_row_however_rows_are_dealt(spark):
    """Ids on rows of different texts: the forest does not depend on the order or the partitions of the rows."""
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    other = docs.selectExpr("doc_id", "concat(text, ' ', repeat('zz# ', cast(doc_id % 7 AS int)))  AS text")
    both = docs.select("doc_id", "text").unionByName(other).unionByName(docs.selectExpr("doc_id", "CAST(NULL AS string) AS text").where("doc_id % 3 = 0"))
    forests = [fit_quality(x, labels) for x in (both, both.repartition(13), both.orderBy("text").coalesce(1), both.unionByName(both))]
    assert len(forests[0].roots) > 0
    assert all((f.threshold == forests[0].threshold).all() and (f.value == forests[0].value).all() for f in forests[1:])
