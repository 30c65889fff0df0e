"""Language identification: counts and mixtures against plain Python, accuracy on held-out documents."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from pairscore.llm import language_id as li

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string"


def words_of(text):
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


def test_counts_are_of_whole_texts_in_any_blocks(monkeypatch):
    text = "Über den Wolken, l'été; x  y\n\nzz 3 Ж😀 end"
    whole = li.gram_counts(text)
    words = words_of(text)
    # letters, pairs with both bounds, triples around each letter
    assert whole.sum() == sum(len(w) + len(w) + 1 + len(w) for w in words)
    for block in (1, 2, 3, 7):
        monkeypatch.setattr(li, "_BLOCK", block)
        assert (li.gram_counts(text) == whole).all()
    assert li.gram_counts(None).sum() == li.gram_counts("").sum() == li.gram_counts("12 !? 😀").sum() == 0


def test_same_grams_same_buckets():
    once, more = li.gram_counts("abc de"), li.gram_counts("de... ABC, de; abc")
    assert (more == 2 * once).all()
    assert (li.gram_counts("abc") != li.gram_counts("acb")).any()


def test_mixture_against_plain_python():
    rnd = np.random.default_rng(3)
    chance = rnd.dirichlet(np.ones(30), size=3).T
    counts = rnd.integers(0, 20, 30).astype(float)
    share = [1 / 3] * 3
    for _ in range(400):
        sums = [0.0] * 3
        for g in range(30):
            mix = sum(share[k] * chance[g, k] for k in range(3))
            for k in range(3):
                sums[k] += counts[g] * share[k] * chance[g, k] / mix
        share = [x / counts.sum() for x in sums]
    got = li.mixture(chance, counts, np.full(3, 1 / 3), rounds=400, settled=0)
    assert np.allclose(got, share, atol=1e-9)
    likelihood = lambda s: counts @ np.log(chance @ s)
    assert all(likelihood(got) >= likelihood(rnd.dirichlet(np.ones(3))) - 1e-9 for _ in range(200))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return li.fit_languages(documents)


def test_accuracy_on_held_out_documents(documents, model):
    from pyspark.sql import functions as F

    held = documents.where((li.fold(F.col("doc_id")) == li.HELD_OUT) & F.col("text").rlike("[A-Za-z]"))
    rows = li.identify(held, model, ["doc_id", "lang"]).collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.99
    assert all(0 < r.score <= 1 and abs(sum(x.share for x in r.languages) - 1) < 1e-3 for r in rows)


def test_sets_of_languages(spark, documents, model):
    """Two documents of different languages in one text: both are found, in about their proportions; one alone stays alone."""
    from pyspark.sql import functions as F

    by = {lang: [r.text for r in documents.where((F.col("lang") == lang) & (F.length("text") > 1500)).orderBy("doc_id").limit(8).collect()] for lang in ("en", "de", "fr", "es")}
    rnd, rows, want = random.Random(1), [], {}
    for i in range(24):
        a, b = rnd.sample(sorted(by), 2)
        text = rnd.choice(by[a])[:900] + "\n" + rnd.choice(by[b])[:600]
        rows.append((i, text, None, None))
        want[i] = (a, b)
    found = {r.doc_id: r for r in li.identify(spark.createDataFrame(rows, DOCS), model).collect()}
    assert sum({x.lang for x in found[i].languages} == set(want[i]) for i in want) >= 22
    assert sum(found[i].lang_pred == want[i][0] for i in want) >= 22
    alone = [(i, t, None, None) for i, t in enumerate(t for texts in by.values() for t in texts)]
    assert sum(len(r.languages) == 1 for r in li.identify(spark.createDataFrame(alone, DOCS), model).collect()) >= 0.9 * len(alone)


def test_held_out_and_unlabelled_rows_teach_nothing(spark, documents, model):
    from pyspark.sql import functions as F

    wrong = documents.where(li.fold(F.col("doc_id")) == li.HELD_OUT).withColumn("lang", F.lit("en"))
    more = documents.where(li.fold(F.col("doc_id")) != li.HELD_OUT).unionByName(wrong)
    more = more.unionByName(documents.withColumn("lang", F.lit(None).cast("string"))).unionByName(documents.withColumn("doc_id", F.lit(None).cast("long")))
    again = li.fit_languages(more)
    assert again.languages == model.languages and (again.chance == model.chance).all()


def test_counts_of_the_model(spark):
    docs = spark.createDataFrame([(0, "aa b", "x", "s"), (1, "b", "y", "s"), (3, None, "y", "s"), (5, "b", "", "s")], DOCS)
    ids = [r.doc_id for r in docs.where(li.fold(docs["doc_id"]) != li.HELD_OUT).collect()]
    texts = {0: ("x", "aa b"), 1: ("y", "b"), 5: ("", "b")}
    learned = [texts[i] for i in ids if i in texts]
    model = li.fit_languages(docs)
    assert model.languages == sorted({lang for lang, _ in learned})
    for k, lang in enumerate(model.languages):
        seen = sum(li.gram_counts(t) for own, t in learned if own == lang)
        assert np.allclose(model.chance[:, k], (seen + 0.05) / (seen.sum() + 0.05 * li.BUCKETS))


def test_odd_texts(spark, model):
    rows = [(1, None, "en", "s"), (2, "", "en", "s"), (3, " 12 -- 😀", "en", "s"), (None, "the", "en", "s"), (4, "der und die " * 60_000, "en", "s"), (5, "the", "en", "s"), (5, "the", "en", "s")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS score0", "2 AS languages0")
    found = Counter((r.doc_id, r.lang_pred) for r in li.identify(docs, model).collect())
    assert found == Counter({(1, "und"): 1, (2, "und"): 1, (3, "und"): 1, (None, "en"): 1, (4, "de"): 1, (5, "en"): 2})


def test_nothing_learned(spark):
    empty = spark.createDataFrame([], DOCS)
    model = li.fit_languages(empty)
    assert model.languages == [] and li.identify(empty, model).collect() == []
    assert [tuple(r) for r in li.identify(spark.createDataFrame([(1, "text", None, None)], DOCS), model).collect()] == [(1, "und", 0.0, [])]


def test_one_language(spark):
    rows = [(i, "only words", "zz", "s") for i in range(8)]
    docs = spark.createDataFrame(rows, DOCS)
    assert {(r.lang_pred, r.score) for r in li.identify(docs, li.fit_languages(docs)).collect()} == {("zz", 1.0)}


def test_bound_on_languages(spark):
    rows = [(i, "word", f"l{i % 5}" if i % 7 else "common", "s") for i in range(40)]
    model = li.fit_languages(spark.createDataFrame(rows, DOCS), max_languages=2)
    assert len(model.languages) == 2 and math.isclose(model.chance.sum(), 2)


def test_many_languages_are_all_learned_and_handed_on_in_parts(spark, monkeypatch):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)} x{chr(0x430 + i % 32)}", f"l{i % 100:03d}", "s") for i in range(800)]
    docs = spark.createDataFrame(rows, DOCS)
    whole = li.fit_languages(docs)
    monkeypatch.setattr(li, "HELD_AT_ONCE", 3)
    parts = li.fit_languages(docs)
    assert whole.languages == parts.languages == [f"l{i:03d}" for i in range(100)]
    assert (whole.chance == parts.chance).all()
