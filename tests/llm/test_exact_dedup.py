import hashlib
from collections import defaultdict

from pairscore.llm import exact_dedup as module
from pairscore.llm.exact_dedup import exact_dedup

from .helpers import ascii_lower, counted, documents


def brute(rows, best):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[ascii_lower(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[ascii_lower(text)]
        keep = best((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(ascii_lower(text).encode()).hexdigest()))
    return out


ROWS = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "abc "), (2, "aBC"), (None, "ABC"), (None, "alone"), (8, "x" * 100_000), (9, "X" * 100_000), (10, "x" * 99_999 + "y")]


def test_matches_brute_force(spark):
    for keep, best in (("max", max), ("min", min)):
        assert counted(exact_dedup(documents(spark, ROWS), keep).collect()) == counted(brute(ROWS, best))


def test_hot_texts_are_salted_without_a_difference(spark, monkeypatch):
    monkeypatch.setattr(module, "SMALL", 10)
    monkeypatch.setattr(module, "HOT_ROWS", 20)
    monkeypatch.setattr(module, "HOT_SHARE", 0.1)
    rows = [(i, "Hot" if i % 3 else f"text {i}") for i in range(300)] + [(500, "hot")] * 90 + [(None, "HOT")] * 40 + [(None, "all null ids")] * 50
    for keep, best in (("max", max), ("min", min)):
        assert counted(exact_dedup(documents(spark, rows), keep).collect()) == counted(brute(rows, best))


def test_empty_table_and_clashing_columns(spark):
    assert exact_dedup(documents(spark, [])).collect() == []
    rows = documents(spark, [(1, "a"), (2, "A")]).selectExpr("*", "1 as norm", "2 as salt", "3 as keep_id")
    assert sorted((r.doc_id, r.keep_id) for r in exact_dedup(rows, "max").collect()) == [(1, 2), (2, 2)]
