import zlib

import numpy as np

import corpus_pipeline
from pairscore.llm import common
from pairscore.llm.bpe import encoder
from pairscore.llm.common import table
from pairscore.llm.queries import KEEP_SCORE, tokenizer_path
from pairscore.llm.quality import fit_quality, score_quality

from .helpers import ascii_lower, documents, near_classes

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    scores = {r.doc_id: r.score for r in score_quality(docs, fit_quality(docs, table(spark, SF, "labels"))).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id] >= KEEP_SCORE)
    last = {}
    for doc_id, text in rows:
        last[ascii_lower(text)] = doc_id
    rows = [(d, t) for d, t in rows if last[ascii_lower(t)] == d]
    rows = [(d, t) for (d, t), (_, smallest) in zip(rows, near_classes(rows)) if smallest == d]
    got = corpus_pipeline.run(spark, SF).collect()
    enc, left = encoder(tokenizer_path()), {}
    for doc_id, text in rows:
        left[doc_id] = np.frombuffer(enc.encode(text) + b"\2\0\0\0", "<u4")
    sizes = {d: len(x) for d, x in left.items()}
    assert {r.doc_id for r in got} == set(left)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(left[r.doc_id][r.start : r.start + r.length].tobytes())
        sizes[r.doc_id] -= r.length
    assert not any(sizes.values())


def test_stages_keep_the_columns_and_odd_rows(spark):
    docs = table(spark, SF, "documents").limit(30)
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (None, "a b c d e f", "en", "s", 11)], docs.schema)
    docs = docs.union(odd).union(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.count() > 0
    assert corpus_pipeline.exact(spark, odd.union(odd), SF).count() == 2  # the empty texts are equal; one row each stays
    assert corpus_pipeline.near(spark, docs.limit(0), SF).count() == 0


def test_near_copies_with_repeated_or_null_ids(spark):
    copy = lambda k, end: " ".join(f"{k}{i}" for i in range(60)) + end
    rows = [
        (1, copy("a", "")), (2, copy("a", " x")), (2, copy("b", "")),  # the second row of 2 is clean
        (3, copy("c", "")), (3, copy("c", " y")), (4, copy("c", " z")),
        (None, copy("d", "")), (None, copy("d", " x")), (None, copy("e", "")), (5, copy("e", " x")),
        (6, copy("f", "")), (6, copy("f", "")), (7, ""), (8, None),
    ]
    got = sorted(((r.doc_id, (r.text or "")[:1]) for r in corpus_pipeline.near(spark, documents(spark, rows), SF).collect()), key=str)
    assert got == sorted([(1, "a"), (2, "b"), (3, "c"), (None, "d"), (5, "e"), (6, "f"), (7, ""), (8, "")], key=str)


def test_clashing_columns(spark):
    """Columns of the table with the names that stages use themselves."""
    rows = [(1, "words of a text that is one " * 20), (2, "Words of a text that is one " * 20), (3, None), (None, ""), (4, "other " * 40)]
    extra = "score row kept kept_id kept_sha text_sha256 sha n _sha _n _key _first keep_id group_size component_id n_shingles key place range ids df label x".split()
    docs = documents(spark, rows + rows[-1:]).selectExpr("*", *(f"{i} as {c}" for i, c in enumerate(extra)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema == docs.schema.__class__(out.schema.fields), name
        assert all(getattr(r, c) == i for r in out.collect() for i, c in enumerate(extra)), name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs.where("doc_id is null or doc_id > 2"), SF).collect()
    assert sorted(((r.doc_id, r.doc_tokens) for r in pieces if r.start == 0), key=str)[-1] == (None, 1) and len({r.doc_id for r in pieces}) == 3
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def test_a_run_leaves_only_its_last_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert len(list(tmp_path.iterdir())) == 1
