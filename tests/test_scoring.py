"""Merging and scoring, on hand-made cases and against a plain version on random ones."""

import random

import pytest
from pyspark.sql import functions as F

from pairscore.operators import evaluate as ev, report
from pairscore.operators.merge import normalize_extractions
from pairscore.schemas import ENTITY, ERROR_TYPES

EXTRACTION = f"doc_id string, chunk_idx int, chunk_id string, entities array<{ENTITY}>"


def E(name, type="equipment", aliases=(), attributes=(), relations=(), evidence=1):  # noqa: N802
    return (name, type, list(aliases), dict(attributes), [tuple(r) for r in relations], [("1", "t")] * evidence)


def table(spark, chunks):
    return spark.createDataFrame([("d", i, f"c{i}", list(es)) for i, es in enumerate(chunks)], EXTRACTION)


def merged(spark, *entities):
    return normalize_extractions(table(spark, [entities])).first().entities


def test_merge(spark):
    a = merged(spark, E("P-13", attributes={"射程": "100"}, aliases=["b", "a", " "], relations=[("r", "x")]), E("Ｐ－13", "missile", attributes={"射程": "120", "重": " "}, aliases=["a", "c"], relations=[("r", "x")]))
    assert [(e.name, e.type, e.aliases, e.attributes, len(e.relations), len(e.evidence)) for e in a] == [("P-13", "missile", ["a", "b", "c"], {"射程": "120"}, 2, 2)]
    assert merged(spark, E("k", "missile"), E("K", "radar"))[0].type == "missile"
    assert merged(spark, E(" "), E("x", evidence=0)) == []
    assert [e.name for e in merged(spark, E("A", aliases=["B"]), E("B"))] == ["A", "B"]


def score(spark, ref, pred, gold=None):
    return ev.evaluate_pairs(table(spark, [pred]), table(spark, [ref]), gold).first()


def counts(row):
    return [tuple(row[level]) for level in ("entity", "attribute", "relation")]


def kinds(row):
    return sorted((e.error_type, tuple(sorted(e.payload.items()))) for e in row.errors)


def test_entities(spark):
    assert counts(score(spark, [E("X")], [E("x")]))[0] == (1, 0, 0)
    assert counts(score(spark, [E("X", aliases=["Y"]), E("Z", aliases=["Y"])], [E("Y"), E("X")]))[0] == (1, 1, 1)
    row = score(spark, [E("X", "radar")], [E("X", "sonar")])
    assert counts(row)[0] == (1, 0, 0) and [e.error_type for e in row.errors] == ["wrong_type"]


def test_attributes(spark):
    at = lambda ref, pred, *more: counts(score(spark, [E("X", attributes=ref), *more], [E("X", attributes=pred)]))[1]
    assert [at({"a": "1"}, {}), at({"a": "1"}, {"a": "2"}), at({}, {"a": "1"}), at({"K": "1"}, {"k": "1"})] == [(0, 0, 1), (0, 1, 1), (0, 1, 0), (1, 0, 0)]
    row = score(spark, [E("X"), E("O", attributes={"z": "9"}), E("P", attributes={"y": "9"})], [E("X", attributes={"a": "9"})])
    assert counts(row)[1] == (0, 1, 0) and ("wrong_attachment", (("attribute", "a"), ("likely_entity", "O"), ("predicted_entity", "X"), ("value", "9"))) in kinds(row)
    assert counts(score(spark, [E("M", attributes={"a": "1", "b": "2"})], []))[1] == (0, 0, 0)
    wrong = score(spark, [E("X", attributes={"K": "1"})], [E("X", attributes={"k": "2"})])
    assert kinds(wrong) == [("wrong_attribute_value", (("attribute", "K"), ("entity", "X"), ("prediction_value", ""), ("reference_value", "1")))]


def test_relations(spark):
    rel = lambda ref, pred: counts(score(spark, ref, pred))[2]
    assert rel([E("X", relations=[("携带", "T"), ("携带", "T")])], [E("X", relations=[("装备", "t")])]) == (1, 0, 1)
    assert rel([E("X", relations=[("携带", "Tee")]), E("T", aliases=["Tee"])], [E("X", relations=[("携带", "T")]), E("T", aliases=["Tee"])]) == (1, 0, 0)
    assert rel([E("X", relations=[("携带", " ")])], [E("X", relations=[("携带", " ")])]) == (0, 1, 1)
    assert rel([E("X", relations=[("携带", "")])], [E("X", relations=[("携带", "")])]) == (0, 0, 0)


def test_empty_sides(spark):
    row = score(spark, [], [])
    assert counts(row) == [(0, 0, 0)] * 3 and row.entity_f1 == 0.0 and row.errors == []


def test_reference_choice(spark):
    b, a = table(spark, [[E("B")], [E("B")]]), table(spark, [[E("A")]])
    chosen = lambda gold: [(r.ref_entities[0].name if r.ref_entities else None, r.reference_source, r.reference_actual) for r in ev.choose_reference(b, a, gold).orderBy("chunk_idx").collect()]
    gold = lambda rows: spark.createDataFrame(rows, f"chunk_id string, line_no int, entities array<{ENTITY}>")
    assert chosen(None) == [("A", "model_a_pseudo_gold", "model_a"), (None, "model_a_pseudo_gold", "model_a")]
    assert chosen(gold([("c0", 1, [E("old")]), ("c0", 2, [E("G")])])) == [("G", "gold", "gold"), (None, "gold", "model_a")]
    assert chosen(gold([("c0", 1, [])])) == [("A", "gold", "model_a"), (None, "gold", "model_a")]


def plain_score(ref, pred):
    """Counts and error kinds by nested loops over (name, aliases, attributes, relations) with names in comparison form."""
    keys = lambda e: {e[0], *e[2]}
    used, pairs = set(), []
    for i, r in enumerate(ref):
        j = next((j for j, p in enumerate(pred) if j not in used and keys(r) & keys(p)), None)
        if j is not None:
            used.add(j)
            pairs.append((i, j))
    entity = (len(pairs), len(pred) - len(pairs), len(ref) - len(pairs))
    tp = fp = fn = 0
    for i, j in pairs:
        r, p = ref[i][3], pred[j][3]
        tp += sum(p.get(k) == v for k, v in r.items())
        fn += sum(p.get(k) != v for k, v in r.items())
        fp += sum(k in p and p[k] != v for k, v in r.items()) + sum(k not in r for k in p)
    target = lambda t, side: {t}.union(*(keys(e) for e in side if t in keys(e)))
    links = lambda side: [(e, n, t) for e in side for n, t in e[4]]
    taken = set()
    for r, n, t in links(ref):
        hit = next((k for k, (p, m, u) in enumerate(links(pred)) if k not in taken and n == m and keys(r) & keys(p) and target(t, ref) & target(u, pred)), None)
        if hit is not None:
            taken.add(hit)
    return [entity, (tp, fp, fn), (len(taken), len(links(pred)) - len(taken), len(links(ref)) - len(taken))]


def random_side(rng):
    names = rng.sample("abcdefgh", rng.randrange(7))
    return [E(n, rng.choice(["radar", "sonar"]), sorted(rng.sample("xyz", rng.randrange(3))), {k: rng.choice("12") for k in rng.sample("pqr", rng.randrange(4))}, [(rng.choice(["r1", "r2"]), rng.choice("abcxyz")) for _ in range(rng.randrange(4))]) for n in names]


def test_random_chunks_match_the_plain_version(spark):
    rng = random.Random(9)
    refs, preds = [random_side(rng) for _ in range(80)], [random_side(rng) for _ in range(80)]
    done = ev.evaluate_pairs(table(spark, preds), table(spark, refs), exact=False).orderBy("chunk_idx").collect()
    for row, ref, pred in zip(done, refs, preds, strict=True):
        assert counts(row) == plain_score(ref, pred)
        n = lambda kind, row=row: sum(e.error_type == kind for e in row.errors)
        assert (row.entity.fn, row.entity.fp, row.relation.fn) == (n("missing_entity"), n("extra_entity"), n("wrong_relation"))
        assert row.attribute.fn == n("missing_attribute") + n("wrong_attribute_value")
        assert row.attribute.fp >= n("wrong_attribute_value") + n("wrong_attachment")


# Recorded counts of nine chunks (true positives, false positives, false negatives of each level) and their errors.
RECORDED = [
    ((8, 0, 0), (20, 0, 0), (19, 0, 0), {}),
    ((8, 0, 0), (25, 0, 0), (14, 0, 0), {}),
    ((16, 0, 0), (76, 1, 1), (23, 0, 0), {"wrong_attribute_value": 1}),
    ((16, 3, 2), (28, 11, 14), (27, 3, 5), {"missing_entity": 2, "extra_entity": 3, "missing_attribute": 14, "wrong_relation": 5}),
    ((2, 0, 0), (0, 4, 6), (2, 0, 0), {"missing_attribute": 5, "wrong_attribute_value": 1}),
    ((10, 0, 0), (18, 0, 0), (19, 0, 0), {}),
    ((6, 0, 0), (8, 0, 0), (10, 0, 0), {}),
    ((9, 0, 0), (17, 0, 0), (22, 0, 0), {}),
    ((5, 0, 0), (8, 0, 0), (10, 0, 0), {}),
]


def test_report_of_a_recorded_run(spark):
    level = "struct<tp:bigint,fp:bigint,fn:bigint>"
    rows = [("d", i, f"chunk_{i:04d}", "model_a_pseudo_gold", e, a, r, [(k, j, {}) for k in ERROR_TYPES for j in range(errors.get(k, 0))]) for i, (e, a, r, errors) in enumerate(RECORDED, 1)]
    done = spark.createDataFrame(rows, f"doc_id string, chunk_idx int, chunk_id string, reference_source string, entity {level}, attribute {level}, relation {level}, errors array<struct<error_type:string,seq:int,payload:map<string,string>>>")
    total = report.summary_metrics(done).first()
    assert counts(total) == [(80, 3, 2), (200, 16, 21), (146, 3, 5)]
    assert [total[f"{lv}_{m}"] for lv in ("entity", "attribute", "relation") for m in ("precision", "recall", "f1")] == [0.963855, 0.97561, 0.969697, 0.925926, 0.904977, 0.915332, 0.979866, 0.966887, 0.973333]
    errors = ev.error_rows(done)
    by_type = {r.error_type: r["count"] for r in report.errors_by_type(done).collect()}
    assert [by_type[k] for k in ERROR_TYPES] == [2, 3, 0, 19, 2, 5, 0]
    assert report.errors_by_type(done.limit(0)).collect() == []
    ordered = [(r.chunk_idx, r.error_type) for r in report.ordered_chunk_errors(report.chunk_errors(errors)).collect()]
    assert ordered == sorted(ordered, key=lambda x: (x[0], ERROR_TYPES.index(x[1]))) and len(ordered) == 7
    assert report.reference_label(done).first()[0] == report.reference_label(done.limit(0)).first()[0] == "model_a_pseudo_gold"


def test_rounding_is_half_even(spark):
    from pairscore.functions.metrics import measures

    row = spark.range(1).select(*measures(F.lit(1), F.lit(127), F.lit(0))).first()
    assert row[0] == 0.007812 and row[1] == 1.0


@pytest.mark.parametrize("side", [[E("A", attributes={"k": "v"}, relations=[("携带", "B")]), E("B", aliases=["b2"])]])
def test_equal_sides_score_one(spark, side):
    row = score(spark, side, side)
    assert (row.entity_f1, row.attribute_f1, row.relation_f1, row.errors) == (1.0, 1.0, 1.0, [])


def test_long_lists_match_as_short_ones_do(spark, monkeypatch):
    """The look-up by keys and the fold give the same on random lists, with blank lists and repeated keys."""
    rnd = random.Random(5)
    lists = lambda n: [[rnd.choice("abcdefgh") + str(rnd.randrange(6)) for _ in range(rnd.randrange(0, 4))] for _ in range(n)]
    rows = [(i, lists(rnd.randrange(0, 40)), lists(rnd.randrange(0, 40))) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, l array<array<string>>, r array<array<string>>")

    def plain(left, right):
        used, out = set(), []
        for keys in left:
            j = next((j for j, other in enumerate(right) if j not in used and set(keys) & set(other)), -1)
            used.add(j)
            out.append(j)
        return out

    want = {i: plain(a, b) for i, a, b in rows}
    for limit in (10**9, 0, 300):
        monkeypatch.setattr(ev, "FOLD_PAIRS", limit)
        assert {r.i: r.m for r in df.select("i", ev.greedy(F.col("l"), F.col("r")).alias("m")).collect()} == want


def test_a_group_of_100_000_entities(spark):
    n = 100_000
    side = lambda name, shift: F.expr(f"transform(sequence(0, {n - 1}), i -> named_struct('keys', array('all', concat('k', (i + {shift}) % 500))))").alias(name)
    done = ev.match_lists(spark.range(1).select(side("ref", 0), side("pred", 7))).select(F.inline(F.expr("transform(entity_match, (m, i) -> named_struct('i', i, 'm', m))")))
    assert done.where("i <> m").count() == 0 and done.count() == n  # all share a key, so the first free one is next
