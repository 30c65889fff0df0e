"""Comparison forms of many rows' lists at once, and errors that are scored once."""

import pyarrow as pa
from pyspark.sql import functions as F

from pairscore.operators import evaluate as ev
from pairscore.schemas import ENTITY


def test_a_string_is_folded_once_however_many_rows_have_it():
    seen = []
    codes, forms = ev._mapped(lambda x: seen.append(x) or x.lower(), pa.array(["A", "b", "a", None, "A", "b"]))
    assert sorted(seen) == ["", "A", "a", "b"] and [forms.to_pylist()[c] for c in codes] == ["a", "b", "a", "", "a", "b"]


def test_prepared_lists_of_odd_rows(spark):
    entity = lambda name, aliases=(), attributes=None, links=(): (name, "Radar", list(aliases), attributes or {}, list(links), [])
    full = [
        entity("Ｐ－13", ["p-13", " ", "Q"], {"K": "Straße"}, [("携带", "q"), ("携带", ""), ("x", None), ("near  by", " "), ("携带", "Ghost")]),
        entity("R", ["q", None]),
        entity(" ", links=[("位于", "r")]),
    ]
    rows = spark.createDataFrame([(1, full), (2, None), (3, []), (4, [entity("q")])], f"id int, entities array<{ENTITY}>").coalesce(1)
    one, none, empty, other = (r.ready for r in rows.select("id", ev.prepared(F.col("entities")).alias("ready")).orderBy("id").collect())
    assert none is None and empty == []
    assert [(e.name, e.n_type, e.keys) for e in one] == [("Ｐ－13", "radar", ["p-13", "q"]), ("R", "radar", ["r", "q"]), (" ", "radar", [])]
    assert [tuple(a) for a in one[0].attributes] == [("K", "Straße", "k", "strasse")]
    links = [(r.relation, r.target, r.target_keys) for r in one[0].relations]
    assert links == [("equipped_with", "q", ["q", "p-13", "r"]), ("nearby", "", []), ("equipped_with", "ghost", ["ghost"])]
    # keys of another row are not looked at
    assert [(r.relation, r.target_keys) for r in one[2].relations] == [("located_in", ["r", "q"])] and other[0].keys == ["q"]


def test_errors_are_scored_once(spark):
    rows = spark.createDataFrame([(1, [(1, "a", [])])], "id int, given array<struct<n:int,kind:string,payload:array<string>>>")
    made = F.transform("given", lambda x: F.struct(F.concat(x["kind"], F.lit("once")).alias("error_type"), x["n"].alias("seq"), x["payload"].alias("payload")))
    plan = ev.error_rows(rows.select("id", F.lit("c").alias("chunk_id"), made.alias("errors")), ("id",))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("once") == 1
