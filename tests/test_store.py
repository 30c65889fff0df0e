"""The store of answers: looked up without an exchange of its own, exact over appended and compacted files."""

from pyspark.sql import functions as F

from pairscore.plans import pipeline
from pairscore.sources.models import StubModel
from pairscore.sources.store import Store, best_by

CHUNKS = "doc_id string, chunk_idx int, chunk_id string, page_hint string, title_path array<string>, text string"


def chunks(spark, texts):
    return spark.createDataFrame([("d", i, f"c{i}", "1", [], t) for i, t in enumerate(texts)], CHUNKS)


def below_joins(plan):
    """The store's scan and all that stands on it up to the first join or aggregate that needs rows of a key together."""
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    depth = lines[at].index("FileScan")
    above = []
    for x in reversed(lines[:at]):
        d = len(x) - len(x.lstrip(" :+-*()0123456789"))
        if d < depth:
            above.append(x)
            depth = d
            if "Join" in x or "Aggregate" in x:
                break
    return above


def test_looking_up_needs_no_exchange_of_the_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), pipeline._ANSWERS, pipeline._PROMPT, 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = chunks(spark, ["a", "b"]).withColumn(pipeline._PROMPT, F.sha2("text", 256))
        plan = pipeline.unanswered(wanted, store, "m")._jdf.queryExecution().executedPlan().toString()
        above = below_joins(plan)
        assert above and "Join" in above[-1] and not any("Exchange" in x for x in above)
        best = best_by(store.rows(), pipeline._PROMPT, F.struct("asked_at"), "raw_response")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in best
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


class Failing:
    name = "f"

    def open(self):
        def ask(system, user):
            raise ValueError("no")

        return ask


def test_answers_over_many_runs_and_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "MOST_FILES", 0.1)  # six files in all
    path = str(tmp_path / "answers")
    for n in (1, 2):
        rows = pipeline.kept_answers(chunks(spark, [f"Text Alpha{i}" for i in range(n)]), StubModel("m"), path, 2).collect()
        assert sorted(r.chunk_idx for r in rows) == list(range(n)) and all(r.raw_response and r.model_name == "m" for r in rows)
    store = Store(spark, path, pipeline._ANSWERS, pipeline._PROMPT)
    assert store.rows().count() == 2  # nothing is asked twice
    seen = []
    for _ in range(6):  # each run asks again and adds its failures
        rows = pipeline.kept_answers(chunks(spark, ["Text Alpha0", "Text Beta"]), Failing(), path, 2).collect()
        assert [r.error for r in rows] == ["ValueError: no"] * 2
        seen.append(store.files())
    assert max(seen) <= 8 and any(b < a for a, b in zip(seen, seen[1:]))
    assert {(r.model_name, r["count"]) for r in store.rows().groupBy("model_name").count().collect()} >= {("m", 2)}  # of other models none is lost
    again = pipeline.kept_answers(chunks(spark, ["Text Alpha0"]), StubModel("m"), path, 2).collect()
    assert again[0].raw_response and store.rows().where("model_name = 'm'").count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["answers"]
