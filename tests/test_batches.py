"""Python functions hand back what they make part by part, however large the batches are that they get."""

import numpy as np
import pandas as pd
import pyarrow as pa

from pairscore.functions.batches import by_bytes, in_parts
from pairscore.operators import chunking
from pairscore.sources import models


class Taken:
    """Stands for a table: keeps the function that is mapped over it."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        self.run = run
        return self

    mapInPandas = mapInArrow  # noqa: N815


def test_parts():
    batch = pa.record_batch({"id": list(range(6)), "text": ["a" * 10, None, "", "b" * 99, "c", "d" * 10]})
    parts = list(by_bytes([batch, batch.slice(0, 0)], 1, 20))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1, 2, 3], [4, 5]]
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    frame = pd.DataFrame({"x": np.arange(10)})
    assert [list(p["x"]) for p in in_parts([frame], 4)] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    assert [len(p) for p in in_parts([frame[:0]])] == [0]


def test_chunks_are_handed_back_in_parts(spark):
    texts = [f"# T{i}\n" + "x" * 9_000 for i in range(1_000)]
    batch = pa.record_batch({"doc_id": [str(i) for i in range(1_000)], "text": texts})
    out = list(chunking.chunk_documents(Taken()).run([batch]))
    assert max(b.nbytes for b in out) < 3 << 20
    assert [r["doc_id"] for b in out for r in b.to_pylist() if r["chunk_idx"] == 1] == [str(i) for i in range(1_000)]


def test_answers_are_handed_back_in_parts(spark, monkeypatch):
    taken = Taken()
    monkeypatch.setattr(models, "shared_out", lambda df, limits: (taken, 1))
    models.ask_model(taken, models.StubModel())
    frame = pd.DataFrame({"doc_id": "d", "chunk_idx": np.arange(1_000), "chunk_id": "c", "page_hint": "p", "title_path": [[]] * 1_000, "text": "Alpha Bravo"})
    out = list(taken.run([frame]))
    assert max(map(len, out)) <= 256 and [i for o in out for i in o["chunk_idx"]] == list(range(1_000))


def test_answers_are_read_in_parts(spark):
    rows = [("d", i, "c", "p", [], '{"entities":[{"name":"A","attributes":{"k":"v"},"evidence":[{"page":"1","text":"' + "t" * 10_000 + '"}]}]}', "gone" if i == 7 else None, "m") for i in range(1_000)]
    responses = spark.createDataFrame(rows, models.RESPONSE)
    parsed = models.parse_responses(responses)
    found = {r.chunk_idx: r for r in parsed.collect()}
    assert len(found) == 1_000 and found[7].entities == [] and found[7].error == "gone" and found[8].entities[0].attributes == {"k": "v"}
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan  # a column function would hold a batch's entities at once
