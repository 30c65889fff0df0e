import json

import pytest
from pyspark.sql import functions as F

from pairscore.functions.parsing import find_object, parse_answer, parse_response, valid_entity

GOOD = '{"entities":[{"name":"X","evidence":[{"page":"1","text":"t"}]}]}'


@pytest.mark.parametrize("raw", [GOOD, f"```json\n{GOOD}\n```", f"Here: {GOOD} done", f"```\n{GOOD}```", '[{"name":"X","evidence":[{"page":"1","text":"t"}]}]'])
def test_one_entity(raw):
    entities, error = parse_answer(raw)
    assert error is None and [(e["name"], e["type"], e["evidence"]) for e in entities] == [("X", "equipment", [{"page": "1", "text": "t"}])]


@pytest.mark.parametrize("raw, error", [("", "empty response"), (None, "empty response"), ('"just text"', "failed to parse JSON object"), ("5", "failed to parse JSON object"), ('note [{"name":"X"},{"name":"Y"}]', "failed to parse JSON object")])
def test_errors(raw, error):
    assert parse_answer(raw) == ([], error)


def test_no_entities_is_no_error():
    assert parse_answer("{}") == ([], None)
    assert parse_answer('note [{"name":"X"}]') == ([], None)
    assert parse_answer('{"entities":null}')[1].startswith("TypeError")
    assert find_object('{"a": NaN, "a": 1}')[0] == {"a": 1}


@pytest.mark.parametrize("bad", [{"name": 1}, {"name": None}, {"aliases": None}, {"aliases": "abc"}, {"attributes": {"a": 2}}, {"attributes": {"a": None}}, {"attributes": {"a": True}}, {"attributes": []}, {"relations": ["a"]}, {"evidence": [{"page": 1}]}, {"type": 3}])
def test_invalid_entities_are_left_out_alone(bad):
    assert valid_entity({"name": "x", **bad}) is None
    raw = json.dumps({"entities": [{"name": "x", **bad}, 7, {"name": "kept", "unknown": 1}]})
    assert [e["name"] for e in parse_answer(raw)[0]] == ["kept"]


def test_column(spark):
    rows = spark.createDataFrame([(1, GOOD), (2, "nothing"), (3, '{"entities":[{"name":"Y","attributes":{"k":"v"},"relations":[{"target":"Z"}]}]}'), (4, None)], "i int, raw string")
    got = {r.i: r.p for r in rows.select("i", parse_response(F.col("raw")).alias("p")).collect()}
    assert got[1].entities[0].name == "X" and got[2].error == "failed to parse JSON object" and got[4].error == "empty response"
    assert got[3].entities[0].attributes == {"k": "v"} and got[3].entities[0].relations[0].relation == ""
