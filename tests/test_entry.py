"""The registered queries against their SQL, on the small tables, and the independence of the rest from the optional part."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from pairscore.plans.queries import QUERIES, SQL

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def told(rows):
    return sorted(tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF), duck.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert told(got.select(*columns).collect()) == told(want.select(*[f'"{c}"' for c in columns]).fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_greedy_matching_by_hand(spark):
    from pairscore.plans.queries import _shared_aliases

    got = {}
    for r in QUERIES["match_greedy"](spark, SF).orderBy("ref_pos").collect():
        got.setdefault(r.doc_id, []).append(r.pred_pos)
    for row in _shared_aliases(spark, SF).collect():
        used, want = set(), []
        for r in row.ref:
            j = next((j for j, p in enumerate(row.pred) if j not in used and set(r["keys"]) & set(p["keys"])), -1)
            used.add(j)
            want.append(j)
        assert got[row.doc_id] == want


def test_without_the_optional_part():
    code = "import sys; sys.modules['pairscore.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'summary_metrics' in e.queries() and not any(k.startswith('op') for k in e.queries()); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_else_imports_the_optional_part():
    for path in (ROOT / "pairscore").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm import" not in path.read_text() and "pairscore.llm" not in path.read_text(), path
