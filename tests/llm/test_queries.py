"""The registered queries against their SQL."""

import duckdb
import pytest

from pairscore.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def told(rows):
    return sorted(tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "clicks", "sales", "sale_lines"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF), con.sql(SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert told(got.select(*columns).collect()) == told(want.select(*columns).fetchall())


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
