"""Every query with a SQL twin matches DuckDB (names, rows, values)."""

import os

import pytest

import __spark_entry__ as entry
from tools.oracle_check import duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(entry.oracle_sql())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns[:3] == ["col_name", "lo", "hi"]
    sql = entry.oracle_sql()["range_violations"]
    want = duck(entry.SMOKE_DIR).execute(sql).fetchall()
    assert rows and len(rows) == len(want)
    assert {r["col_name"] for r in rows} <= {f"l_{c}" for c in ("quantity", "extendedprice", "discount", "tax")}


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, name):
    from tools.oracle_check import check

    res = check(spark, SF, [name], verbose=False)[name]
    assert "error" not in res, res.get("error")
    assert res["names_match"], (res.get("spark_cols"), res.get("oracle_cols"))
    assert res["count_match"], res
    assert res["values_match"], (res.get("spark_only"), res.get("oracle_only"))
