"""Queries with SQL against DuckDB, the driver's tables whole."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import digest  # noqa: E402
from tidemark.llm import registry as R  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(R.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = R.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(R.ORACLE[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(want)
    assert digest(df.columns, rows) == digest(cols, want)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in R.QUERIES) == list(range(1, 14))
