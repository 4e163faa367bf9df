"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from tidemark.plans import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = registry.QUERIES
# no all-pairs joins and no per-row Python anywhere in a registered plan
FORBIDDEN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
ORACLE = registry.ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_without_the_training_data_package(monkeypatch):
    """The other queries stay when that package and its pipeline are not installed."""
    import importlib.util

    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name == "tidemark.llm" else find(name, *a))
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(ORACLE)


def test_quality_answers_are_not_all_zero(con):
    """A check that always answered 0 would not pass: each has violations in the driver's tables."""
    for name in QUERIES:
        if name.startswith("dq_") and name != "dq_pk_duplicates":
            assert any(r[3] for r in con.execute(ORACLE[name]).fetchall()), name


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["table_name", "change_date", "id", "net_action", "deleted_updated_at"]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN_NODES:
        assert bad not in plan, f"{name} plans a {bad}"
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
