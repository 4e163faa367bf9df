"""Constraint counts per day, and key intervals before a shuffled join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import log_df, src_df, ep
from tidemark.operators import capture, cdc, keysets, quality
from tidemark.sinks import constraint_store
from tidemark.sinks.constraint_store import ConstraintStore, summarise

COLUMNS = {"customer": ["id", "name"], "order": ["id", "customer_id", "reference"]}


def customers(spark, rows):
    return spark.createDataFrame([(i, n, 2024, m, 1) for i, n, m in rows], "id bigint, name string, year bigint, month bigint, day bigint")


def orders(spark, rows):
    return spark.createDataFrame(
        [(i, c, r, None if m is None else 2024, m, 1) for i, c, r, m in rows],
        "id bigint, customer_id bigint, reference string, year bigint, month bigint, day bigint")


def report(df):
    return sorted(tuple(r[c] for c in quality.CHECK_COLS) for r in df.collect())


def check(store, frames):
    want = quality.declared_checks({t: df.select(*COLUMNS[t]) for t, df in frames.items()})
    assert report(store.report()) == report(want)


def test_only_rewritten_days_are_summarised_again(spark, tmpdir_fresh):
    store = ConstraintStore(spark, f"{tmpdir_fresh}/c", COLUMNS)
    frames = {
        "customer": customers(spark, [(1, "a", 1), (2, None, 1), (2, "b" * 300, 2), (None, "c", 2), (None, "c", 3)]),
        "order": orders(spark, [(1, 1, "r", 1), (2, 9, "r" * 300, 2), (3, None, None, 3), (3, 2, "r", None), (4, 9, "r", 1)]),
    }
    for t, df in frames.items():
        store.build(t, df)
    check(store, frames)
    # customer 1 goes, 9 comes; the orders of February lose their orphan, March is emptied
    frames["customer"] = customers(spark, [(9, "a", 1), (2, None, 1), (2, "b" * 300, 2), (None, "c", 2), (None, "c", 3)])
    frames["order"] = orders(spark, [(1, 1, "r", 1), (2, 2, "r", 2), (3, 2, "r", None), (4, 9, "r", 1)])
    store.refresh("customer", frames["customer"], [(2024, 1, 1)])
    done = store.refresh("order", frames["order"], [(2024, 2, 1), (2024, 3, 1)])
    assert done.emptied == [(2024, 3, 1)]
    check(store, frames)
    store.refresh("order", frames["order"], [(2024, 2, 1)])  # again, as after a stop
    check(store, frames)
    # rows without a date are a day of their own
    frames["order"] = orders(spark, [(1, 1, "r", 1), (2, 2, "r", 2), (4, 9, "r", 1)])
    store.refresh("order", frames["order"], [(0, 0, 0)])
    check(store, frames)


def test_empty_tables_have_no_violations(spark, tmpdir_fresh):
    store = ConstraintStore(spark, f"{tmpdir_fresh}/c", COLUMNS)
    frames = {"customer": customers(spark, []), "order": orders(spark, [])}
    for t, df in frames.items():
        store.build(t, df)
    check(store, frames)


def test_a_refresh_reads_only_its_days(spark, tmpdir_fresh):
    customers(spark, [(i, "n", 1 + i % 5) for i in range(50)]).write.partitionBy("year", "month", "day").parquet(f"{tmpdir_fresh}/t")
    df = summarise(spark.read.parquet(f"{tmpdir_fresh}/t"), "customer").where("month = 2")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert sum(r["n"] for r in df.where("kind = 'key'").collect()) == 10


@pytest.mark.parametrize("values", [
    [], [None], [5], list(range(1000)), [-(2**63), 0, 2**63 - 1], [1, 2, 3, 1000, 1001, 10**15, None, 10**15],
    [i * i for i in range(300)] * 3,
])
def test_intervals_cover_all_keys(spark, values):
    keys = spark.createDataFrame([(v,) for v in values], "k bigint")
    own = [v for v in values if v is not None]
    for n in (1, 3, 32):
        found = keysets.key_intervals(keys, "k", n)
        assert len(found.intervals) <= n and found.n_keys == len(own)
        assert all(any(lo <= v <= hi for lo, hi in found.intervals) for v in own)
        assert all(a[1] < b[0] for a, b in zip(found.intervals, found.intervals[1:]))
        assert 0 <= found.covered <= 1
    assert keys.where(found.condition()).count() == len(own)


def test_intervals_leave_out_the_large_gaps(spark):
    keys = spark.range(1000).union(spark.range(10**9, 10**9 + 1000)).union(spark.range(10**12, 10**12 + 5)).toDF("k")
    found = keysets.key_intervals(keys, "k", 3)
    assert found.intervals == ((0, 999), (10**9, 10**9 + 999), (10**12, 10**12 + 4)) and found.covered < 1e-8
    assert keysets.key_intervals(keys.select(F.col("k").cast("string").alias("k")), "k") is None


def test_large_key_sets_reach_the_scan_as_ranges(spark, tmpdir_fresh, monkeypatch):
    day = dt.date(2024, 1, 15)
    src_df(spark, [(i * 1000, i, day - dt.timedelta(days=i % 7)) for i in range(300)]).write.parquet(f"{tmpdir_fresh}/s")
    source = spark.read.parquet(f"{tmpdir_fresh}/s")
    log = log_df(spark, [(i, "order", "U", ep(day, i), k * 1000, None) for i, k in enumerate([3, 4, 5, 250, 251, 999])])
    net = cdc.net_actions(log, "order")
    want = sorted(map(tuple, cdc.update_dates(net, source, "order").collect()))
    large = cdc.update_dates(net, source, "order", broadcast_keys=False)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id," in plan and "LessThanOrEqual(id," in plan
    assert sorted(map(tuple, large.collect())) == want and want
    lake_days = sorted(map(tuple, cdc.lake_partitions_of_keys(source, net, "order").collect()))
    assert sorted(map(tuple, cdc.lake_partitions_of_keys(source, net, "order", broadcast_keys=False).collect())) == lake_days
    # all three counted above the bound
    monkeypatch.setattr(cdc, "MAX_BROADCAST_KEYS", 1)
    assert sorted(map(tuple, cdc.update_dates(net, source, "order").collect())) == want


def test_entries_are_counted_under_numbers(spark):
    """Names travel with no entry: what is hashed and shuffled per key is numbers only."""
    df = customers(spark, [(1, "a", 1), (1, None, 2), (None, "b" * 300, 2)])
    counts = constraint_store._counts(df, "customer")
    assert {t for _, t in counts.dtypes} <= {"int", "bigint"}
    named = {(r["kind"], r["column"], r["month"]): r["n"] for r in summarise(df, "customer").where("kind <> 'key'").collect()}
    want = {(k, c, 2): 1 for k, c, _ in constraint_store._column_checks("customer", ["id", "name"])}
    assert named == want and want
    assert summarise(df, "customer").where("kind = 'key'").count() == 3
