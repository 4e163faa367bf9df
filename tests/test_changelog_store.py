"""Stored change log: windows, keys, row groups that are skipped, repeated and stopped loads."""

import datetime as dt
import glob

import pytest
from helpers import ep, log_df
from pyspark.sql import functions as F
from tidemark.sinks import changelog_store as S
from tidemark.sinks import publish

D1 = dt.date(2024, 1, 1)
DAY = dt.timedelta(days=1)


def events(n=3000):
    """Keys spread so that every file holds the whole range, but each key lies in few of them."""
    return [(i, "ab"[i % 2], "IUD"[i % 3], ep(D1 + (i % 4) * DAY, i % 86_400), (i * 7919) % 1000 * 2, None) for i in range(n)]


def scanned(df):
    """Rows that the scan gave, after the query has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_key_reads_a_small_part(spark, tmpdir_fresh):
    log = log_df(spark, events())
    assert S.load(log, f"{tmpdir_fresh}/log", D1, D1 + 3 * DAY) == [20240101, 20240102, 20240103, 20240104]
    stored = S.read(spark, f"{tmpdir_fresh}/log", log.schema)
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, log.collect()), key=str)
    key = events()[17][4]
    want = sorted(tuple(r) for r in log.where(f"table_name = 'a' AND row_data IN ({key}, 500)").select("event_id", "row_data").collect())
    found = S.history(stored, "a", spark.createDataFrame([(key,), (500,), (None,)], "k int"))
    assert sorted(map(tuple, found.select("event_id", "row_data").collect())) == want and want
    # odd keys lie within the range of every row group: only the bloom filters tell that none holds them
    assert scanned(S.history(stored, "a", spark.createDataFrame([(key + 1,)], "k long"))) == 0
    # a table that sorts before or after all of a file's rows
    assert scanned(stored.where("table_name = 'c'")) == 0
    plan = S.history(stored, "a", spark.createDataFrame([(2,), (4,)], "k long"))._jdf.queryExecution().executedPlan().toString()
    assert "In(row_data, [2,4])" in plan and "EqualTo(table_name,a)" in plan


def test_many_keys_join(spark, tmpdir_fresh):
    log = log_df(spark, events())
    S.load(log, f"{tmpdir_fresh}/log", D1, D1 + 3 * DAY)
    stored = S.read(spark, f"{tmpdir_fresh}/log", log.schema)
    keys = spark.range(0, 400, 1).withColumnRenamed("id", "k")
    found = S.history(stored, "b", keys)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "<= 399" in plan and "BroadcastHashJoin" in plan
    assert found.columns == log.columns
    assert sorted(r["event_id"] for r in found.collect()) == sorted(r[0] for r in events() if r[1] == "b" and r[4] < 400)


def test_a_window_reads_its_folders(spark, tmpdir_fresh):
    log = log_df(spark, events())
    S.load(log, f"{tmpdir_fresh}/log", D1, D1 + 3 * DAY)
    two = S.read(spark, f"{tmpdir_fresh}/log", log.schema, D1 + DAY, D1 + 2 * DAY)
    assert "PartitionFilters: [isnotnull(log_day" in two._jdf.queryExecution().executedPlan().toString()
    assert {r["event_id"] % 4 for r in two.collect()} == {1, 2} and two.columns == log.columns


def test_loads_repeat_and_recover(spark, tmpdir_fresh):
    path, log = f"{tmpdir_fresh}/log", log_df(spark, events(400))
    S.load(log, path, D1, D1 + 3 * DAY)
    other = {f for f in glob.glob(f"{path}/log_day=20240101/*")}
    more = log.unionByName(log_df(spark, [(9001, "a", "U", ep(D1 + DAY, 9), 4, None), (9002, "a", "T", ep(D1 + 9 * DAY), None, None)]))

    def stop(name):
        if name.startswith("put in place"):
            raise RuntimeError(name)

    with pytest.raises(RuntimeError):
        S.load(more, path, D1 + DAY, D1 + DAY, step=stop)
    assert publish.pending(spark, path)
    for _ in range(2):
        S.load(more, path, D1 + DAY, D1 + DAY)
    assert S.load(more, path, D1 + 8 * DAY, D1 + 9 * DAY) == [20240110]
    stored = S.read(spark, path, log.schema)
    assert sorted(r["event_id"] for r in stored.collect()) == [*range(400), 9001, 9002]
    assert other == {f for f in glob.glob(f"{path}/log_day=20240101/*")}  # a day outside the window keeps its files
    with pytest.raises(ValueError, match="without a transaction time"):
        S.load(log.withColumn("action_tstamp_tx", F.lit(None).cast("bigint")), path, D1, D1)
