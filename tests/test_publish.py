"""Staged publish and the key index: stops at every step, resumed and undone; index equal to the lake."""

import datetime as dt
import re

import pytest
from helpers import src_df
from pyspark.sql import functions as F
from test_cdc import D10, D11, D12, RUN, scenario_log, scenario_source_after
from tidemark.plans.recoverable import backfill_indexed, refresh_published
from tidemark.plans.refresh import refresh
from tidemark.sinks import lake, publish
from tidemark.sinks import key_index
from tidemark.sinks.key_index import KeyIndex
from tidemark.specs import PARTITION_COLS, TableSpec

SPEC = TableSpec("order")


class Stop(Exception):
    pass


def stop_at(n):
    """A step hook that stops before step n, and the names of the steps so far."""
    seen = []

    def step(name):
        seen.append(name)
        if len(seen) == n:
            raise Stop(name)

    return step, seen


def before(spark):
    return src_df(spark, [(1, 1, D10), (2, 2, D10), (3, 3, D11), (4, 4, D12), (-9, 9, D12)])


def after(spark):
    """Key 1 has moved to the run day and 4 to day 10, beside the worked scenario's changes."""
    return src_df(spark, [(1, 11, RUN), (2, 2, D10), (4, 4, D10), (5, 5, RUN), (6, 6, RUN), (-9, 9, D12)])


def rows(spark, path):
    return sorted(map(tuple, lake.read_lake(spark, path).select("id", "amount", *PARTITION_COLS).collect()))


def places(spark, path):
    return sorted(map(tuple, KeyIndex(spark, path).read().select("id", *PARTITION_COLS).collect()))


def folders(spark, path):
    files = publish.Files(spark, path)
    return publish.partition_folders(files, path, 3), files.exists(f"{path}/_staging")


def consistent(spark, root):
    assert places(spark, f"{root}/index") == sorted((r[0], *r[2:]) for r in rows(spark, f"{root}/lake"))
    assert publish.pending(spark, f"{root}/lake") == publish.pending(spark, f"{root}/index") == []


@pytest.fixture(scope="module")
def outcome(spark):
    """Old and new content of the lake, and the number of steps of a whole run."""
    from tidemark.session import scratch_path

    root = scratch_path(spark, "outcome")
    backfill_indexed(before(spark), SPEC, f"{root}/lake", f"{root}/index", span=2)
    old = rows(spark, f"{root}/lake")
    step, seen = stop_at(0)
    res = refresh_published(spark, scenario_log(spark), after(spark), SPEC, f"{root}/lake", RUN, index_path=f"{root}/index", step=step)
    consistent(spark, root)
    assert res.affected == [(2024, 1, 10), (2024, 1, 11), (2024, 1, 15)] and res.emptied == [(2024, 1, 11)]
    new = rows(spark, f"{root}/lake")
    assert (1, 11.0, 2024, 1, 15) in new and (1, 1.0, 2024, 1, 10) not in new and old != new
    assert folders(spark, f"{root}/lake") == (["year=2024/month=1/day=10", "year=2024/month=1/day=12", "year=2024/month=1/day=15"], False)
    return old, new, seen


@pytest.mark.parametrize("mode", ["resume", "undo"])
def test_a_run_stopped_at_any_step(spark, tmpdir_fresh, outcome, mode):
    old, new, seen = outcome
    for n, name in enumerate(seen, 1):
        root = f"{tmpdir_fresh}/{n}"
        backfill_indexed(before(spark), SPEC, f"{root}/lake", f"{root}/index", span=2)
        with pytest.raises(Stop):
            refresh_published(spark, scenario_log(spark), after(spark), SPEC, f"{root}/lake", RUN, index_path=f"{root}/index", step=stop_at(n)[0])
        published = n > seen.index("journal") + 1
        found = publish.recover(spark, f"{root}/lake", mode, also=[f"{root}/index"])
        whole = name.startswith("clean") or published and mode == "resume"
        assert rows(spark, f"{root}/lake") == (new if whole else old), (n, name, found)
        consistent(spark, root)


@pytest.mark.parametrize("mode", ["resume", "undo"])
def test_a_recovery_stopped_at_any_step(spark, tmpdir_fresh, outcome, mode):
    """A recovery that is stopped itself is carried on by the next one."""
    old, *_ = outcome
    lake.backfill(before(spark), f"{tmpdir_fresh}/want")
    refresh_published(spark, scenario_log(spark), after(spark), SPEC, f"{tmpdir_fresh}/want", RUN)
    want = rows(spark, f"{tmpdir_fresh}/want") if mode == "resume" else old
    n, whole = 1, False
    while not whole:
        root = f"{tmpdir_fresh}/{n}"
        lake.backfill(before(spark), f"{root}/lake")
        with pytest.raises(Stop):
            refresh_published(spark, scenario_log(spark), after(spark), SPEC, f"{root}/lake", RUN, step=stop_at(3 if mode == "resume" else 5)[0])
        try:
            publish.recover(spark, f"{root}/lake", mode, step=stop_at(n)[0])
            whole = True
        except Stop:
            publish.recover(spark, f"{root}/lake", mode)
        assert rows(spark, f"{root}/lake") == want, n
        assert not folders(spark, f"{root}/lake")[1]
        n += 1
    assert n > 4


def test_next_run_resumes_what_was_left(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/lake"
    lake.backfill(before(spark), path)
    with pytest.raises(Stop):
        refresh_published(spark, scenario_log(spark), scenario_source_after(spark), SPEC, path, RUN, step=stop_at(5)[0])
    assert publish.pending(spark, path)
    refresh_published(spark, scenario_log(spark), scenario_source_after(spark), SPEC, path, RUN)
    want = f"{tmpdir_fresh}/want"
    lake.backfill(before(spark), want)
    refresh(spark, scenario_log(spark), scenario_source_after(spark), SPEC, want, RUN)
    assert rows(spark, path) == rows(spark, want) and not folders(spark, path)[1]


def test_unswapped_days_keep_their_files(spark, tmpdir_fresh):
    import os

    path = f"{tmpdir_fresh}/lake"
    lake.backfill(before(spark), path)
    day = f"{path}/year=2024/month=1/day=12"
    files = {f: os.stat(f"{day}/{f}").st_mtime_ns for f in os.listdir(day)}
    refresh_published(spark, scenario_log(spark), scenario_source_after(spark), SPEC, path, RUN)
    assert files == {f: os.stat(f"{day}/{f}").st_mtime_ns for f in os.listdir(day)}


def test_staged_partitions_outside_the_asked_ones_are_refused(spark, tmpdir_fresh):
    run = publish.Run(spark, f"{tmpdir_fresh}/lake")
    before(spark).write.partitionBy(*PARTITION_COLS).parquet(run.stage())
    with pytest.raises(ValueError, match="outside"):
        run.replace(["year=2024/month=1/day=10"], 3)
    with pytest.raises(ValueError, match="mode"):
        publish.recover(spark, f"{tmpdir_fresh}/lake", "retry")


def test_index_reads_only_the_buckets_of_the_keys(spark, tmpdir_fresh):
    rows_ = [(i, 1, D10 + dt.timedelta(days=i % 3)) for i in range(-40, 400)] + [(7, 1, D12), (7, 1, D12)]
    source = src_df(spark, rows_)
    lake.backfill(source.withColumn("id", F.when(F.col("id") != 399, F.col("id"))), f"{tmpdir_fresh}/lake")
    index = KeyIndex.build(lake.read_lake(spark, f"{tmpdir_fresh}/lake"), f"{tmpdir_fresh}/index", span=10)
    keys = spark.createDataFrame([(7,), (-1,), (-10,), (-11,), (200,), (9999,), (None,), (7,)], "k int")
    assert index.buckets_of(keys) == [-2, -1, 0, 20, 999]
    found = index.lookup(keys)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[bucket#\d+L? IN \(-2,-1,0,20,999\)", plan) and "Exchange hashpartitioning(id" not in plan
    read = {r["bucket"] for r in index.named(index.buckets_of(keys)).select("bucket").distinct().collect()}
    assert read == {-2, -1, 0, 20}  # of 44 buckets
    want = sorted({(i, d.year, d.month, d.day) for i, _, d in rows_ if i in (7, -1, -10, -11, 200)})
    assert sorted(map(tuple, found.collect())) == want
    assert index.days_of(keys) == sorted({w[1:] for w in want})
    assert index.read().where("id IS NULL").count() == 0


def test_index_update_rewrites_only_changed_buckets(spark, tmpdir_fresh):
    import os

    root = str(tmpdir_fresh)
    source = src_df(spark, [(i, 1, D10) for i in range(100)] + [(100 + i, 1, D11) for i in range(100)])
    backfill_indexed(source, SPEC, f"{root}/lake", f"{root}/index", span=10)
    stat = lambda: {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(f"{root}/index") for f in fs}
    was = stat()
    from helpers import ep, log_df

    log = log_df(spark, [(1, "order", "U", ep(RUN, 5), 42, None), (2, "order", "D", ep(RUN, 6), 150, ep(D11))])
    moved = source.where("id <> 150").withColumn("day", F.when(F.col("id") == 42, 15).otherwise(F.col("day"))).withColumn(
        "updated_at", F.when(F.col("id") == 42, ep(RUN)).otherwise(F.col("updated_at")))
    refresh_published(spark, log, moved, SPEC, f"{root}/lake", RUN, index_path=f"{root}/index")
    consistent(spark, root)
    changed = {f.split("bucket=")[1].split("/")[0] for f in set(was) ^ set(stat()) if "bucket=" in f}
    assert changed == {"4", "15"}


def test_index_build_makes_few_buckets(spark, tmpdir_fresh, monkeypatch):
    """A narrow span made a folder per few keys, each swapped on its own; buckets are as wide as their number asks for."""
    monkeypatch.setattr(key_index, "MAX_BUCKETS", 8)
    rows = [(k, 1, dt.date(2024, 1, 1 + k % 5)) for k in range(-40, 300)]
    lake.backfill(src_df(spark, rows), f"{tmpdir_fresh}/lake")
    whole = lake.read_lake(spark, f"{tmpdir_fresh}/lake")
    index = KeyIndex.build(whole, f"{tmpdir_fresh}/index", span=4)
    assert index.span == 64 and index.read().select("bucket").distinct().count() <= 9
    assert sorted(tuple(r) for r in index.read().select("id", *PARTITION_COLS).collect()) == [(k, d.year, d.month, d.day) for k, _, d in rows]
    keys = spark.createDataFrame([(-40,), (0,), (299,)], "id bigint")
    assert sorted(r["id"] for r in index.lookup(keys).collect()) == [-40, 0, 299]
    monkeypatch.setattr(key_index, "FULL_BUCKET", 4)  # buckets of four places are full: all may stay
    assert KeyIndex.build(whole, f"{tmpdir_fresh}/full", span=4).span == 4
