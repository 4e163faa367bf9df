"""Lake writes in fresh folders: worked refresh, idempotence, untouched partitions, clearing."""

import datetime as dt
import os

from pyspark.sql import functions as F

from helpers import ep, src_df
from test_cdc import D10, D11, D12, RUN, scenario_log, scenario_source_after
from tidemark.plans.refresh import refresh, run_all
from tidemark.sinks import lake
from tidemark.specs import TableSpec


def _contents(spark, path):
    rows = lake.read_lake(spark, path).select("id", "amount", "year", "month", "day").collect()
    out = {}
    for r in rows:
        out.setdefault(dt.date(r.year, r.month, r.day), set()).add((r.id, r.amount))
    return out


def _before(spark):
    return src_df(spark, [(1, 1, D10), (2, 2, D10), (3, 3, D11), (4, 4, D12)])


def test_worked_refresh(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/order"
    lake.backfill(_before(spark), path)
    res = refresh(spark, scenario_log(spark), scenario_source_after(spark), TableSpec("order"), path, RUN)
    assert res.affected == [(2024, 1, 10), (2024, 1, 11), (2024, 1, 15)]
    assert res.emptied == [(2024, 1, 11)]
    got = _contents(spark, path)
    assert got == {D10: {(1, 11.0), (2, 2.0)}, D12: {(4, 4.0)}, RUN: {(5, 5.0), (6, 6.0)}}
    assert not os.path.exists(f"{path}/year=2024/month=1/day=11")


def test_refresh_twice_equals_once(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/order"
    lake.backfill(_before(spark), path)
    for _ in range(2):
        refresh(spark, scenario_log(spark), scenario_source_after(spark), TableSpec("order"), path, RUN)
    assert _contents(spark, path) == {D10: {(1, 11.0), (2, 2.0)}, D12: {(4, 4.0)}, RUN: {(5, 5.0), (6, 6.0)}}


def test_partitions_outside_affected_untouched(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/order"
    lake.backfill(_before(spark), path)
    d12 = f"{path}/year=2024/month=1/day=12"
    before = {f: os.stat(os.path.join(d12, f)).st_mtime_ns for f in os.listdir(d12)}
    refresh(spark, scenario_log(spark), scenario_source_after(spark), TableSpec("order"), path, RUN)
    after = {f: os.stat(os.path.join(d12, f)).st_mtime_ns for f in os.listdir(d12)}
    assert before == after


def test_overwrite_keeps_other_dates(spark, tmpdir_fresh):
    """A one-day rewrite leaves every other partition in place."""
    path = f"{tmpdir_fresh}/t"
    lake.backfill(_before(spark), path)
    lake.rewrite_partitions(spark, src_df(spark, [(9, 9, D10)]), [(2024, 1, 10)], path)
    got = _contents(spark, path)
    assert got[D10] == {(9, 9.0)} and got[D11] == {(3, 3.0)} and got[D12] == {(4, 4.0)}


def test_partition_columns_are_bigint(spark, tmpdir_fresh):
    """Partition discovery gives int; the lake reader casts back to bigint."""
    path = f"{tmpdir_fresh}/t"
    lake.backfill(_before(spark), path)
    types = dict(lake.read_lake(spark, path).dtypes)
    assert types["year"] == types["month"] == types["day"] == "bigint"


def test_empty_affected_is_noop(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/t"
    lake.backfill(_before(spark), path)
    res = lake.rewrite_partitions(spark, _before(spark), [], path)
    assert res.written == [] and len(_contents(spark, path)) == 3


def test_run_all_tables(spark, tmpdir_fresh):
    """Every spec'd table is refreshed; a table without events gets only the run day."""
    for t in ("order", "product"):
        lake.backfill(_before(spark), f"{tmpdir_fresh}/{t}")
    res = run_all(
        spark,
        scenario_log(spark),
        {"order": scenario_source_after(spark), "product": _before(spark)},
        tmpdir_fresh,
        RUN,
        specs=(TableSpec("order"), TableSpec("product")),
    )
    assert res["product"].affected == [(2024, 1, 15)]
    assert res["order"].emptied == [(2024, 1, 11)]


def _jobs_for(spark, fn):
    sc = spark.sparkContext
    group = f"g{id(fn)}{dt.datetime.now().timestamp()}"
    sc.setJobGroup(group, "count")
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


import pytest  # noqa: E402


@pytest.mark.parametrize("literal_bound", [10_000, 5])
def test_jobs_do_not_grow_with_changed_keys(spark, tmpdir_fresh, monkeypatch, literal_bound):
    """A refresh runs the same number of jobs whether 10 or 1000 keys changed, on the
    by-value lookup path and (bound lowered to 5) on the broadcast-join path."""
    from tidemark.operators import cdc

    monkeypatch.setattr(cdc, "MAX_KEY_LITERALS", literal_bound)

    def run(n, sub):
        src = spark.range(0, n).select(
            F.col("id"), F.col("id").cast("double").alias("amount"), F.lit(ep(D10, 60)).alias("updated_at"),
            F.lit(2024).cast("bigint").alias("year"), F.lit(1).cast("bigint").alias("month"),
            (F.col("id") % 20 + 1).cast("bigint").alias("day"),
        )
        log = spark.range(0, n).select(
            F.col("id").alias("event_id"), F.lit("public").alias("schema_name"), F.lit("order").alias("table_name"),
            F.lit("U").alias("action"), F.lit(ep(RUN, 60)).alias("action_tstamp_tx"), F.col("id").alias("row_data"),
            F.lit(None).cast("bigint").alias("changed_fields"), F.lit(None).cast("string").alias("client_query"),
            F.lit(False).alias("statement_only"),
        )
        path = f"{tmpdir_fresh}/{sub}"
        lake.backfill(src, path)
        jobs = _jobs_for(spark, lambda: refresh(spark, log, src, TableSpec("order"), path, RUN))
        # the refreshed lake holds exactly the source rows
        got = lake.read_lake(spark, path).select("id", "day")
        assert got.count() == n and got.exceptAll(src.select("id", "day")).count() == 0
        return jobs

    assert run(10, "a") == run(1000, "b")


def test_truncate_marks_all_partitions(spark, tmpdir_fresh):
    """B15 option: a TRUNCATE in the window rewrites (here: clears) every lake partition."""
    from helpers import log_df

    path = f"{tmpdir_fresh}/order"
    lake.backfill(_before(spark), path)
    log = log_df(spark, [(1, "order", "T", ep(RUN, 60), None, None)])
    empty = _before(spark).filter(F.lit(False))
    plain = refresh(spark, log, empty, TableSpec("order"), path, RUN)
    assert len(_contents(spark, path)) == 3 and plain.affected == [(2024, 1, 15)]
    res = refresh(spark, log, empty, TableSpec("order"), path, RUN, truncate_marks_all=True)
    assert len(res.emptied) == 4
    assert not [d for d in os.listdir(path) if d.startswith("year=")]


def test_day_filter_prunes_partitioned_source(spark, tmpdir_fresh):
    """On a date-partitioned source the day filter is a partition filter."""
    src_path = f"{tmpdir_fresh}/src"
    lake.backfill(_before(spark), src_path)
    df = lake.slice_days(lake.read_lake(spark, src_path), [20240110])
    plan = df._jdf.queryExecution().executedPlan().toString()
    part_filters = plan.split("PartitionFilters: [", 1)[1].split(", PushedFilters", 1)[0]
    # the day predicate (and its implied year/month/day filters) is evaluated on partition values
    assert "(year#" in part_filters and "= 2024)" in part_filters and "(month#" in part_filters
    assert df.count() == 2


def test_result_is_complete_at_any_size(spark, tmpdir_fresh):
    """The same path and the same result object for two affected days and for thirty thousand, given as rows."""
    days = [(2024, 1, 10), (2024, 1, 11)]
    many = spark.range(30_000).select(F.date_add(F.lit(D10), F.col("id").cast("int")).alias("d"))
    many = many.select(*[f("d").cast("bigint").alias(c) for f, c in ((F.year, "year"), (F.month, "month"), (F.dayofmonth, "day"))])
    small = spark.createDataFrame(days + days + [(None, 1, 1)], "year bigint, month bigint, day bigint")
    for name, affected in (("small", small), ("large", many)):
        path = f"{tmpdir_fresh}/{name}"
        lake.backfill(_before(spark), path)
        res = lake.rewrite_partitions(spark, src_df(spark, [(9, 9, D10)]), affected, path)
        assert res.written == [(2024, 1, 10)]
        assert len(res.affected) == (2 if name == "small" else 30_000)
        assert set(res.emptied) == set(res.affected) - {(2024, 1, 10)}
        want = {D10: {(9, 9.0)}} | ({D12: {(4, 4.0)}} if name == "small" else {})
        assert _contents(spark, path) == want
        assert not os.path.exists(f"{path}/year=2024/month=1/day=11")


def test_clearing_removes_emptied_parents_only(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/t"
    lake.backfill(src_df(spark, [(1, 1, D10), (2, 2, dt.date(2023, 5, 1)), (3, 3, dt.date(2023, 6, 1))]), path)
    assert lake.clear_partitions(spark, path, [(2023, 5, 1), (2024, 1, 10), (2022, 1, 1), (2024, 1, 11)]) == 2
    assert sorted(d for d in os.listdir(path) if d.startswith("year")) == ["year=2023"]
    assert [d for d in os.listdir(f"{path}/year=2023") if d.startswith("month")] == ["month=6"]


def test_hot_day_is_split_across_files(spark, tmpdir_fresh):
    """A day holding 80% of the rows is written by several tasks, not one: the rebalance
    before each write lets AQE split the hot partition (backfill and rewrite alike)."""
    src = spark.range(0, 400000, numPartitions=8).select(
        F.col("id"), F.col("id").cast("double").alias("amount"), F.lit(ep(D10, 60)).alias("updated_at"),
        F.lit(2024).cast("bigint").alias("year"), F.lit(1).cast("bigint").alias("month"),
        F.when(F.col("id") % 10 < 8, F.lit(10)).otherwise(F.col("id") % 5 + 11).cast("bigint").alias("day"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        path = f"{tmpdir_fresh}/hot"
        lake.backfill(src, path)
        hot = f"{path}/year=2024/month=1/day=10"
        n_backfill = len([f for f in os.listdir(hot) if f.endswith(".parquet")])
        lake.rewrite_partitions(spark, src, [(2024, 1, 10), (2024, 1, 11)], path)
        n_rewrite = len([f for f in os.listdir(hot) if f.endswith(".parquet")])
    finally:
        spark.conf.set(key, old)
    assert n_backfill > 1 and n_rewrite > 1
    assert lake.read_lake(spark, path).count() == 400000


def test_day_filter_reaches_flat_source_scan(spark, tmpdir_fresh):
    """On a source that is not date-partitioned, the implied year/month/day filters are
    pushed to the parquet scan (row groups skipped), and the exact day key still holds."""
    src_path = f"{tmpdir_fresh}/flat"
    _before(spark).write.parquet(src_path)
    df = lake.slice_days(spark.read.parquet(src_path), [20240110, 20240212])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [", 1)[1].split("], ", 1)[0]
    assert "EqualTo(year,2024)" in pushed and "In(month" in pushed and "In(day" in pushed
    assert sorted(r.id for r in df.collect()) == [1, 2]  # 2024-02-10 and 2024-01-12 are not asked for


def test_few_changed_keys_are_looked_up_by_value(spark, tmpdir_fresh):
    """Under MAX_KEY_LITERALS the source is filtered with key IN (..), pushed to the scan,
    and gives the same days as the join path."""
    from tidemark.functions.timeutil import day_window
    from tidemark.operators import cdc
    from tidemark.operators.keysets import bounded_key_values

    src_path = f"{tmpdir_fresh}/src"
    scenario_source_after(spark).write.parquet(src_path)
    source = spark.read.parquet(src_path)
    lo, hi = day_window(RUN)
    net = cdc.net_actions(scenario_log(spark), "order", lo, hi)
    ui = ("U", "I")  # net-updated key 1, net-inserted keys 5 and 6 (as with include_insert_dates)
    values = bounded_key_values(net.filter(F.col("net_action").isin(*ui)), "id")
    assert values == [1, 5, 6] and bounded_key_values(net, "id", max_rows=2) is None
    by_value = cdc.update_dates(net, source, "order", source_actions=ui, key_values=values)
    plan = by_value._jdf.queryExecution().executedPlan().toString()
    assert "In(id, [1,5,6])" in plan.split("PushedFilters: [", 1)[1]
    by_join = cdc.update_dates(net, source, "order", source_actions=ui)
    assert sorted(map(tuple, by_value.collect())) == sorted(map(tuple, by_join.collect())) == [(2024, 1, 10), (2024, 1, 15)]


def test_run_all_concurrent_equals_sequential(spark, tmpdir_fresh):
    """Tables refreshed from concurrent driver threads end up exactly as when run one by one."""
    from tidemark.specs import DEFAULT_SPECS

    sources = {s.name: (scenario_source_after(spark) if s.name == "order" else _before(spark)) for s in DEFAULT_SPECS}
    results = {}
    for par in (1, 5):
        root = f"{tmpdir_fresh}/p{par}"
        for s in DEFAULT_SPECS:
            lake.backfill(_before(spark), f"{root}/{s.folder}")
        res = run_all(spark, scenario_log(spark), sources, root, RUN, max_parallel=par)
        results[par] = (
            {t: (r.affected, r.emptied) for t, r in res.items()},
            {s.name: _contents(spark, f"{root}/{s.folder}") for s in DEFAULT_SPECS},
        )
    assert results[1] == results[5]
    assert results[5][1]["order"] == {D10: {(1, 11.0), (2, 2.0)}, D12: {(4, 4.0)}, RUN: {(5, 5.0), (6, 6.0)}}


def test_every_spec_needs_a_source(spark, tmpdir_fresh):
    from tidemark.plans.refresh import affected_all_tables

    specs = (TableSpec("order"), TableSpec("product"))
    for call in (
        lambda: run_all(spark, scenario_log(spark), {"order": _before(spark)}, tmpdir_fresh, RUN, specs=specs),
        lambda: affected_all_tables(spark, scenario_log(spark), {'"order"': _before(spark)}, RUN, specs=specs),
    ):
        with pytest.raises(ValueError, match="product"):
            call()
    with pytest.raises(ValueError, match="mode"):
        run_all(spark, None, {"order": _before(spark)}, tmpdir_fresh, specs=specs[:1], mode="other")


def test_run_all_backfill_and_options(spark, tmpdir_fresh):
    """Backfill of all tables, then a refresh with the wider options: a moved row leaves its old day."""
    from helpers import log_df
    from tidemark.plans.refresh import Options

    specs = (TableSpec("order"), TableSpec("product"))
    sources = {s.name: _before(spark) for s in specs}
    res = run_all(spark, None, sources, tmpdir_fresh, specs=specs, mode="backfill")
    assert res["order"].written == [(2024, 1, 10), (2024, 1, 11), (2024, 1, 12)]
    moved = src_df(spark, [(1, 1, D12), (2, 2, D10), (3, 3, D11), (4, 4, D12)])
    log = log_df(spark, [(1, "order", "U", ep(RUN, 60), 1, None), (2, "product", "T", ep(RUN, 61), None, None)])
    options = Options(include_insert_dates=True, include_previous_partition=True, truncate_marks_all=True, one_source_state=True)
    empty = _before(spark).filter(F.lit(False))
    run_all(spark, log, {"order": moved, "product": empty}, tmpdir_fresh, RUN, specs=specs, options=options)
    got = _contents(spark, f"{tmpdir_fresh}/order")
    assert got == {D10: {(2, 2.0)}, D11: {(3, 3.0)}, D12: {(1, 1.0), (4, 4.0)}}
    assert not [d for d in os.listdir(f"{tmpdir_fresh}/product") if d.startswith("year=")]


def test_run_job_reads_by_spec(spark, tmpdir_fresh):
    """The daily program on parquet sources: tables and log are read by their specs."""
    from tidemark.plans.refresh import run_job

    specs = (TableSpec("order", source_name="orders_v2"),)
    _before(spark).write.parquet(f"{tmpdir_fresh}/in0/orders_v2")
    scenario_source_after(spark).write.parquet(f"{tmpdir_fresh}/in1/orders_v2")
    scenario_log(spark).write.parquet(f"{tmpdir_fresh}/log")
    root = f"{tmpdir_fresh}/lakes"
    at = lambda k: lambda s: f"{tmpdir_fresh}/in{k}/{s.source}"
    run_job(spark, root, "backfill", specs=specs, fmt="parquet", source_path=at(0))
    run_job(spark, root, "refresh", RUN, specs=specs, fmt="parquet", source_path=at(1), log_path=f"{tmpdir_fresh}/log")
    assert _contents(spark, f"{root}/order") == {D10: {(1, 11.0), (2, 2.0)}, D12: {(4, 4.0)}, RUN: {(5, 5.0), (6, 6.0)}}


def test_refresh_in_a_zone_covers_its_evening(spark, tmpdir_fresh):
    """A row inserted late on the zone's 15th (the 16th in UTC) belongs to the run of the 15th."""
    from helpers import log_df

    path = f"{tmpdir_fresh}/order"
    t = ep(dt.date(2024, 1, 16), 2 * 3600)  # 21:00 on the 15th in New York
    lake.backfill(src_df(spark, [(1, 1, RUN)]), path)
    after = src_df(spark, [(1, 1, RUN), (2, 2, RUN)])
    log = log_df(spark, [(1, "order", "I", t, 2, None)])
    res = refresh(spark, log, after, TableSpec("order"), path, RUN, zone="America/New_York")
    assert res.affected == [(2024, 1, 15)]
    assert _contents(spark, path) == {RUN: {(1, 1.0), (2, 2.0)}}


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from tidemark import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(Session())
