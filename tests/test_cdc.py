"""Change-log resolution on literal rows: the worked scenario and edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import ep, log_df, src_df
from tidemark.functions.timeutil import day_window
from tidemark.operators import cdc

RUN = dt.date(2024, 1, 15)
D10, D11, D12, D14 = (dt.date(2024, 1, d) for d in (10, 11, 12, 14))
LO, HI = day_window(RUN)


def scenario_log(spark):
    t = ep(RUN, 3600)
    return log_df(
        spark,
        [
            (1, "order", "U", t, 1, None),
            (2, "order", "D", t + 1, 3, ep(D11, 3600)),
            (3, "order", "I", t + 2, 5, None),
            (4, "order", "I", t + 3, 6, None),
            (5, "order", "U", t + 4, 6, None),
            (6, "order", "I", t + 5, 7, None),
            (7, "order", "D", t + 6, 7, ep(RUN, 3600)),
            (8, "order", "T", t + 7, None, None),
            (9, "customer", "D", t + 8, 4, ep(D12, 3600)),
            (10, "order", "U", ep(D14, 3600), 2, None),
        ],
    )


def scenario_source_after(spark):
    return src_df(spark, [(1, 11, D10), (2, 2, D10), (4, 4, D12), (5, 5, RUN), (6, 6, RUN)])


def test_id_sets(spark):
    ids = cdc.cdc_ids(scenario_log(spark), "order", LO, HI).collect()
    got = {a: {r.row_data for r in ids if r.action == a} for a in "IUD"}
    assert got == {"I": {5, 6, 7}, "U": {1, 6}, "D": {3, 7}}


def test_net_change_precedence(spark):
    net = cdc.net_changes(scenario_log(spark), "order", LO, HI).collect()
    assert {r.id: r.net_action for r in net} == {1: "U", 3: "D", 5: "I", 6: "I", 7: "D"}
    assert {r.id: r.deleted_updated_at for r in net if r.net_action == "D"} == {3: ep(D11, 3600), 7: ep(RUN, 3600)}


def test_net_sets_are_disjoint(spark):
    net = cdc.net_changes(scenario_log(spark), None, LO, HI)
    assert net.groupBy("table_name", "change_date", "id").count().filter("count > 1").count() == 0


def _dates(df):
    return {dt.date(r.year, r.month, r.day) for r in df.collect()}


def test_affected_dates(spark):
    log, src = scenario_log(spark), scenario_source_after(spark)
    net = cdc.net_changes(log, "order", LO, HI)
    assert _dates(cdc.affected_update_dates(net, src, "order")) == {D10}
    assert _dates(cdc.affected_delete_dates(log, "order", LO, HI)) == {D11, RUN}
    assert _dates(cdc.affected_partitions(spark, log, src, "order", RUN)) == {D10, D11, RUN}


def test_other_table_delete_ignored(spark):
    """B2: a delete of the same id in another table never supplies a date."""
    net = cdc.net_changes(scenario_log(spark), "order", LO, HI)
    assert 4 not in {r.id for r in net.collect()}


def test_empty_log(spark):
    log = log_df(spark, []).limit(0)
    src = scenario_source_after(spark)
    assert _dates(cdc.affected_partitions(spark, log, src, "order", RUN)) == {RUN}


def test_update_of_id_gone_from_source(spark):
    """An updated key missing from the source drops out instead of failing."""
    log = log_df(spark, [(1, "order", "U", ep(RUN, 60), 99, None)])
    net = cdc.net_changes(log, "order", LO, HI)
    assert cdc.affected_update_dates(net, scenario_source_after(spark), "order").count() == 0


def test_delete_then_insert_nets_to_delete(spark):
    log = log_df(spark, [(1, "order", "D", ep(RUN, 60), 5, ep(D12)), (2, "order", "I", ep(RUN, 120), 5, None)])
    (row,) = cdc.net_changes(log, "order", LO, HI).collect()
    assert row.net_action == "D" and row.deleted_updated_at == ep(D12)


def test_latest_delete_supplies_date(spark):
    log = log_df(
        spark,
        [(2, "order", "D", ep(RUN, 60), 5, ep(D10)), (1, "order", "D", ep(RUN, 60), 5, ep(D11)),
         (3, "order", "D", ep(RUN, 30), 5, ep(D12))],
    )
    (row,) = cdc.net_changes(log, "order", LO, HI).collect()
    assert row.deleted_updated_at == ep(D10)  # latest time, then highest event id


def test_window_edges(spark):
    log = log_df(
        spark,
        [(1, "order", "U", LO - 1, 1, None), (2, "order", "U", LO, 2, None),
         (3, "order", "U", LO + 86399, 3, None), (4, "order", "U", LO + 86400, 4, None)],
    )
    got = {r.row_data for r in cdc.changelog_window(log, "order", LO, HI).collect()}
    assert got == {2, 3}


def test_statement_rows_dropped(spark):
    """Statement-level rows (NULL key) never reach the id sets."""
    log = log_df(spark, [(1, "order", "T", ep(RUN, 60), None, None), (2, "order", "U", ep(RUN, 60), None, None)])
    assert cdc.net_changes(log, "order", LO, HI).count() == 0


def test_days_back_window(spark):
    """A multi-day window nets per day and adds every run day."""
    log = scenario_log(spark)
    aff = cdc.affected_partitions(spark, log, scenario_source_after(spark), "order", RUN, days_back=1)
    assert {D14, RUN}.issubset(_dates(aff))


def test_include_insert_dates(spark):
    """B13 option: an insert whose source date is not today still has its partition rewritten."""
    log = log_df(spark, [(1, "order", "I", ep(RUN, 60), 4, None)])
    src = scenario_source_after(spark)
    base = _dates(cdc.affected_partitions(spark, log, src, "order", RUN))
    opt = _dates(cdc.affected_partitions(spark, log, src, "order", RUN, include_insert_dates=True))
    assert base == {RUN} and opt == {RUN, D12}


def test_include_previous_partition(spark):
    """B3 option: a touched row's old partition is rewritten too."""
    lake_df = src_df(spark, [(1, 1, D11)])
    src = src_df(spark, [(1, 1, D12)])
    log = log_df(spark, [(1, "order", "U", ep(RUN, 60), 1, None)])
    got = _dates(cdc.affected_partitions(spark, log, src, "order", RUN, include_previous_partition=True, lake=lake_df))
    assert got == {RUN, D11, D12}


def test_emptied_partitions(spark):
    aff = spark.createDataFrame([(2024, 1, 10), (2024, 1, 11)], "year bigint, month bigint, day bigint")
    got = _dates(cdc.emptied_partitions(aff, scenario_source_after(spark)))
    assert got == {D11}


def test_partition_slice(spark):
    got = cdc.partition_slice(scenario_source_after(spark), 2024, 1, 10).select("id").collect()
    assert sorted(r.id for r in got) == [1, 2]


def test_delete_reinsert_delete_keeps_first_partition(spark):
    """Every delete's OLD date is affected, not only the latest one's."""
    log = log_df(
        spark,
        [(1, "order", "D", ep(RUN, 60), 5, ep(D10, 3600)), (2, "order", "I", ep(RUN, 120), 5, None),
         (3, "order", "D", ep(RUN, 180), 5, ep(RUN, 120))],
    )
    aff = _dates(cdc.affected_partitions(spark, log, scenario_source_after(spark), "order", RUN))
    assert aff == {D10, RUN}
    (row,) = cdc.net_changes(log, "order", LO, HI).collect()
    assert row.net_action == "D" and row.deleted_updated_at == ep(RUN, 120)


def test_net_actions_is_hash_aggregate(spark):
    plan = cdc.net_actions(scenario_log(spark), "order", LO, HI)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_net_changes_is_hash_aggregate(spark):
    plan = cdc.net_changes(scenario_log(spark), "order", LO, HI)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_latest_delete_orders_by_time_then_event_id(spark):
    """Same second: the larger event id wins, negative and extreme ids included; a later
    second beats any event id."""
    t = ep(RUN, 600)
    big, small = 2**63 - 1, -(2**63)
    cases = {
        1: [(10, t, 100), (-5, t, 200)],  # same second: 10 > -5
        2: [(big, t, 300), (small, t + 1, 400)],  # later second wins over the largest id
        3: [(small, t, 500), (small + 1, t, 600)],
        4: [(7, t, 700), (8, t - 1, 800), (6, t, 900)],
    }
    rows = [(e, "order", "D", ts, k, cf) for k, evs in cases.items() for e, ts, cf in evs]
    got = {r.id: r.deleted_updated_at for r in cdc.net_changes(log_df(spark, rows), "order", LO, HI).collect()}
    assert got == {1: 100, 2: 400, 3: 600, 4: 700}


def test_reinserted_key_gets_its_new_day_with_insert_dates(spark):
    """Deleted, then re-inserted on another day: nets to D, yet with include_insert_dates
    its current source day is affected (the reference rule keeps only the old day)."""
    log = log_df(
        spark,
        [(1, "order", "D", ep(RUN, 60), 5, ep(D10, 3600)), (2, "order", "I", ep(RUN, 120), 5, None)],
    )
    src = src_df(spark, [(5, 5, D12)])
    assert _dates(cdc.affected_partitions(spark, log, src, "order", RUN)) == {D10, RUN}
    assert _dates(cdc.affected_partitions(spark, log, src, "order", RUN, include_insert_dates=True)) == {D10, D12, RUN}
