"""Plans of the inner steps: sized key sets, one scan per table, zones, settings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import ep, log_df, src_df
from tidemark.functions.timeutil import day_window, epoch_to_date
from tidemark.operators import cdc, quality
from tidemark.sources import jdbc

RUN = dt.date(2024, 1, 15)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def stored(spark, tmpdir_fresh):
    days = [RUN - dt.timedelta(days=k) for k in range(5)]
    src_df(spark, [(i, i, days[i % 5]) for i in range(200)]).write.parquet(f"{tmpdir_fresh}/src")
    log_df(spark, [(i, "order", "U", ep(RUN, i), i, None) for i in range(50)]).write.parquet(f"{tmpdir_fresh}/log")
    return spark.read.parquet(f"{tmpdir_fresh}/src"), spark.read.parquet(f"{tmpdir_fresh}/log")


def test_public_affected_set_does_not_shuffle_the_source(spark, stored, monkeypatch):
    """With planner broadcasts off, as at scale, sized keys are broadcast; above the bound both sides shuffle."""
    source, log = stored
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        below = cdc.affected_partitions(spark, log, source, "order", RUN)
        assert "SortMergeJoin" not in plan_of(below) and "BroadcastHashJoin" in plan_of(below)
        rows = sorted(map(tuple, below.collect()))
        monkeypatch.setattr(cdc, "MAX_BROADCAST_KEYS", 10)
        above = cdc.affected_partitions(spark, log, source, "order", RUN)
        assert "SortMergeJoin" in plan_of(above)
        assert sorted(map(tuple, above.collect())) == rows and len(rows) == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_column_checks_scan_a_table_once(spark, stored):
    source, _ = stored
    for df in (quality.dq_not_null(source, "order", source.columns), quality.dq_length(source.withColumn("a", F.lit("x")).withColumn("b", F.lit("yy")), "t", {"a": 1, "b": 1})):
        assert plan_of(df).count("FileScan") == 1
    assert [r.n_violations for r in quality.dq_length(source.select(F.lit("x").alias("a"), F.lit("yy").alias("b")), "t", {"a": 1, "b": 1}).collect()] == [0, 200]


def test_zone_dates_do_not_depend_on_the_session_zone(spark):
    want = {
        (1705334400, "Asia/Tokyo"): dt.date(2024, 1, 16), (1705334400, "America/New_York"): dt.date(2024, 1, 15),
        (1710054000, "America/New_York"): dt.date(2024, 3, 10), (-1, "Asia/Tokyo"): dt.date(1970, 1, 1),
        (-1, "America/New_York"): dt.date(1969, 12, 31),
    }
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session)
            for (e, zone), day in want.items():
                got = spark.range(1).select(epoch_to_date(F.lit(e).cast("bigint"), zone).alias("d")).first().d
                assert got == day, (session, e, zone)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_zone_window_is_the_zones_days(spark):
    for zone, hours in ((None, 24), ("America/New_York", 23), ("Asia/Tokyo", 24)):
        day = dt.date(2024, 3, 10)  # clocks go forward in New York
        lo, hi = day_window(day, 0, zone)
        assert hi - lo + 1 == hours * 3600
        e = spark.createDataFrame([(lo - 1,), (lo,), (hi,), (hi + 1,)], "e bigint")
        got = [r.d for r in e.select("e", epoch_to_date("e", zone).alias("d")).orderBy("e").collect()]
        assert got == [day - dt.timedelta(days=1), day, day, day + dt.timedelta(days=1)]


def test_unset_connection_variable_is_named(monkeypatch):
    monkeypatch.delenv("DB_URL", raising=False)
    with pytest.raises(ValueError, match="DB_URL"):
        jdbc.jdbc_options("t")
    for name in ("DB_URL", "DB_USER", "DB_PW"):
        monkeypatch.setenv(name, "x")
    assert jdbc.jdbc_options("t")["user"] == "x"


def test_changelog_source_reads_the_window_only(spark, stored, tmpdir_fresh):
    log = jdbc.read_changelog_source(spark, lo=ep(RUN, 10), hi=ep(RUN, 19), fmt="parquet", path=f"{tmpdir_fresh}/log")
    assert log.count() == 10 and "GreaterThanOrEqual(action_tstamp_tx" in plan_of(log)
