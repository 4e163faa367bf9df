"""Defaults, seeds, backdating, quality checks, extraction, time helpers, file scans."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import exprs
from tidemark.functions.timeutil import day_window, epoch_seconds, epoch_to_date, partition_path
from tidemark.operators import extract, quality, seed
from tidemark.sinks import lake
from tidemark.sources import files, jdbc

NOW = dt.datetime(2024, 1, 15, 12, 0, 0)


def test_day_window_is_zone_free():
    assert day_window(dt.date(2024, 1, 15)) == (1705276800, 1705276800 + 86399)
    assert day_window(dt.date(2024, 1, 15), 1)[0] == 1705276800 - 86400


def test_epoch_to_date_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = spark.range(1).select(epoch_to_date(F.lit(1705276800)).alias("d")).first().d
        assert got == dt.date(2024, 1, 15)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_seconds_ignores_session_zone(spark):
    """A wall time inside New York's spring-forward gap still reads as UTC seconds."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.sql(
                "SELECT timestamp_ntz'2024-03-10 02:30:00' AS ts UNION ALL SELECT timestamp_ntz'2024-11-03 01:30:00'"
            )
            got = sorted(r.e for r in df.select(epoch_seconds("ts").alias("e")).collect())
            assert got == [1710037800, 1730597400], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_partition_path_unpadded(spark):
    df = spark.createDataFrame([(2024, 1, 5)], "year bigint, month bigint, day bigint")
    assert df.select(partition_path()).first()[0] == "year=2024/month=1/day=5"


def test_with_defaults_only_absent_columns(spark):
    """Absent columns get defaults, an explicit NULL stays NULL."""
    df = spark.createDataFrame([(1, "n", None)], "id bigint, name string, contact string")
    r = exprs.with_defaults(df, "customer", NOW).first()
    assert r.contact is None and r.address == "somewhere" and r.credit_limit == 44.0
    assert (r.year, r.month, r.day, r.created_at) == (2024, 1, 15, 1705320000)


def test_backdate_bands_strict(spark):
    ids = [5, 9999, 10000, 10001, 20000, 20001, 40000, 45000, 60000, 70000, 80000, 90000]
    df = seed.seed_table(spark.createDataFrame([(i,) for i in ids], "k bigint"), "order", "k", NOW)
    got = {r.id: r.created_at for r in seed.seed_backdate(df, NOW).collect()}
    now = 1705320000
    expect = {5: 49, 9999: 49, 10001: 39, 20001: 29, 45000: 19, 70000: 9}
    for i in ids:
        assert got[i] == now - 86400 * expect.get(i, 0)


def test_seed_names_are_md5(spark):
    df = seed.seed_table(spark.createDataFrame([(7,)], "k bigint"), "customer", "k", NOW).first()
    import hashlib

    assert df.name == hashlib.md5(b"7").hexdigest()


def test_quality_checks(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (3, 99), (4, None), (4, 10)], "id bigint, fk bigint")
    parent = spark.createDataFrame([(10,)], "pk bigint")
    assert quality.dq_fk_orphans(child, "fk", parent, "pk", "c").first().n_violations == 1
    assert quality.dq_pk_duplicates(child, "c", ["id"]).first().n_violations == 1
    assert {r.column_name: r.n_violations for r in quality.dq_not_null(child, "c", ["id", "fk"]).collect()} == {"id": 0, "fk": 1}
    log = spark.createDataFrame([("I",), ("X",), (None,)], "action string")
    assert quality.dq_action_domain(log).first().n_violations == 1
    s = spark.createDataFrame([("x" * 51,), ("ok",)], "name string")
    assert quality.dq_length(s, "t", {"name": 50}).first().n_violations == 1


def test_incremental_extract_drops_nulls(spark):
    df = spark.createDataFrame([(1, 5), (2, 10), (3, None)], "id bigint, updated_at bigint")
    assert [r.id for r in extract.incremental_extract(df, 5).collect()] == [2]


def test_audited_tables_sorted(spark):
    log = spark.createDataFrame([("public", "b", "I"), ("public", "a", "T"), ("public", "b", "U")],
                                "schema_name string, table_name string, action string")
    assert [r.audited_table for r in extract.audited_tables(log).collect()] == ["a", "b"]


def test_flat_export_fails_if_exists(spark, tmpdir_fresh):
    df = spark.range(3)
    lake.export_flat(df, f"{tmpdir_fresh}/x")
    try:
        lake.export_flat(df, f"{tmpdir_fresh}/x")
    except Exception:  # noqa: BLE001
        return
    raise AssertionError("second export should fail")


def test_single_file_keeps_partition_columns(spark, tmpdir_fresh):
    """A named part file read with basePath keeps year/month/day."""
    df = spark.createDataFrame([(1, 2024, 1, 2)], "id bigint, year bigint, month bigint, day bigint")
    lake.backfill(df, tmpdir_fresh + "/l")
    f = files.first_file(spark, tmpdir_fresh + "/l")
    cols = files.scan_parquet_files(spark, [f], tmpdir_fresh + "/l").columns
    assert {"year", "month", "day"}.issubset(cols)


def test_scan_by_name_reads_every_file_of_a_month(spark, tmpdir_fresh):
    from tidemark.plans.registry import q_scan_parquet_file

    li = spark.range(1200).select(F.expr("make_date(1996, 1 + CAST(id % 12 AS INT), 5)").alias("l_shipdate"), "id")
    li.write.parquet(tmpdir_fresh + "/lineitem.parquet")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "30")
    try:
        rows = q_scan_parquet_file(spark, tmpdir_fresh).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert {(r["year"], r["month"]): r["n_rows"] for r in rows} == {(1996, m): 100 for m in range(1, 13)}


def test_jdbc_options_partitioned(monkeypatch):
    monkeypatch.setenv("DB_URL", "jdbc:x://h/db")
    monkeypatch.setenv("DB_USER", "u")
    monkeypatch.setenv("DB_PW", "p")
    o = jdbc.jdbc_options('"order"', partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4)
    assert o["url"] == "jdbc:x://h/db" and o["numPartitions"] == "4" and o["dbtable"] == '"order"'


def test_sized_conf_clamps_shuffle_partitions():
    from tidemark.session import TARGET_PARTITION_BYTES, sized_conf

    assert sized_conf(60 * 10**6, 8)["spark.sql.shuffle.partitions"] == "16"  # small input: 2 per core
    assert sized_conf(100 * TARGET_PARTITION_BYTES, 8)["spark.sql.shuffle.partitions"] == "64"  # capped at 8 per core
    assert sized_conf(100 * 10**12, 8000)["spark.sql.shuffle.partitions"] == "64000"
    assert sized_conf(1000 * TARGET_PARTITION_BYTES, 400)["spark.sql.shuffle.partitions"] == "1000"


def test_fk_orphans_of_several_keys_at_once(spark):
    child = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, None, "a"), (None, 9, None), (3, 9, "c")], "x long, y int, z string")
    other = spark.createDataFrame([(1,), (7,), (7,)], "x int")
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, None)], "k long, t string")
    frames = {"child": child, "other": other, "parent": parent}
    fks = [("child", "x", "parent", "k"), ("child", "y", "parent", "k"), ("other", "x", "parent", "k"), ("child", "x", "other", "x"),
           ("parent", "k", "child", "x")]
    for own in (fks, fks + [("child", "z", "parent", "t")], fks[:1]):
        df = quality.dq_fk_orphans_all(frames, own)
        got = {(r["table_name"], r["column_name"], i): r["n_violations"] for i, r in enumerate(df.collect())}
        want = {(c, k, i): quality.dq_fk_orphans(frames[c], k, frames[p], pk, c).first()["n_violations"] for i, (c, k, p, pk) in enumerate(own)}
        assert got == want and sum(want.values()) > 0
    plan = quality.dq_fk_orphans_all(frames, fks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
