"""Snapshot diff, change application, touch, statement events, redaction."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import capture
from tidemark.specs import TableSpec

NOW = dt.datetime(2024, 1, 15, 12, 0, 0)
DDL = "id bigint, name string, amount double, updated_at bigint, year bigint, month bigint, day bigint"


def snap(spark, rows):
    return spark.createDataFrame([(i, n, a, u, 2024, 1, 10) for i, n, a, u in rows], DDL)


def test_diff_classifies_rows(spark):
    old = snap(spark, [(1, "a", 1.0, 100), (2, "b", 2.0, 100), (3, None, 3.0, 100), (4, "d", 4.0, 100)])
    new = snap(spark, [(1, "a", 1.0, 100), (2, "b", 2.5, 100), (3, None, 3.0, 101), (5, "e", 5.0, 100)])
    got = {(r.row_data, r.action, r.changed_fields) for r in capture.snapshot_diff(old, new, "t", now=NOW).collect()}
    assert got == {(2, "U", None), (3, "U", None), (4, "D", 100), (5, "I", None)}


def test_diff_null_safe(spark):
    old = snap(spark, [(1, None, None, 100)])
    assert capture.snapshot_diff(old, snap(spark, [(1, None, None, 100)]), "t", now=NOW).count() == 0
    assert capture.snapshot_diff(old, snap(spark, [(1, "x", None, 100)]), "t", now=NOW).count() == 1


def test_diff_ignored_columns(spark):
    """An update touching only ignored columns emits no row."""
    old = snap(spark, [(1, "a", 1.0, 100), (2, "b", 2.0, 100)])
    new = snap(spark, [(1, "a", 1.0, 999), (2, "c", 2.0, 999)])
    got = capture.snapshot_diff(old, new, "t", ignore_cols=("updated_at",), now=NOW).collect()
    assert [(r.row_data, r.action) for r in got] == [(2, "U")]


def test_event_ids_repeat_on_rerun(spark):
    old, new = snap(spark, [(1, "a", 1.0, 100)]), snap(spark, [(2, "b", 1.0, 100)])
    a = sorted(r.event_id for r in capture.snapshot_diff(old, new, "t", now=NOW).collect())
    b = sorted(r.event_id for r in capture.snapshot_diff(old, new, "t", now=NOW).collect())
    assert a == b and len(set(a)) == 2


def test_statement_events_and_truncate(spark):
    old = snap(spark, [(1, "a", 1.0, 100), (2, "b", 2.0, 100)])
    new = snap(spark, [(1, "a", 1.5, 100), (3, "c", 3.0, 100)])
    got = {(r.action, r.n_rows) for r in capture.statement_events(old, new, "t").collect()}
    assert got == {("I", 1), ("U", 1), ("D", 1)}
    trunc = capture.statement_events(old, new.filter(F.lit(False)), "t").collect()
    assert [(r.action, r.n_rows, r.row_data, r.statement_only) for r in trunc] == [("T", 2, None, True)]
    assert capture.statement_events(old, old, "t").count() == 0


rows_st = st.dictionaries(st.integers(0, 30), st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_st, rows_st)
def test_apply_diff_gives_new(spark, o, n):
    """apply_changes(old, snapshot_diff(old, new), new) == new."""
    old = snap(spark, [(k, v[0], float(v[1]), 100) for k, v in o.items()])
    new = snap(spark, [(k, v[0], float(v[1]), 100) for k, v in n.items()])
    out = capture.apply_changes(old, capture.snapshot_diff(old, new, "t", now=NOW), new)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, new.collect()), key=repr)


def test_touch_rows_real_month_and_day(spark):
    """B4 fixed: touched rows get the real month and day of now, not the year."""
    df = snap(spark, [(1, "a", 1.0, 100), (2, "b", 2.0, 100)])
    out = {r.id: r for r in capture.touch_rows(df, spark.createDataFrame([(1,)], "id bigint"), NOW).collect()}
    assert (out[1].year, out[1].month, out[1].day, out[1].updated_at) == (2024, 1, 15, 1705320000)
    assert (out[2].day, out[2].updated_at) == (10, 100)


def test_redact_query_text_null_flag_keeps_text(spark):
    log = spark.createDataFrame([("a", "q1"), ("b", "q2"), ("c", "q3")], "table_name string, client_query string")
    specs = (TableSpec("a", audit_query_text=False), TableSpec("b", audit_query_text=None), TableSpec("c"))
    got = {r.table_name: r.client_query for r in capture.redact_query_text(log, specs).collect()}
    assert got == {"a": None, "b": "q2", "c": "q3"}


def test_first_letter(spark):
    df = spark.createDataFrame([("INSERT",), ("truncate",)], "op string")
    assert [r[0] for r in df.select(capture.first_letter("op")).collect()] == ["I", "T"]


def test_diff_session_columns(spark):
    old, new = snap(spark, [(1, "a", 1.0, 100)]), snap(spark, [])
    r = capture.snapshot_diff(old, new, "t", now=NOW, session_columns=True).first()
    assert r.action == "D" and r.session_user_name and r.application_name == spark.conf.get("spark.app.name")


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_apply_changes_streams_base_when_change_set_is_small(spark):
    """A change set under the bound is broadcast, so the large sides are never shuffled;
    above the bound (here 0) the shuffled plan gives the same rows."""
    base = spark.range(0, 20000).select(
        F.col("id"), F.lit("x").alias("name"), F.col("id").cast("double").alias("amount"),
        F.lit(100).cast("bigint").alias("updated_at"), F.lit(2024).cast("bigint").alias("year"),
        F.lit(1).cast("bigint").alias("month"), F.lit(10).cast("bigint").alias("day"),
    )
    new = base.filter(F.col("id") != 5).withColumn(
        "amount", F.when(F.col("id") == 7, F.lit(-1.0)).otherwise(F.col("amount"))
    ).unionByName(base.filter(F.col("id") == 0).withColumn("id", F.lit(99999).cast("bigint")))
    changes = capture.snapshot_diff(base, new, "t", now=NOW)
    small = capture.apply_changes(base, changes, new)
    plan = _final_plan(small)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning(id" not in plan  # neither base nor new is shuffled on the key
    shuffled = capture.apply_changes(base, changes, new, max_broadcast_keys=0)
    want = sorted(map(tuple, new.collect()))
    assert sorted(map(tuple, small.collect())) == want
    assert sorted(map(tuple, shuffled.collect())) == want
