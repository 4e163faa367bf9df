"""Kept watermark over changing sources, and drift against a full comparison."""

import datetime as dt
import random

import pytest
from helpers import src_df
from pyspark.sql import functions as F
from tidemark.operators import drift as D
from tidemark.operators.watermark import Watermark
from tidemark.sinks import lake

ROWS = "id bigint, updated_at bigint, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, f"{i}-{u}") for i, u in rows], ROWS)


def take(spark, path, rows, overlap=0, commit=True):
    mark = Watermark(spark, path, overlap=overlap)
    taken = mark.extract(frame(spark, rows))
    got = sorted((r["id"], r["updated_at"]) for r in taken.rows.collect())
    if commit:
        mark.commit(taken)
    return got


def test_ties_and_late_rows(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/mark"
    one = [(5, 100), (7, 100), (1, 90), (2, None), (None, 95)]
    assert take(spark, path, one) == [(1, 90), (5, 100), (7, 100)]
    assert Watermark(spark, path).current()["value"] == 100 and Watermark(spark, path).current()["key"] == 7
    # a smaller and a greater key at the watermark itself come; what is below it does not
    assert take(spark, path, one + [(6, 100), (8, 100), (3, 99)]) == [(6, 100), (8, 100)]
    assert take(spark, path, one + [(6, 100), (8, 100), (3, 99)]) == []
    assert take(spark, path, one + [(6, 100), (8, 100), (5, 101)]) == [(5, 101)]  # a new version of a row
    assert take(spark, path, []) == []


def test_a_stopped_run_takes_the_same_rows_again(spark, tmpdir_fresh):
    path, rows = f"{tmpdir_fresh}/mark", [(1, 10), (2, 20)]
    assert take(spark, path, rows, commit=False) == take(spark, path, rows) == [(1, 10), (2, 20)]
    frame(spark, [(2, 30)]).select("id", "updated_at").write.parquet(f"{path}/kept-left-behind")  # stopped before the rename
    assert take(spark, path, rows + [(2, 30)]) == [(2, 30)]
    assert len([n for n in Watermark(spark, path).files.folders(path) if n.startswith("kept-")]) == 1


def test_every_version_within_the_overlap_comes_once(spark, tmpdir_fresh):
    r, path, overlap, visible, seen = random.Random(2), f"{tmpdir_fresh}/mark", 25, [], []
    late = []
    for now in range(0, 120, 20):  # rows of the last 20 ticks, some of which become visible one or two runs later
        new = [(r.randrange(40), now + r.randrange(20)) for _ in range(15)]
        visible += late + [x for x in new if r.random() < 0.7]
        late = [x for x in new if x not in visible]
        seen += take(spark, path, visible, overlap)
    seen += take(spark, path, visible + late, overlap)
    assert sorted(set(visible + late)) == sorted(set(seen)) and len(seen) == len(set(visible + late)) + sum(
        visible.count(x) - 1 for x in set(visible) if visible.count(x) > 1 and seen.count(x) > 1)


def test_the_bound_reaches_the_scan(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/mark"
    frame(spark, [(i, i) for i in range(100)]).write.parquet(f"{tmpdir_fresh}/source")
    source = spark.read.parquet(f"{tmpdir_fresh}/source")
    mark = Watermark(spark, path)
    mark.commit(mark.extract(source))
    state = mark.current()
    plan = source.where(F.col("updated_at") >= state["value"] - mark.overlap)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updated_at,99)" in plan
    assert mark.extract(source).upper is None


D1 = dt.date(2024, 1, 1)


def full(a, b):
    a, b = ({(r[0], r[2]): r for r in x} for x in (a, b))
    return sorted((k, "both" if k in a and k in b else "lake" if k in a else "source") for k in a.keys() | b.keys() if a.get(k) != b.get(k))


@pytest.mark.parametrize("span", [1, 7, 100_000])
def test_drift_equals_a_full_comparison(spark, tmpdir_fresh, span):
    r = random.Random(3)
    base = [(i, r.randint(1, 5), D1 + dt.timedelta(days=i % 9)) for i in range(-50, 200)]
    other = [x for x in base if x[0] % 61] + [(900, 1, D1), (901, 1, dt.date(2025, 5, 5))]
    other = [(i, a + 1 if i in (10, 11) else a, D1 + dt.timedelta(days=3) if i == 77 else d) for i, a, d in other]
    lake.backfill(src_df(spark, base), f"{tmpdir_fresh}/lake")
    stored = lake.read_lake(spark, f"{tmpdir_fresh}/lake")
    source = src_df(spark, other)
    got = [((x["id"], dt.date(x["year"], x["month"], x["day"])), x["side"]) for x in D.drift(stored, source, span=span).collect()]
    want = full(base, other)
    assert sorted(got) == want
    days = {tuple(x) for x in D.drifted_days(stored, source).collect()}
    assert days == {(d.year, d.month, d.day) for (_, d), _ in want}
    # the drifted days are what a rewrite needs, without any log
    lake.rewrite_partitions(spark, source, sorted(days), f"{tmpdir_fresh}/lake")
    assert D.drift(lake.read_lake(spark, f"{tmpdir_fresh}/lake"), source, span=span).count() == 0


def test_digests_tell_nulls_and_copies_apart(spark):
    ddl = "id bigint, a string, b string, year bigint, month bigint, day bigint"
    f = lambda rows: spark.createDataFrame([(*r, 2024, 1, 1) for r in rows], ddl)
    cases = [([(1, None, "x")], [(1, "x", None)]), ([(1, "", None)], [(1, None, "")]), ([(1, "a", "b")] * 2, [(1, "a", "b")] * 4),
             ([(1, "a", "b"), (2, "c", "d")], [(1, "c", "d"), (2, "a", "b")]), ([(None, "a", "b")], [(None, "a", "c")])]
    for a, b in cases:
        assert D.drifted_days(f(a), f(b)).count() == 1 and D.drifted_days(f(a), f(a)).count() == 0
    assert [r["side"] for r in D.drift(f(cases[-1][0]), f(cases[-1][1])).collect()] == ["both"]
