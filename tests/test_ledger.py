"""Run ledger: gaps against a per-second count, missed days, resumed backfill, compaction."""

import datetime as dt
import random

import pytest
from helpers import ep, log_df, src_df
from pyspark.sql import functions as F
from tidemark.plans import ledger as L
from tidemark.plans.refresh import refresh
from tidemark.sinks import lake
from tidemark.specs import TableSpec

WINDOWS = "table_name string, lo bigint, hi bigint"
DAY = dt.timedelta(days=1)
FIRST = dt.date(2024, 1, 10)


def names(spark, *tables):
    return spark.createDataFrame([(t,) for t in tables], "table_name string")


def test_gaps_against_every_second(spark):
    r = random.Random(1)
    rows = [(r.choice("ab"), lo, lo + r.choice([-1, 0, 0, 3, 10])) for lo in (r.randint(-20, 120) for _ in range(30))]
    rows += [("a", 0, 5), ("a", 6, 7), ("a", 1, 2), ("z", 0, 99)]
    got = L.gaps(spark.createDataFrame(rows, WINDOWS), names(spark, "a", "b", "c"), 0, 99).collect()
    open_ = {t: set(range(100)) for t in "abc"}
    for t, lo, hi in rows:
        if t in open_:
            open_[t] -= set(range(lo, hi + 1))
    found = {t: [s for x in got if x["table_name"] == t for s in range(x["lo"], x["hi"] + 1)] for t in "abc"}
    assert {t: sorted(v) for t, v in found.items()} == {t: sorted(v) for t, v in open_.items()}
    assert all((x["table_name"], x["hi"] + 1) not in {(y["table_name"], y["lo"]) for y in got} for x in got)  # maximal
    assert [tuple(x) for x in L.gaps(spark.createDataFrame([], WINDOWS), names(spark, "a"), 3, 9).collect()] == [("a", 3, 9)]


def changes(spark):
    """One update a day of key 1 to 6, whose row stays on its day, and a delete."""
    days = [FIRST + i * DAY for i in range(6)]
    rows = [(i, "order", "U", ep(d, 50), i + 1, None) for i, d in enumerate(days)] + [(9, "order", "D", ep(days[3], 60), 7, ep(FIRST - DAY))]
    return days, log_df(spark, rows)


def states(spark, n):
    """The source after n days: the keys updated so far have a new amount, key 7 goes on the fourth day."""
    d = FIRST - 5 * DAY
    rows = [(i, 100 + i if i <= n else i, d + i * DAY) for i in range(1, 7)]
    return src_df(spark, rows + ([(7, 7, FIRST - DAY)] if n < 4 else []))


def content(spark, path):
    return sorted(map(tuple, lake.read_lake(spark, path).select("id", "amount", "year", "month", "day").collect()))


def test_missed_days_are_caught_up(spark, tmpdir_fresh):
    spec, root, path = TableSpec("order"), f"{tmpdir_fresh}/lakes", f"{tmpdir_fresh}/ledger"
    days, log = changes(spark)
    assert L.backfill(spark, path, {"order": states(spark, 0)}, root, FIRST - 30 * DAY, FIRST - DAY, "initial", (spec,)) == ["order"]
    done = [L.catch_up(spark, path, log, {"order": states(spark, i + 1)}, root, FIRST - 30 * DAY, days[i], (spec,)) for i in (0, 1, 4)]
    assert [x["order"] for x in done] == [[(days[0], days[0])], [(days[1], days[1])], [(days[2], days[4])]]  # two runs missed
    assert L.missed_days(spark, path, FIRST - 30 * DAY, days[5], (spec,)) == {"order": [(days[5], days[5])]}
    assert L.catch_up(spark, path, log, {"order": states(spark, 5)}, root, FIRST - 30 * DAY, days[4], (spec,)) == {"order": []}
    assert content(spark, f"{root}/order") == sorted(map(tuple, states(spark, 5).select("id", "amount", "year", "month", "day").collect()))

    # what a run that looks at its own day alone leaves behind
    plain = f"{tmpdir_fresh}/plain"
    lake.backfill(states(spark, 0), plain)
    for i in (0, 1, 4):
        refresh(spark, log, states(spark, i + 1), spec, plain, days[i])
    assert content(spark, plain) != content(spark, f"{root}/order")


def test_a_failed_table_is_done_again(spark, tmpdir_fresh):
    specs, root, path = (TableSpec("a"), TableSpec("b"), TableSpec("c")), f"{tmpdir_fresh}/lakes", f"{tmpdir_fresh}/ledger"
    good = states(spark, 0)
    bad = good.withColumn("amount", F.when(F.raise_error(F.lit("source is away")).isNull(), F.col("amount")))
    with pytest.raises(Exception, match="source is away"):
        L.backfill(spark, path, {"a": good, "b": bad, "c": good}, root, FIRST, FIRST, "x", specs)
    assert L.missed_days(spark, path, FIRST, FIRST, specs) == {"a": [], "b": [(FIRST, FIRST)], "c": [(FIRST, FIRST)]}
    assert L.backfill(spark, path, {s: good for s in "abc"}, root, FIRST, FIRST, "x", specs) == ["b", "c"]
    assert L.backfill(spark, path, {s: good for s in "abc"}, root, FIRST, FIRST, "x", specs) == []
    assert L.backfill(spark, path, {s: good for s in "abc"}, root, FIRST, FIRST, "y", specs[:1]) == ["a"]
    with pytest.raises(ValueError, match="no source"):
        L.catch_up(spark, path, log_df(spark, []), {}, root, FIRST, FIRST, specs)


def test_days_of_a_zone(spark, tmpdir_fresh):
    path, spec = f"{tmpdir_fresh}/ledger", (TableSpec("order"),)
    zone, spring = "America/New_York", dt.date(2024, 3, 10)  # a day of 23 hours
    L._covered(spark, path, spec[0], spring - DAY, spring, "r", "refresh", zone)
    assert L.missed_days(spark, path, spring - 2 * DAY, spring + DAY, spec, zone) == {
        "order": [(spring - 2 * DAY, spring - 2 * DAY), (spring + DAY, spring + DAY)]}


def test_compaction_keeps_what_is_covered(spark, tmpdir_fresh):
    path, spec = f"{tmpdir_fresh}/ledger", TableSpec("order")
    for i in (0, 1, 2, 5):
        L._covered(spark, path, spec, FIRST + i * DAY, FIRST + i * DAY, f"r{i}", "refresh", None)
    L._covered(spark, path, spec, FIRST - 9 * DAY, FIRST - 5 * DAY, "first", "backfill", None)
    before = L.missed_days(spark, path, FIRST - 9 * DAY, FIRST + 9 * DAY, (spec,))
    L.compact(spark, path)
    assert L.missed_days(spark, path, FIRST - 9 * DAY, FIRST + 9 * DAY, (spec,)) == before
    rows = sorted((r["run"], r["kind"]) for r in L.read(spark, path).collect())
    assert rows == [("compacted", "refresh")] * 2 + [("first", "backfill")]
    L._covered(spark, path, spec, FIRST + 3 * DAY, FIRST + 4 * DAY, "r", "refresh", None)
    assert L.missed_days(spark, path, FIRST, FIRST + 5 * DAY, (spec,)) == {"order": []}
