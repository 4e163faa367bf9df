"""Property: when the affected set covers every changed partition, the refreshed lake equals the source.

Generated histories of inserts, updates (which may move a row to another day) and
deletes on the run day, written as a change log with the row trigger's contract
(row_data = key; changed_fields = OLD.updated_at on deletes). With both widening
options on, every partition a change touched is in A, so the lake must come out
identical to the source, and partitions outside A must keep their files.
"""

import datetime as dt
import os

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from helpers import ep, log_df, src_df
from tidemark.functions.timeutil import day_window
from tidemark.operators import cdc
from tidemark.plans.refresh import refresh
from tidemark.sinks import lake
from tidemark.specs import TableSpec

RUN = dt.date(2024, 1, 15)
DAYS = [dt.date(2024, 1, d) for d in range(10, 16)]

initial_st = st.dictionaries(st.integers(0, 15), st.tuples(st.integers(0, 9), st.sampled_from(DAYS)), max_size=10)
ops_st = st.lists(
    st.tuples(st.sampled_from("IUD"), st.integers(0, 18), st.integers(0, 9), st.sampled_from(DAYS)), max_size=14
)


def _history(initial, ops):
    """Apply the valid operations in order; return the final state and the change log rows."""
    state = dict(initial)
    log = []
    for n, (kind, key, amount, day) in enumerate(ops):
        t = ep(RUN, 60 + n)
        if kind == "I" and key not in state:
            state[key] = (amount, day)
            log.append((n + 1, "order", "I", t, key, None))
        elif kind == "U" and key in state:
            state[key] = (amount, day)
            log.append((n + 1, "order", "U", t, key, None))
        elif kind == "D" and key in state:
            _, old_day = state.pop(key)
            log.append((n + 1, "order", "D", t, key, ep(old_day, 3600)))
    return state, log


def _rows(spark, path, schema):
    rows = lake.read_lake(spark, path, schema=schema).collect()
    return sorted((r.id, r.amount, r.year, r.month, r.day) for r in rows)


def _files(path, d):
    folder = f"{path}/year={d.year}/month={d.month}/day={d.day}"
    return {f: os.stat(os.path.join(folder, f)).st_mtime_ns for f in os.listdir(folder)} if os.path.isdir(folder) else {}


# TIDEMARK_PROPERTY_EXAMPLES raises the search for a deeper run (each example is a few Spark jobs)
@settings(
    max_examples=int(os.environ.get("TIDEMARK_PROPERTY_EXAMPLES", "12")),
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(initial_st, ops_st)
# moved to another day, then deleted: the delete carries the new day, the lake row sits in the old one
@example({1: (1, DAYS[0]), 2: (2, DAYS[1])}, [("U", 1, 5, DAYS[2]), ("D", 1, 0, DAYS[0])])
# deleted, then re-inserted on another day: nets to D, yet its new day must be rewritten
@example({1: (0, DAYS[0]), 2: (0, DAYS[0])}, [("D", 1, 0, DAYS[0]), ("I", 1, 0, DAYS[3])])
# empty lake (first run) with inserts only
@example({}, [("I", 3, 1, DAYS[3])])
def test_refreshed_lake_equals_source(spark, tmpdir_fresh, initial, ops):
    final, log_rows = _history(initial, ops)
    before = src_df(spark, [(k, a, d) for k, (a, d) in initial.items()])
    source = src_df(spark, [(k, a, d) for k, (a, d) in final.items()])
    log = log_df(spark, log_rows) if log_rows else log_df(spark, []).limit(0)
    path = f"{tmpdir_fresh}/lake-{abs(hash((tuple(sorted(initial.items())), tuple(ops))))}"
    lake.backfill(before, path)
    untouched_before = {d: _files(path, d) for d in DAYS}

    res = refresh(
        spark, log, source, TableSpec("order"), path, RUN, include_insert_dates=True, include_previous_partition=True
    )

    expected = sorted((k, float(a), d.year, d.month, d.day) for k, (a, d) in final.items())
    assert _rows(spark, path, source.schema) == expected
    affected = {dt.date(*p) for p in res.affected}
    for d in DAYS:
        if d not in affected:
            assert _files(path, d) == untouched_before[d], d
    # net change: each key has exactly one net action, so the I, U, D sets are disjoint
    lo, hi = day_window(RUN)
    net = [(r.id, r.net_action) for r in cdc.net_changes(log, "order", lo, hi).collect()]
    assert len(net) == len({k for k, _ in net})
