"""Registered queries over the driver's tables, and their DuckDB oracle SQL.

Each Spark callable takes ``(spark, sf_dir)`` and returns a DataFrame; each oracle
string computes the same rows from the raw tables. Both sides read whole tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import oracle as O
from ..functions import exprs
from ..functions.timeutil import day_window, epoch_parts, epoch_seconds, epoch_to_date, partition_path
from ..operators import capture, cdc, drift, extract, quality, seed
from ..operators.watermark import Watermark
from ..session import scratch_path
from ..sinks import changelog_store, compact, lake, publish
from ..sinks.constraint_store import ConstraintStore
from ..sinks.key_index import KeyIndex
from ..sources import files, jdbc
from ..sources.canonical import MANY_DATES, read_changelog, read_edit_pair, read_snapshot, table_path
from ..specs import CHANGELOG_SCHEMA, FOREIGN_KEYS, PARTITION_COLS, LITERAL_DEFAULTS, NOW_EPOCH_DEFAULTS, SCHEMAS, TABLE_NAMES, VARCHAR_LENGTHS, TableSpec, spec_for
from ..streaming import capture_stream
from ..streaming import lake_stream as streams
from . import ledger, recoverable
from . import refresh as refresh_plan

RUN_DATE = _dt.date(2024, 1, 15)
TABLE = "order"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


LO, HI = day_window(RUN_DATE)


# --- change-log resolution (C1-C4, F1-F8, J1-J3, A1, A3, A5, U1-U3) ------------------


@register(
    "changelog_window",
    _with(O.changelog_cte())
    + f"""SELECT event_id, table_name, action, action_tstamp_tx, row_data, changed_fields
FROM changelog WHERE table_name = '{TABLE}' AND action_tstamp_tx BETWEEN {LO} AND {HI}""",
)
def q_changelog_window(spark, sf_dir):
    return cdc.changelog_window(read_changelog(spark, sf_dir, LO, HI), TABLE, LO, HI)


@register(
    "cdc_ids",
    _with(O.changelog_cte())
    + f"""SELECT DISTINCT action, row_data FROM changelog
WHERE table_name = '{TABLE}' AND action IN ('I','U','D') AND row_data IS NOT NULL
  AND action_tstamp_tx BETWEEN {LO} AND {HI}""",
)
def q_cdc_ids(spark, sf_dir):
    return cdc.cdc_ids(read_changelog(spark, sf_dir, LO, HI), TABLE, LO, HI)


@register(
    "net_changes",
    _with(O.changelog_cte(), O.net_cte(None, None)) + "SELECT * FROM net",
)
def q_net_changes(spark, sf_dir):
    """Flagship: net change per (table, day, key) over the whole change log."""
    return cdc.net_changes(read_changelog(spark, sf_dir))


@register(
    "affected_update_dates",
    _with(O.changelog_cte(), O.snapshot_cte(), O.net_cte(TABLE, RUN_DATE))
    + """SELECT DISTINCT year, month, day FROM snapshot
WHERE id IN (SELECT id FROM net WHERE net_action = 'U')""",
)
def q_affected_update_dates(spark, sf_dir):
    net = cdc.net_actions(read_changelog(spark, sf_dir, LO, HI), TABLE, LO, HI)
    return cdc.affected_update_dates(net, read_snapshot(spark, sf_dir, TABLE), TABLE)


@register(
    "affected_beyond_broadcast",
    _with(O.changelog_cte(), O.snapshot_cte(), O.net_cte(None, None))
    + f"""SELECT DISTINCT year, month, day FROM snapshot
WHERE id IN (SELECT id FROM net WHERE net_action = 'U' AND table_name = '{TABLE}')""",
)
def q_affected_beyond_broadcast(spark, sf_dir):
    """Dates of every key ever net-updated, looked up as for key sets too large to broadcast: the
    source is cut to the keys' intervals, then joined by a shuffle."""
    net = cdc.net_actions(read_changelog(spark, sf_dir))
    return cdc.update_dates(net, read_snapshot(spark, sf_dir, TABLE), TABLE, broadcast_keys=False)


@register(
    "affected_delete_dates",
    _with(O.changelog_cte())
    + f"""SELECT DISTINCT {O.parts('changed_fields')} FROM changelog
WHERE action = 'D' AND changed_fields IS NOT NULL AND table_name = '{TABLE}'
  AND action_tstamp_tx BETWEEN {LO} AND {HI}""",
)
def q_affected_delete_dates(spark, sf_dir):
    return cdc.affected_delete_dates(read_changelog(spark, sf_dir, LO, HI), TABLE, LO, HI)


@register(
    "affected_partitions",
    _with(O.changelog_cte(), O.snapshot_cte(), O.net_cte(TABLE, RUN_DATE), O.affected_cte(TABLE, RUN_DATE))
    + "SELECT * FROM affected",
)
def q_affected_partitions(spark, sf_dir):
    return cdc.affected_partitions(
        spark, read_changelog(spark, sf_dir, LO, HI), read_snapshot(spark, sf_dir, TABLE), TABLE, RUN_DATE
    )


@register(
    "partition_slice",
    _with(O.snapshot_cte()) + "SELECT * FROM snapshot WHERE year = 2024 AND month = 1 AND day = 10",
)
def q_partition_slice(spark, sf_dir):
    return cdc.partition_slice(read_snapshot(spark, sf_dir, TABLE), 2024, 1, 10)


# Keys spread over a hundred years of days, so net deletes really empty partitions.
@register(
    "emptied_partitions",
    _with(
        O.changelog_cte(MANY_DATES),
        O.snapshot_cte(TABLE, MANY_DATES),
        O.net_cte(TABLE, RUN_DATE),
        O.affected_cte(TABLE, RUN_DATE),
        """after AS (SELECT * FROM snapshot WHERE id NOT IN (SELECT id FROM net WHERE net_action = 'D'))""",
    )
    + """SELECT a.* FROM affected a WHERE NOT EXISTS (
  SELECT 1 FROM after s WHERE s.year = a.year AND s.month = a.month AND s.day = a.day)""",
)
def q_emptied_partitions(spark, sf_dir):
    log = read_changelog(spark, sf_dir, LO, HI, n_dates=MANY_DATES)
    snap = read_snapshot(spark, sf_dir, TABLE, n_dates=MANY_DATES)
    affected = cdc.affected_partitions(spark, log, snap, TABLE, RUN_DATE)
    deleted = cdc.net_actions(log, TABLE, LO, HI).filter(F.col("net_action") == "D").select("id")
    after = snap.join(deleted, "id", "left_anti")
    return cdc.emptied_partitions(affected, after)


# --- lake writes: rewrite, refresh, backfill, all tables (C5, C6, K1-K3, K8, J4, S3) --


def _edited_source(snap: DataFrame, net: DataFrame) -> DataFrame:
    """The source after the changes: net-deleted keys gone, net-updated keys' amount + 1."""
    deleted = net.filter(F.col("net_action") == "D").select("id").distinct()
    updated = net.filter(F.col("net_action") == "U").select("id", F.lit(True).alias("_upd")).distinct()
    return (
        snap.join(deleted, "id", "left_anti")
        .join(updated, "id", "left")
        .withColumn("amount", F.when(F.col("_upd"), F.col("amount") + 1).otherwise(F.col("amount")))
        .drop("_upd")
        .select(*snap.columns)
    )


def _edited_source_sql(net: str = "net", src: str = "snapshot", name: str = "source") -> str:
    return f"""{name} AS (
  SELECT id, customer_id,
         CASE WHEN id IN (SELECT id FROM {net} WHERE net_action = 'U') THEN amount + 1 ELSE amount END AS amount,
         created_at, updated_at, year, month, day
  FROM {src} WHERE id NOT IN (SELECT id FROM {net} WHERE net_action = 'D'))"""


_IN_A = "EXISTS (SELECT 1 FROM affected a WHERE a.year = s.year AND a.month = s.month AND a.day = s.day)"


@register(
    "rewrite_partitions",
    _with(O.changelog_cte(), O.snapshot_cte(), O.net_cte(TABLE, RUN_DATE), O.affected_cte(TABLE, RUN_DATE))
    + f"SELECT * FROM snapshot s WHERE {_IN_A}",
)
def q_rewrite_partitions(spark, sf_dir):
    snap = read_snapshot(spark, sf_dir, TABLE)
    affected = cdc.affected_partitions(spark, read_changelog(spark, sf_dir, LO, HI), snap, TABLE, RUN_DATE)
    path = scratch_path(spark, "rewrite")
    lake.rewrite_partitions(spark, snap, affected, path)
    return lake.read_lake(spark, path)


@register(
    "refresh",
    _with(
        O.changelog_cte(),
        O.snapshot_cte(),
        O.net_cte(TABLE, RUN_DATE),
        O.affected_cte(TABLE, RUN_DATE),
        _edited_source_sql(),
    )
    + f"""SELECT * FROM snapshot s WHERE NOT {_IN_A}
UNION ALL
SELECT * FROM source s WHERE {_IN_A}""",
)
def q_refresh(spark, sf_dir):
    """Lake = old snapshot; source = snapshot after the day's changes; one-day refresh, read back."""
    snap = read_snapshot(spark, sf_dir, TABLE)
    log = read_changelog(spark, sf_dir, LO, HI)
    path = scratch_path(spark, "refresh")
    lake.backfill(snap, path)
    source = _edited_source(snap, cdc.net_changes(log, TABLE, LO, HI))
    refresh_plan.refresh(spark, log, source, spec_for(TABLE), path, RUN_DATE)
    return lake.read_lake(spark, path)


class _Stopped(Exception):
    """A run that ends half-way, for the recovery queries."""


def _stop_at(what: str, n: int):
    """A step hook that stops a run before its n-th step of a sort."""
    left = [n]

    def step(name: str) -> None:
        left[0] -= name.startswith(what)
        if not left[0]:
            raise _Stopped(name)

    return step


@register("refresh_recovered", ORACLE["refresh"])
def q_refresh_recovered(spark, sf_dir):
    """The refresh stopped between two renames of a swapped day, then resumed from its journal."""
    snap = read_snapshot(spark, sf_dir, TABLE)
    log = read_changelog(spark, sf_dir, LO, HI)
    path = scratch_path(spark, "refresh-recovered")
    lake.backfill(snap, path)
    source = _edited_source(snap, cdc.net_changes(log, TABLE, LO, HI))
    try:
        recoverable.refresh_published(spark, log, source, spec_for(TABLE), path, RUN_DATE, step=_stop_at("put in place", 2))
    except _Stopped:
        publish.recover(spark, path)
    return lake.read_lake(spark, path)


def _moved_source(src: DataFrame, net: DataFrame, day: _dt.date) -> DataFrame:
    """The source after one day's changes: net-deleted keys gone, net-updated keys moved to that day."""
    deleted = net.filter(F.col("net_action") == "D").select("id").distinct()
    updated = net.filter(F.col("net_action") == "U").select("id", F.lit(True).alias("_upd")).distinct()
    moved = {"updated_at": day_window(day)[0], "year": day.year, "month": day.month, "day": day.day}
    return src.join(deleted, "id", "left_anti").join(updated, "id", "left").withColumns(
        {c: F.when(F.col("_upd"), F.lit(v).cast("bigint")).otherwise(F.col(c)) for c, v in moved.items()}
    ).select(*src.columns)


@register(
    "lake_key_index",
    _with(O.changelog_cte(), O.snapshot_cte(), O.net_cte(TABLE, RUN_DATE, 2))
    + """SELECT s.id, CASE WHEN u.d IS NULL THEN s.year ELSE year(u.d) END AS year, CASE WHEN u.d IS NULL THEN s.month ELSE month(u.d) END AS month,
  CASE WHEN u.d IS NULL THEN s.day ELSE day(u.d) END AS day
FROM snapshot s LEFT JOIN (SELECT id, max(change_date) AS d FROM net WHERE net_action = 'U' GROUP BY id) u ON u.id = s.id
WHERE s.id NOT IN (SELECT id FROM net WHERE net_action = 'D')""",
)
def q_lake_key_index(spark, sf_dir):
    """The key index after three daily refreshes whose updates move rows to the day of their change."""
    root = scratch_path(spark, "indexed")
    source = read_snapshot(spark, sf_dir, TABLE)
    spec = spec_for(TABLE)
    recoverable.backfill_indexed(source, spec, f"{root}/lake", f"{root}/index", span=4096)
    for back in (2, 1, 0):
        day = RUN_DATE - _dt.timedelta(days=back)
        lo, hi = day_window(day)
        log = read_changelog(spark, sf_dir, lo, hi)
        path = f"{root}/source-{back}"
        _moved_source(source, cdc.net_actions(log, TABLE, lo, hi), day).write.parquet(path)
        source = spark.read.parquet(path)
        recoverable.refresh_published(spark, log, source, spec, f"{root}/lake", day, index_path=f"{root}/index")
    return KeyIndex(spark, f"{root}/index").read().select("id", *PARTITION_COLS)


# Hours in which a table had an insert count as covered: gaps of every length, at tables and times the data gives.
@register(
    "run_gaps",
    _with(
        O.changelog_cte(),
        """hours AS (SELECT range AS h FROM (SELECT min(action_tstamp_tx) // 3600 AS a, max(action_tstamp_tx) // 3600 AS b FROM changelog), range(a, b + 1))""",
        """open AS (
  SELECT table_name, h, h - row_number() OVER (PARTITION BY table_name ORDER BY h) AS g
  FROM (SELECT DISTINCT table_name FROM changelog), hours
  WHERE (table_name, h) NOT IN (SELECT (table_name, action_tstamp_tx // 3600) FROM changelog WHERE action = 'I'))""",
    )
    + """SELECT table_name, CAST(3600 * min(h) AS BIGINT) AS lo, CAST(3600 * max(h) + 3599 AS BIGINT) AS hi FROM open GROUP BY table_name, g""",
)
def q_run_gaps(spark, sf_dir):
    """What a ledger of runs leaves uncovered, by table, over the whole change log."""
    log = read_changelog(spark, sf_dir)
    hour = F.floor(F.col("action_tstamp_tx") / 3600).cast("bigint")
    lo, hi = log.agg(F.min(hour), F.max(hour)).first()
    covered = log.where("action = 'I'").select("table_name", (hour * 3600).alias("lo")).distinct().withColumn("hi", F.col("lo") + 3599)
    path = scratch_path(spark, "ledger")
    ledger.record(covered, path, "hourly")
    return ledger.gaps(ledger.read(spark, path), log.select("table_name").distinct(), lo * 3600, hi * 3600 + 3599)


@register(
    "catch_up",
    _with(O.changelog_cte(), O.snapshot_cte(), O.net_cte(TABLE, RUN_DATE, 2))
    + """SELECT id, customer_id, amount + (SELECT count(*) FROM net n WHERE n.id = s.id AND net_action = 'U') AS amount,
  created_at, updated_at, year, month, day
FROM snapshot s WHERE id NOT IN (SELECT id FROM net WHERE net_action = 'D')""",
)
def q_catch_up(spark, sf_dir):
    """Three days of changes; the run of the second day is missed, and the third day's run catches up."""
    root = scratch_path(spark, "catch-up")
    specs, path = (spec_for(TABLE),), f"{root}/ledger"
    log = read_changelog(spark, sf_dir, day_window(RUN_DATE, 2)[0], HI)
    source = read_snapshot(spark, sf_dir, TABLE)
    first = RUN_DATE - _dt.timedelta(days=9)
    ledger.backfill(spark, path, {TABLE: source}, root, first, RUN_DATE - _dt.timedelta(days=3), "initial", specs)
    for back in (2, 1, 0):
        day = RUN_DATE - _dt.timedelta(days=back)
        _edited_source(source, cdc.net_actions(log, TABLE, *day_window(day))).write.parquet(f"{root}/source-{back}")
        source = spark.read.parquet(f"{root}/source-{back}")
        if back != 1:
            ledger.catch_up(spark, path, log, {TABLE: source}, root, first, day, specs)
    return lake.read_lake(spark, f"{root}/{specs[0].folder}").select(*source.columns)


OVERLAP = 20 * 86_400


@register(
    "incremental_two_runs",
    _with(*O.edit_pair_ctes())
    + f"""SELECT id, updated_at, 1 AS run FROM old
UNION ALL
SELECT id, updated_at, 2 FROM new WHERE updated_at >= (SELECT max(updated_at) FROM old) - {OVERLAP}
  AND (id, updated_at) NOT IN (SELECT (id, updated_at) FROM old)""",
)
def q_incremental_two_runs(spark, sf_dir):
    """Two runs over a table that changes in between: new versions and late rows within the overlap come once."""
    root = scratch_path(spark, "watermark")
    slices = []
    for run, source in enumerate(read_edit_pair(spark, sf_dir), 1):
        mark = Watermark(spark, f"{root}/state", overlap=OVERLAP)  # as a new process would
        taken = mark.extract(source)
        taken.rows.write.parquet(f"{root}/run-{run}")
        mark.commit(taken)
        slices.append(spark.read.parquet(f"{root}/run-{run}").select("id", "updated_at", F.lit(run).alias("run")))
    return slices[0].unionByName(slices[1])


@register(
    "lake_drift",
    _with(*O.edit_pair_ctes())
    + """SELECT coalesce(o.id, n.id) AS id, coalesce(o.year, n.year) AS year, coalesce(o.month, n.month) AS month, coalesce(o.day, n.day) AS day,
  CASE WHEN n.id IS NULL THEN 'lake' WHEN o.id IS NULL THEN 'source' ELSE 'both' END AS side
FROM old o FULL JOIN new n ON o.id = n.id AND o.year = n.year AND o.month = n.month AND o.day = n.day
WHERE o.id IS NULL OR n.id IS NULL OR o.customer_id <> n.customer_id OR o.amount <> n.amount OR o.updated_at <> n.updated_at""",
)
def q_lake_drift(spark, sf_dir):
    """Rows in which a stored lake has drifted from its source, found without the log."""
    old, new = read_edit_pair(spark, sf_dir)
    path = scratch_path(spark, "drifted")
    lake.backfill(old, path)
    return drift.drift(lake.read_lake(spark, path, schema=old.schema), new, span=1000)


@register(
    "backfill",
    _with(O.snapshot_cte()) + "SELECT year, month, day, count(*) AS n_rows FROM snapshot GROUP BY year, month, day",
)
def q_backfill(spark, sf_dir):
    path = scratch_path(spark, "backfill")
    lake.backfill(read_snapshot(spark, sf_dir, TABLE), path)
    back = lake.read_lake(spark, path)
    return back.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n_rows"))


def _affected_all_sql() -> str:
    ctes = [O.changelog_cte(), O.net_cte(None, RUN_DATE)]
    sel = []
    for i, t in enumerate(TABLE_NAMES):
        ctes.append(O.snapshot_cte(t, name=f"snap{i}"))
        ctes.append(O.affected_cte(t, RUN_DATE, src=f"snap{i}", name=f"aff{i}"))
        sel.append(f"SELECT '{t}' AS table_name, year, month, day FROM aff{i}")
    return _with(*ctes) + "\nUNION ALL\n".join(sel)


@register("affected_all_tables", _affected_all_sql())
def q_affected_all_tables(spark, sf_dir):
    log = read_changelog(spark, sf_dir, LO, HI)
    sources = {t: read_snapshot(spark, sf_dir, t) for t in TABLE_NAMES}
    return refresh_plan.affected_all_tables(spark, log, sources, RUN_DATE)


def _run_all_sql() -> str:
    ctes, sel = [O.changelog_cte()], []
    for i, t in enumerate(TABLE_NAMES):
        ctes += [
            O.snapshot_cte(t, name=f"snap{i}"), O.net_cte(t, RUN_DATE, name=f"net{i}"),
            O.affected_cte(t, RUN_DATE, net=f"net{i}", src=f"snap{i}", name=f"aff{i}"),
            _edited_source_sql(f"net{i}", f"snap{i}", f"src{i}"),
        ]
        in_a = _IN_A.replace("affected", f"aff{i}")
        sel += [f"SELECT '{t}' AS table_name, s.* FROM snap{i} s WHERE NOT {in_a}", f"SELECT '{t}', s.* FROM src{i} s WHERE {in_a}"]
    return _with(*ctes) + "\nUNION ALL\n".join(sel)


@register("run_all", _run_all_sql())
def q_run_all(spark, sf_dir):
    """Backfill of all five lakes, one day's refresh of all, every lake read back."""
    log = read_changelog(spark, sf_dir, LO, HI)
    root = scratch_path(spark, "run-all")
    before = {t: read_snapshot(spark, sf_dir, t) for t in TABLE_NAMES}
    refresh_plan.run_all(spark, None, before, root, mode="backfill")
    net = cdc.net_changes(log, None, LO, HI)
    after = {t: _edited_source(before[t], net.filter(F.col("table_name") == t)) for t in TABLE_NAMES}
    refresh_plan.run_all(spark, log, after, root, RUN_DATE)
    parts = [
        lake.read_lake(spark, f"{root}/{spec_for(t).folder}").select(F.lit(t).alias("table_name"), *before[t].columns)
        for t in TABLE_NAMES
    ]
    return reduce(DataFrame.unionByName, parts)


@register(
    "partition_path",
    _with(O.snapshot_cte()) + "SELECT id, printf('year=%d/month=%d/day=%d', year, month, day) AS partition_path FROM snapshot",
)
def q_partition_path(spark, sf_dir):
    return read_snapshot(spark, sf_dir, TABLE).select("id", partition_path().alias("partition_path"))


@register(
    "epoch_to_date",
    _with(O.changelog_cte()) + f"SELECT event_id, action_tstamp_tx, {O.epoch_date('action_tstamp_tx')} AS change_date FROM changelog",
)
def q_epoch_to_date(spark, sf_dir):
    log = read_changelog(spark, sf_dir)
    return log.select("event_id", "action_tstamp_tx", epoch_to_date("action_tstamp_tx").alias("change_date"))


ZONE = "America/New_York"


@register(
    "epoch_to_date_zone",
    _with(O.changelog_cte())
    + f"""SELECT event_id, CAST(to_timestamp(action_tstamp_tx) AT TIME ZONE '{ZONE}' AS DATE) AS change_date,
  CAST(to_timestamp(action_tstamp_tx) AT TIME ZONE 'Asia/Tokyo' AS DATE) AS change_date_east FROM changelog""",
)
def q_epoch_to_date_zone(spark, sf_dir):
    log = read_changelog(spark, sf_dir)
    return log.select(
        "event_id", epoch_to_date("action_tstamp_tx", ZONE).alias("change_date"),
        epoch_to_date("action_tstamp_tx", "Asia/Tokyo").alias("change_date_east"),
    )


@register(
    "date_parts",
    _with(O.changelog_cte()) + f"SELECT event_id, {O.parts('action_tstamp_tx')} FROM changelog",
)
def q_date_parts(spark, sf_dir):
    return read_changelog(spark, sf_dir).select("event_id", *epoch_parts("action_tstamp_tx"))


# --- change capture and application (C8-C12, C15, J6, J7, X7, F10) --------------------

NOW = _dt.datetime(2024, 1, 15, 12, 0, 0)
NOW_EPOCH = 1705320000
DIFF_OUT = ["table_name", "action", "action_tstamp_tx", "row_data", "changed_fields", "statement_only"]


@register("snapshot_diff", _with(*O.edit_pair_ctes(), O.diff_cte(TABLE, NOW_EPOCH)) + "SELECT * FROM diff")
def q_snapshot_diff(spark, sf_dir):
    old, new = read_edit_pair(spark, sf_dir)
    return capture.snapshot_diff(old, new, TABLE, now=NOW).select(*DIFF_OUT)


@register(
    "snapshot_diff_ignore",
    _with(*O.edit_pair_ctes(), O.diff_cte(TABLE, NOW_EPOCH, ("customer_id", "amount", "year", "month", "day")))
    + "SELECT * FROM diff",
)
def q_snapshot_diff_ignore(spark, sf_dir):
    old, new = read_edit_pair(spark, sf_dir)
    return capture.audit_events(old, new, TableSpec(TABLE, ignored_cols=("updated_at",)), now=NOW).select(*DIFF_OUT)


FACTS = capture.SessionFacts(
    NOW, NOW + _dt.timedelta(milliseconds=250), 4711, "nightly-load", "192.0.2.10", 40123, "loader", "UPDATE orders SET amount = amount + 1")


@register(
    "session_facts",
    _with(*O.edit_pair_ctes(), O.diff_cte(TABLE, NOW_EPOCH))
    + f"""SELECT 'public' AS schema_name, table_name, 'loader' AS session_user_name, action_tstamp_tx,
  TIMESTAMP '{NOW}' AS action_tstamp_stm, TIMESTAMP '{NOW}.25' AS action_tstamp_clk, CAST(4711 AS BIGINT) AS transaction_id,
  'nightly-load' AS application_name, '192.0.2.10' AS client_addr, 40123 AS client_port, '{FACTS.query}' AS client_query, action, row_data,
  changed_fields, statement_only FROM diff""",
)
def q_session_facts(spark, sf_dir):
    """Row events with every fact of the session that the change log keeps; the event id is a hash and has no SQL form."""
    old, new = read_edit_pair(spark, sf_dir)
    return capture.with_session_facts(capture.snapshot_diff(old, new, TABLE, now=NOW), FACTS, spec=spec_for(TABLE)).drop("event_id")


@register(
    "stream_capture",
    _with(*O.edit_pair_ctes(), "none AS (SELECT * FROM old WHERE false)", O.diff_cte(TABLE, 0, old="none", new="old", name="d1"),
          O.diff_cte(TABLE, 0, name="d2"), O.diff_cte(TABLE, 0, old="new", new="old", name="d3"))
    + " UNION ALL ".join(f"SELECT CAST({n} AS BIGINT) AS snapshot, action, row_data, changed_fields FROM d{n}" for n in (1, 2, 3)),
)
def q_stream_capture(spark, sf_dir):
    """Three snapshots, the last like the first, through the stateful stream, which is stopped and started in between."""
    old, new = read_edit_pair(spark, sf_dir)
    root = scratch_path(spark, "stream-capture")
    for n, snapshot in enumerate((old, new, old), 1):
        capture_stream.write_snapshot(snapshot, f"{root}/in", n)
        if n > 1:
            capture_stream.stream_capture(spark, f"{root}/in", old.schema, f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register(
    "statement_events",
    _with(*O.edit_pair_ctes(), O.diff_cte(TABLE, NOW_EPOCH))
    + f"""SELECT '{TABLE}' AS table_name, 'edit' AS batch, action, CAST(NULL AS BIGINT) AS row_data,
       true AS statement_only, count(*) AS n_rows FROM diff GROUP BY action
UNION ALL
SELECT '{TABLE}', 'truncate', 'T', CAST(NULL AS BIGINT), true, count(*) FROM old""",
)
def q_statement_events(spark, sf_dir):
    old, new = read_edit_pair(spark, sf_dir)
    spec = TableSpec(TABLE, audit_rows=False)
    edit = capture.audit_events(old, new, spec).withColumn("batch", F.lit("edit"))
    trunc = capture.audit_events(old, new.filter(F.lit(False)), spec).withColumn("batch", F.lit("truncate"))
    return edit.unionByName(trunc)


@register(
    "apply_changes",
    _with(*O.edit_pair_ctes(), O.diff_cte(TABLE, NOW_EPOCH))
    + """SELECT * FROM old WHERE id NOT IN (SELECT row_data FROM diff WHERE action IN ('U','D'))
UNION ALL
SELECT * FROM new WHERE id IN (SELECT row_data FROM diff WHERE action IN ('I','U'))""",
)
def q_apply_changes(spark, sf_dir):
    old, new = read_edit_pair(spark, sf_dir)
    return capture.apply_changes(old, capture.snapshot_diff(old, new, TABLE, now=NOW), new)


@register(
    "touch_rows",
    _with(O.changelog_cte(), O.snapshot_cte(), O.net_cte(TABLE, None))
    + f"""SELECT id, customer_id, amount, created_at,
  CASE WHEN t THEN {NOW_EPOCH} ELSE updated_at END AS updated_at,
  CASE WHEN t THEN 2024 ELSE year END AS year,
  CASE WHEN t THEN 1 ELSE month END AS month,
  CASE WHEN t THEN 15 ELSE day END AS day
FROM (SELECT *, id IN (SELECT id FROM net WHERE net_action = 'U') AS t FROM snapshot)""",
)
def q_touch_rows(spark, sf_dir):
    """Rows updated anywhere in the log get the touch trigger's new timestamp and date."""
    net = cdc.net_changes(read_changelog(spark, sf_dir), TABLE)
    keys = net.filter(F.col("net_action") == "U").select("id")
    return capture.touch_rows(read_snapshot(spark, sf_dir, TABLE), keys, NOW)


REDACT_SPECS = (
    TableSpec("customer"),
    TableSpec("manufacturer", audit_query_text=None),
    TableSpec("product", audit_query_text=False),
    TableSpec("order"),
    TableSpec("order_items", audit_query_text=False),
)


@register(
    "redact_query_text",
    _with(O.changelog_cte())
    + """SELECT event_id, table_name,
  CASE WHEN table_name IN ('product', 'order_items') THEN NULL ELSE client_query END AS client_query
FROM changelog""",
)
def q_redact_query_text(spark, sf_dir):
    log = capture.redact_query_text(read_changelog(spark, sf_dir), REDACT_SPECS)
    return log.select("event_id", "table_name", "client_query")


# --- browsing, watermarks, previews, defaults


@register(
    "audit_history",
    _with(O.changelog_cte()) + "SELECT * FROM changelog WHERE table_name = 'product'",
)
def q_audit_history(spark, sf_dir):
    return extract.audit_history(read_changelog(spark, sf_dir), "product")


@register(
    "changelog_by_key",
    _with(O.changelog_cte(), O.net_cte(TABLE, RUN_DATE))
    + f"""SELECT * FROM changelog WHERE table_name = '{TABLE}' AND row_data IN (SELECT id FROM net WHERE net_action = 'D')""",
)
def q_changelog_by_key(spark, sf_dir):
    """The whole history of the keys that one day's run deletes, from the stored log; one day is loaded twice."""
    log = read_changelog(spark, sf_dir)
    path = scratch_path(spark, "changelog")
    first, last = (r.date() for r in spark.read.parquet(table_path(sf_dir, "events")).agg(F.min("ts"), F.max("ts")).first())
    changelog_store.load(log, path, first, last)
    changelog_store.load(log, path, RUN_DATE, RUN_DATE)
    today = changelog_store.read(spark, path, log.schema, RUN_DATE, RUN_DATE)
    deleted = cdc.net_actions(today, TABLE, LO, HI).filter(F.col("net_action") == "D").select("id")
    return changelog_store.history(changelog_store.read(spark, path, log.schema), TABLE, deleted)


@register(
    "audited_tables",
    _with(O.changelog_cte())
    + """SELECT DISTINCT schema_name AS schema, table_name AS audited_table FROM changelog
WHERE action IN ('I','D','U','T') ORDER BY 1, 2""",
)
def q_audited_tables(spark, sf_dir):
    return extract.audited_tables(read_changelog(spark, sf_dir))


@register(
    "preview_topn",
    _with(O.snapshot_cte()) + "SELECT * FROM snapshot ORDER BY created_at, id LIMIT 20",
)
def q_preview_topn(spark, sf_dir):
    return extract.preview_topn(read_snapshot(spark, sf_dir, TABLE), ["created_at", "id"], 20)


@register(
    "high_watermark",
    _with(O.changelog_cte())
    + "SELECT table_name, max(action_tstamp_tx) AS high_watermark FROM changelog GROUP BY table_name",
)
def q_high_watermark(spark, sf_dir):
    """The latest change of each table in the whole log."""
    return extract.high_watermark(read_changelog(spark, sf_dir), "action_tstamp_tx", by=["table_name"])


@register(
    "row_as_json",
    _with(O.changelog_cte()) + "SELECT table_name, max(action_tstamp_tx) AS max_tstamp FROM changelog GROUP BY table_name",
)
def q_row_as_json(spark, sf_dir):
    agg = extract.high_watermark(read_changelog(spark, sf_dir), "action_tstamp_tx", by=["table_name"], alias="max_tstamp")
    js = extract.row_as_json(agg, ["max_tstamp"], "json")
    return js.select("table_name", extract.json_field("json", "max_tstamp").cast("bigint").alias("max_tstamp"))


@register(
    "incremental_extract",
    _with(O.snapshot_cte()) + "SELECT * FROM snapshot WHERE updated_at > (SELECT max(created_at) FROM snapshot)",
)
def q_incremental_extract(spark, sf_dir):
    """Rows updated after the table's newest creation, written as a partitioned slice (K6)."""
    snap = read_snapshot(spark, sf_dir, TABLE)
    slice_ = extract.incremental_extract(snap, extract.scalar_watermark(snap, "created_at"))
    path = scratch_path(spark, "incremental")
    lake.write_incremental(slice_, path)
    return lake.read_lake(spark, path)


@register(
    "with_defaults",
    f"""SELECT c_custkey AS id, c_name AS name, 'somewhere' AS address, 'user@domain.com' AS contact,
  c_acctbal AS credit_limit, CAST(2024 AS BIGINT) AS year, CAST(1 AS BIGINT) AS month, CAST(15 AS BIGINT) AS day,
  CAST({NOW_EPOCH} AS BIGINT) AS created_at, CAST({NOW_EPOCH} AS BIGINT) AS updated_at
FROM customer""",
)
def q_with_defaults(spark, sf_dir):
    c = spark.read.parquet(table_path(sf_dir, "customer")).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("credit_limit")
    )
    return exprs.with_defaults(c, "customer", NOW)


@register(
    "arith_expr",
    "SELECT l_orderkey, l_linenumber, l_extendedprice + l_tax * l_quantity AS arith FROM lineitem",
)
def q_arith_expr(spark, sf_dir):
    li = spark.read.parquet(table_path(sf_dir, "lineitem"))
    return li.select("l_orderkey", "l_linenumber", exprs.arith_expr("l_extendedprice", "l_tax", "l_quantity").alias("arith"))


# --- parquet scans, export, source read (S1, S5-S8, K5) --------------------------------

_LI_BY_MONTH = """SELECT CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS month,
  count(*) AS n_rows FROM lineitem GROUP BY 1, 2"""


def _lineitem_lake(spark, sf_dir) -> str:
    li = spark.read.parquet(table_path(sf_dir, "lineitem"))
    li = li.withColumns({"year": F.year("l_shipdate").cast("bigint"), "month": F.month("l_shipdate").cast("bigint")})
    path = scratch_path(spark, "lineitem-lake")
    li.hint("rebalance", "year", "month").write.partitionBy("year", "month").parquet(path)
    return path


@register("scan_parquet_file", _LI_BY_MONTH)
def q_scan_parquet_file(spark, sf_dir):
    """Lines stored by year and month folder; each file of every folder is read by its name."""
    path = _lineitem_lake(spark, sf_dir)
    names = [f for p in publish.partition_folders(publish.Files(spark, path), path, 2) for f in files.folder_files(spark, f"{path}/{p}")]
    df = files.scan_parquet_files(spark, names, path)
    return df.groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@register("scan_parquet_glob", _LI_BY_MONTH)
def q_scan_parquet_glob(spark, sf_dir):
    path = _lineitem_lake(spark, sf_dir)
    df = files.scan_parquet_glob(spark, f"{path}/year=????/month=*", path)
    return df.groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@register(
    "schema_from_sample",
    """SELECT CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS month,
  count(*) AS n_rows, sum(l_quantity) AS sum_qty FROM lineitem GROUP BY 1, 2""",
)
def q_schema_from_sample(spark, sf_dir):
    path = _lineitem_lake(spark, sf_dir)
    sample = files.first_file(spark, path)
    sch = files.schema_from_sample(spark, sample, path, {"year": T.LongType(), "month": T.LongType()})
    df = spark.read.schema(sch).option("basePath", path).parquet(path)
    return df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty"))


@register(
    "schema_apply",
    """SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS BIGINT) AS year,
  CAST(month(l_shipdate) AS BIGINT) AS month FROM lineitem""",
)
def q_schema_apply(spark, sf_dir):
    path = _lineitem_lake(spark, sf_dir)
    sch = files.schema_from_sample(spark, files.first_file(spark, path), path, {"year": T.LongType(), "month": T.LongType()})
    return files.schema_apply(spark, sch, path).select("l_orderkey", "l_linenumber", "year", "month")


@register("export_flat", "SELECT * FROM customer")
def q_export_flat(spark, sf_dir):
    path = scratch_path(spark, "export")
    lake.export_flat(spark.read.parquet(table_path(sf_dir, "customer")), path)
    return spark.read.parquet(path)


@register(
    "read_source",
    "SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal AS credit_limit, c_mktsegment FROM customer",
)
def q_read_source(spark, sf_dir):
    return jdbc.read_source(
        spark,
        "customer",
        fmt="parquet",
        path=table_path(sf_dir, "customer"),
        schema=SCHEMAS["customer"],
        rename={"c_custkey": "id", "c_name": "name", "c_acctbal": "credit_limit"},
    )


# --- data-quality checks (Q1-Q5, A6, J5) -----------------------------------------------


def _dq_sql(rows: list[tuple[str, str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"check\", '{t}' AS table_name, '{col}' AS column_name, CAST(({expr}) AS BIGINT) AS n_violations"
        for c, t, col, expr in rows
    )


def _required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


# Inputs with real violations, over whole tables: low-priority orders lose their customer,
# error events their action.
_DQ_ORDER = "(SELECT o_orderkey AS id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS customer_id FROM orders)"
_DQ_LOG = "(SELECT event_id, schema_name, table_name, CASE WHEN action <> 'D' THEN action END AS action, statement_only FROM changelog)"


@register(
    "dq_not_null",
    _with(O.changelog_cte())
    + _dq_sql(
        [("not_null", "order", c, f"SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {_DQ_ORDER}") for c in _required(SCHEMAS["order"])]
        + [
            ("not_null", "logged_actions", c, f"SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {_DQ_LOG}")
            for c in _required(CHANGELOG_SCHEMA)
        ]
    ),
)
def q_dq_not_null(spark, sf_dir):
    orders = spark.read.parquet(table_path(sf_dir, "orders")).select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("customer_id")
    )
    log = read_changelog(spark, sf_dir).withColumn("action", F.when(F.col("action") != "D", F.col("action")))
    return quality.dq_not_null(orders, "order", _required(SCHEMAS["order"])).unionByName(
        quality.dq_not_null(log, "logged_actions", _required(CHANGELOG_SCHEMA))
    )


_PKS = (("orders", ("o_orderkey",)), ("customer", ("c_custkey",)), ("part", ("p_partkey",)),
        ("supplier", ("s_suppkey",)), ("lineitem", ("l_orderkey", "l_linenumber")))


@register(
    "dq_pk_duplicates",
    _dq_sql(
        [
            ("pk_unique", t, ",".join(k), f"SELECT count(*) FROM (SELECT {', '.join(k)} FROM {t} GROUP BY ALL HAVING count(*) > 1)")
            for t, k in _PKS
        ]
    ),
)
def q_dq_pk_duplicates(spark, sf_dir):
    parts = [quality.dq_pk_duplicates(spark.read.parquet(table_path(sf_dir, t)), t, list(k)) for t, k in _PKS]
    return reduce(DataFrame.unionByName, parts)


_FKS = (("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        # no such constraint exists: these find real orphans
        ("customer", "c_custkey", "supplier", "s_suppkey"), ("lineitem", "l_orderkey", "customer", "c_custkey"))


@register(
    "dq_fk_orphans",
    _dq_sql(
        [
            ("fk_exists", c, fk, f"SELECT count(*) FROM {c} WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {p} WHERE {pk} IS NOT NULL)")
            for c, fk, p, pk in _FKS
        ]
    ),
)
def q_dq_fk_orphans(spark, sf_dir):
    rd = lambda t: spark.read.parquet(table_path(sf_dir, t))
    return quality.dq_fk_orphans_all({t: rd(t) for f in _FKS for t in (f[0], f[2])}, _FKS)


@register(
    "dq_action_domain",
    _dq_sql([("action_domain", "logged_actions", "action",
              "SELECT count(*) FILTER (WHERE a IS NOT NULL AND a NOT IN ('I','D','U','T')) "
              "FROM (SELECT CASE event_type WHEN 'signup' THEN 'I' ELSE event_type END AS a FROM events)")]),
)
def q_dq_action_domain(spark, sf_dir):
    """Event types that nobody mapped to an action letter, but for signups."""
    ev = spark.read.parquet(table_path(sf_dir, "events"))
    action = F.when(F.col("event_type") == "signup", "I").otherwise(F.col("event_type"))
    return quality.dq_action_domain(ev.select(action.alias("action")))


_DQ_NAMES = {"name": "text", "address": "source", "contact": "text"}


@register(
    "dq_length",
    _dq_sql(
        [
            (f"length<={n}", t, c, f"SELECT count(*) FILTER (WHERE length({_DQ_NAMES[c]}) > {n}) FROM documents")
            for t in ("customer", "manufacturer")
            for c, n in VARCHAR_LENGTHS[t].items()
        ]
    ),
)
def q_dq_length(spark, sf_dir):
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select(*[F.col(c).alias(k) for k, c in _DQ_NAMES.items()])
    return quality.dq_length(docs, "customer", VARCHAR_LENGTHS["customer"]).unionByName(
        quality.dq_length(docs, "manufacturer", VARCHAR_LENGTHS["manufacturer"])
    )


# The five logical tables over the driver's: parts refer to manufacturers by their size, lines to
# products by their part, and some keys and texts break the declared rules.
_DECLARED = {
    "customer": ("customer", {"id": "nullif(c_custkey, 1)", "name": "c_name || ' in ' || c_mktsegment || ' of nation number ' || c_nationkey"}),
    "manufacturer": ("supplier", {"id": "s_suppkey", "name": "s_name"}),
    "product": ("part", {"id": "p_partkey", "manufacture_id": "CAST(nullif(p_size, 7) AS BIGINT)", "color": "p_type"}),
    "order": ("orders", {"id": "o_custkey", "customer_id": "o_custkey", "reference": "o_orderpriority"}),
    "order_items": ("lineitem", {"id": "l_orderkey", "order_id": "l_orderkey", "product_id": "l_partkey"}),
}


def _declared_sql() -> str:
    frame = {t: "(SELECT " + ", ".join(f"{e} AS {c}" for c, e in cols.items()) + f" FROM {src})" for t, (src, cols) in _DECLARED.items()}
    rows = []
    for t, (_, cols) in _DECLARED.items():
        rows += [("not_null", t, c, f"SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {frame[t]}") for c in _required(SCHEMAS[t])]
        rows += [
            (f"length<={n}", t, c, f"SELECT count(*) FILTER (WHERE length({c}) > {n}) FROM {frame[t]}")
            for c, n in VARCHAR_LENGTHS.get(t, {}).items() if c in cols
        ]
        rows.append(("pk_unique", t, "id", f"SELECT count(*) FROM (SELECT id FROM {frame[t]} GROUP BY id HAVING count(*) > 1)"))
    rows += [
        ("fk_exists", c, k, f"SELECT count(*) FROM {frame[c]} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT id FROM {frame[p]} WHERE id IS NOT NULL)")
        for c, k, p in FOREIGN_KEYS
    ]
    return _dq_sql(rows)


@register("dq_declared", _declared_sql())
def q_dq_declared(spark, sf_dir):
    """All constraints that the specs declare, over the five logical tables."""
    return quality.declared_checks({
        t: spark.read.parquet(table_path(sf_dir, src)).select(*[F.expr(e).alias(c) for c, e in cols.items()])
        for t, (src, cols) in _DECLARED.items()
    })


# Dates of the logical tables' rows: what the driver's tables date or number.
_DECLARED_DATES = {
    "customer": "date_add(DATE '2024-01-01', CAST(c_nationkey AS INT))",
    "manufacturer": "date_add(DATE '2024-01-01', CAST(s_nationkey AS INT))",
    "product": "date_add(DATE '2024-01-01', CAST(p_size AS INT))",
    "order": "CAST(date_trunc('month', o_orderdate) AS DATE)",
    "order_items": "CAST(date_trunc('month', l_shipdate) AS DATE)",
}


@register("dq_incremental", _declared_sql())
def q_dq_incremental(spark, sf_dir):
    """All declared constraints from counts kept per day: January is summarised from an older state of the
    tables (other ids, keys and texts), then only its days are summarised anew."""
    columns = {t: list(cols) for t, (_, cols) in _DECLARED.items()}
    store = ConstraintStore(spark, scratch_path(spark, "constraints"), columns)

    def summarised(t: str) -> None:
        src, cols = _DECLARED[t]
        now = spark.read.parquet(table_path(sf_dir, src)).withColumn("_date", F.expr(_DECLARED_DATES[t])).select(
            *[F.expr(e).alias(c) for c, e in cols.items()],
            *[F.expr(f"CAST({p}(_date) AS BIGINT)").alias(p) for p in PARTITION_COLS],
        )
        stale = F.col("month") == 1
        older = {
            c: F.when(stale, F.lit(None) if c == "name" else -F.col(c) if now.schema[c].dataType.typeName() != "string" else F.col(c))
            .otherwise(F.col(c)).cast(now.schema[c].dataType) for c in cols
        }
        store.build(t, now.withColumns(older))
        days = lake.collect_affected(now.where(stale))
        store.refresh(t, now, days)

    # each table has a folder of its own: one table's small jobs fill the cores that another's last tasks leave
    refresh_plan.each_table([TableSpec(t) for t in _DECLARED], lambda s: summarised(s.name), spark, 4)
    return store.report()


# --- seeds (G1, G2, X9-X11, X13, F11) ---------------------------------------------------

_SEED_KEYS = (
    ("customer", "customer", "c_custkey"),
    ("manufacturer", "supplier", "s_suppkey"),
    ("product", "part", "p_partkey"),
    ("order", "orders", "o_orderkey"),
    ("order_items", "lineitem", None),
)
_SEED_FKS = {"product": ["manufacture_id"], "order": ["customer_id"], "order_items": ["order_id", "product_id"]}


def _seed_keys(spark, sf_dir, src, key):
    df = spark.read.parquet(table_path(sf_dir, src))
    if key is None:  # a line item is keyed by (order, line number); lines per order are at most 7
        return df.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k")), "k"
    return df, key


#: Common layout of the seeded tables: column -> (type, the tables' columns that fill it).
_SEED_OUT = {
    "name": ("string", ("name",)), "fk_a": ("bigint", ("manufacture_id", "customer_id", "order_id")), "fk_b": ("bigint", ("product_id",)),
    "text_a": ("string", ("address", "reference", "color")), "text_b": ("string", ("contact",)),
    "amount": ("double", ("credit_limit", "unit_price")), "quality": ("bigint", ("quality",)),
    "made": ("bigint", ("purchase_date", "warranty")),
}
_SEED_COMMON = ("year", "month", "day", "created_at", "updated_at")


def _seed_sql() -> str:
    out = []
    for t, src, key in _SEED_KEYS:
        idx = "l_orderkey * 8 + l_linenumber" if key is None else key
        own = {c: f"1 + ({idx}) % 101" for c in _SEED_FKS.get(t, [])}
        if t in ("customer", "manufacturer"):
            own["name"] = f"md5(CAST({idx} AS VARCHAR))"
        own |= {c: str(NOW_EPOCH) for c in NOW_EPOCH_DEFAULTS[t]}
        own |= {c: f"'{v}'" if isinstance(v, str) else f"CAST({v} AS FLOAT)" if c == "unit_price" else str(v) for c, v in LITERAL_DEFAULTS[t].items()}
        cols = [
            f"CAST({next((own[c] for c in names if c in own), 'NULL')} AS {'VARCHAR' if kind == 'string' else kind}) AS {o}"
            for o, (kind, names) in _SEED_OUT.items()
        ]
        out.append(
            f"SELECT '{t}' AS table_name, CAST({idx} AS BIGINT) AS id, {', '.join(cols)}, CAST(2024 AS BIGINT) AS year, "
            f"CAST(1 AS BIGINT) AS month, CAST(15 AS BIGINT) AS day, CAST({NOW_EPOCH} AS BIGINT) AS created_at, "
            f"CAST({NOW_EPOCH} AS BIGINT) AS updated_at FROM {src}"
        )
    return "\nUNION ALL\n".join(out)


@register("seed_tables", _seed_sql())
def q_seed_tables(spark, sf_dir):
    """Every seeded row of the five tables, defaults and md5 names included, in one layout."""
    parts = []
    for t, src, key in _SEED_KEYS:
        keys, k = _seed_keys(spark, sf_dir, src, key)
        df = seed.seed_table(keys, t, k, NOW)
        cols = []
        for o, (kind, names) in _SEED_OUT.items():
            own = next((c for c in names if c in df.columns), None)
            cols.append((F.col(own) if own else F.lit(None)).cast(kind).alias(o))
        parts.append(df.select(F.lit(t).alias("table_name"), "id", *cols, *_SEED_COMMON))
    return reduce(DataFrame.unionByName, parts)


def _backdate_sql() -> str:
    whens = []
    for lo, hi, days in seed.BACKDATE_BANDS:
        cond = f"id < {hi}" if lo is None else f"id > {lo} AND id < {hi}"
        whens.append(f"WHEN {cond} THEN {days}")
    band = "CASE " + " ".join(whens) + " END"
    moved = f"({NOW_EPOCH} - b * 86400)"
    d = O.epoch_date(moved)
    return f"""SELECT id,
  CASE WHEN b IS NULL THEN {NOW_EPOCH} ELSE {moved} END AS created_at,
  CASE WHEN b IS NULL THEN {NOW_EPOCH} ELSE {moved} END AS updated_at,
  CASE WHEN b IS NULL THEN 2024 ELSE CAST(year({d}) AS BIGINT) END AS year,
  CASE WHEN b IS NULL THEN 1 ELSE CAST(month({d}) AS BIGINT) END AS month,
  CASE WHEN b IS NULL THEN 15 ELSE CAST(day({d}) AS BIGINT) END AS day
FROM (SELECT o_orderkey AS id, {band.replace('id', 'o_orderkey')} AS b FROM orders)"""


@register("seed_backdate", _backdate_sql())
def q_seed_backdate(spark, sf_dir):
    keys = spark.read.parquet(table_path(sf_dir, "orders"))
    seeded = seed.seed_table(keys, "order", "o_orderkey", NOW)
    return seed.seed_backdate(seeded, NOW).select("id", "created_at", "updated_at", "year", "month", "day")


# --- streaming (T1-T3, S9, K7) ------------------------------------------------------------


@register(
    "stream_lake_copy",
    f"""SELECT {O.parts('epoch_us(ts) // 1000000')}, count(*) AS n_rows, sum(user_id) AS sum_user FROM events GROUP BY ALL""",
)
def q_stream_lake_copy(spark, sf_dir):
    """Events dropped as date-partitioned files, copied by a file stream into a lake, read back."""
    dst, _ = _streamed_events(spark, sf_dir)
    back = lake.read_lake(spark, dst)
    return back.groupBy(*PARTITION_COLS).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("user_id").alias("sum_user"))


def _streamed_events(spark, sf_dir):
    """The events as a streamed copy of a date-partitioned folder, and their schema."""
    ev = spark.read.parquet(table_path(sf_dir, "events")).withColumn("_e", epoch_seconds("ts"))
    ev = ev.select("event_id", "ts", "user_id", "event_type", "value", "props", *epoch_parts("_e"))
    src = scratch_path(spark, "stream-src")
    ev.hint("rebalance", *PARTITION_COLS).write.partitionBy(*PARTITION_COLS).parquet(src)
    sample = files.first_file(spark, src)
    sch = files.schema_from_sample(spark, sample, src, {c: T.LongType() for c in PARTITION_COLS})
    dst, ck = scratch_path(spark, "stream-dst"), scratch_path(spark, "stream-ck")
    streams.stream_lake_copy(spark, src, dst, ck, sch, max_files_per_trigger=8).awaitTermination()
    return dst, sch


@register(
    "compact_lake",
    f"""SELECT event_id, user_id, event_type, value, props, {O.parts('epoch_us(ts) // 1000000')} FROM events""",
)
def q_compact_lake(spark, sf_dir):
    """A lake that got every event twice, in files of their own, packed and read back: the rows that are there exactly twice."""
    dst, sch = _streamed_events(spark, sf_dir)
    again = spark.read.schema(sch).parquet(dst)
    again.hint("rebalance", *PARTITION_COLS).write.mode("append").partitionBy(*PARTITION_COLS).parquet(dst)
    compact.compact_lake(spark, dst, sch)
    back = lake.read_lake(spark, dst, schema=sch).groupBy(*[c for c in sch.names if c != "ts"], "ts").agg(F.count(F.lit(1)).alias("n"))
    return back.where("n = 2").select("event_id", "user_id", "event_type", "value", "props", *PARTITION_COLS)


def _stream_refresh_sql() -> str:
    aff = f"""affected AS (
  SELECT DISTINCT {O.parts('action_tstamp_tx')} FROM changelog WHERE table_name = '{TABLE}'
  UNION SELECT DISTINCT s.year, s.month, s.day FROM source s
    WHERE s.id IN (SELECT id FROM net WHERE net_action = 'U')
  UNION SELECT DISTINCT {O.parts('changed_fields')} FROM changelog
    WHERE action = 'D' AND changed_fields IS NOT NULL AND table_name = '{TABLE}')"""
    return _with(O.changelog_cte(), O.snapshot_cte(), O.net_cte(TABLE, None), _edited_source_sql(), aff) + (
        f"SELECT * FROM snapshot s WHERE NOT {_IN_A}\nUNION ALL\nSELECT * FROM source s WHERE {_IN_A}"
    )


@register("stream_partition_refresh", _stream_refresh_sql())
def q_stream_partition_refresh(spark, sf_dir):
    """Change-log files, one folder per day, refresh the lake in one trigger."""
    snap = read_snapshot(spark, sf_dir, TABLE)
    log = read_changelog(spark, sf_dir)
    source = _edited_source(snap, cdc.net_changes(log, TABLE))
    log_dir = scratch_path(spark, "changelog-files")
    log.withColumns({"log_date": epoch_to_date("action_tstamp_tx")}).hint("rebalance", "log_date").write.partitionBy(
        "log_date"
    ).parquet(log_dir)
    path, ck = scratch_path(spark, "stream-lake"), scratch_path(spark, "stream-refresh-ck")
    lake.backfill(snap, path)
    q = streams.stream_partition_refresh(spark, log_dir, CHANGELOG_SCHEMA, source, spec_for(TABLE), path, ck)
    q.awaitTermination()
    return lake.read_lake(spark, path)
