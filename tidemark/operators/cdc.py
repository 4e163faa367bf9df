"""Change-log resolution: window, id sets, net change, affected partitions.

Everything here is lazy. The three id sets of a table come from one scan and one
grouped aggregate; the net change per key is a single partial/final aggregate (so a
hot key is pre-combined on the map side and never lands whole in one task); update
dates come from one join of the source (streamed) with the net-updated keys.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import date_parts, epoch_to_date
from ..specs import PARTITION_COLS
from .keysets import MAX_BROADCAST_KEYS, MAX_KEY_LITERALS, bounded_broadcast, near_keys  # noqa: F401 - bounds also read by refresh

ROW_ACTIONS = ("I", "U", "D")
CHANGELOG_COLS = ("event_id", "table_name", "action", "action_tstamp_tx", "row_data", "changed_fields")


def _in_window(lo: int | None, hi: int | None) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("action_tstamp_tx") >= lo)
    if hi is not None:
        cond = cond & (F.col("action_tstamp_tx") <= hi)
    return cond


def changelog_window(
    log: DataFrame,
    table: str | None = None,
    lo: int | None = None,
    hi: int | None = None,
    actions=None,
    columns=CHANGELOG_COLS,
) -> DataFrame:
    """Rows of one table (or all) whose transaction time lies in ``[lo, hi]``."""
    cond = _in_window(lo, hi)
    if table is not None:
        cond = cond & (F.col("table_name") == table)
    if actions is not None:
        cond = cond & F.col("action").isin(list(actions))
    return log.filter(cond).select(*columns)


def cdc_ids(log: DataFrame, table: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Distinct ``(action, row_data)`` for the I, U and D sets of one table in one scan.

    Statement-level rows (NULL key) are dropped (B16).
    """
    return (
        changelog_window(log, table, lo, hi, ROW_ACTIONS, ("action", "row_data"))
        .filter(F.col("row_data").isNotNull())
        .distinct()
    )


def _row_events(log: DataFrame, table: str | None, lo: int | None, hi: int | None) -> DataFrame:
    return changelog_window(log, table, lo, hi, ROW_ACTIONS).filter(F.col("row_data").isNotNull())


_TWO_62 = 2**62


def event_order(tstamp: str = "action_tstamp_tx", event_id: str = "event_id") -> Column:
    """One ``decimal(38,0)`` whose order is the order of ``(tstamp, event_id)``.

    ``tstamp * 2^64 + (event_id + 2^63)``: exact for every event id, and for transaction
    times within +-2^62 seconds of 1970 (beyond that they are clamped). Unlike a struct,
    a decimal fits a hash-aggregate buffer, so ``max_by`` over it keeps the partial
    (map-side) aggregation instead of falling back to a sort-based aggregate.
    """
    dec = lambda v: F.lit(str(v)).cast("decimal(38,0)")  # noqa: E731 - exact big literals
    t = F.least(F.greatest(F.col(tstamp), F.lit(-_TWO_62)), F.lit(_TWO_62)).cast("decimal(38,0)")
    return t * dec(2**64) + (F.col(event_id).cast("decimal(38,0)") + dec(2**63))


def _net_action() -> Column:
    return F.when(F.col("_has_d"), "D").when(F.col("_has_i"), "I").otherwise("U")


def net_actions(
    log: DataFrame,
    table: str | None = None,
    lo: int | None = None,
    hi: int | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Net action per (table, change day, key) only: ``table_name, change_date, id, net_action``.

    Two boolean maxima per group, so this is a hash aggregate with a map-side partial
    step. The refresh uses it to find net-updated keys.
    """
    grouped = (
        _row_events(log, table, lo, hi)
        .withColumn("change_date", epoch_to_date("action_tstamp_tx", zone))
        .groupBy("table_name", "change_date", F.col("row_data").alias("id"))
        .agg(F.max(F.col("action") == "D").alias("_has_d"), F.max(F.col("action") == "I").alias("_has_i"))
    )
    return grouped.select("table_name", "change_date", "id", _net_action().alias("net_action"))


def net_changes(
    log: DataFrame,
    table: str | None = None,
    lo: int | None = None,
    hi: int | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Net action per (table, change day, key): D over I over U, whatever the order in time.

    ``deleted_updated_at`` is the ``changed_fields`` (OLD.updated_at) of the latest
    delete of that key in the same table and window, latest by
    ``(action_tstamp_tx, event_id)`` (B2). Output columns:
    ``table_name, change_date, id, net_action, deleted_updated_at``.

    All three aggregates have fixed-width buffers (the delete ordering is packed into
    one decimal by ``event_order``), so this is one hash aggregate with a map-side
    partial step: a key holding a third of the log is combined before the shuffle.
    """
    is_d = F.col("action") == "D"
    grouped = (
        _row_events(log, table, lo, hi)
        .withColumn("change_date", epoch_to_date("action_tstamp_tx", zone))
        .groupBy("table_name", "change_date", F.col("row_data").alias("id"))
        .agg(
            F.max(is_d).alias("_has_d"),
            F.max(F.col("action") == "I").alias("_has_i"),
            F.max_by("changed_fields", F.when(is_d, event_order())).alias("deleted_updated_at"),
        )
    )
    return grouped.select("table_name", "change_date", "id", _net_action().alias("net_action"), "deleted_updated_at")


def affected_update_dates(
    net: DataFrame,
    source: DataFrame,
    table: str | None = None,
    key: str = "id",
    date_col: str = "updated_at",
    action: str = "U",
    zone: str | None = None,
) -> DataFrame:
    """``update_dates`` under its inventory name, for one action."""
    return update_dates(net, source, table, key, date_col, (action,), zone)


def delete_dates(
    log: DataFrame,
    table: str | None = None,
    lo: int | None = None,
    hi: int | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Partitions that held deleted keys: the OLD.updated_at of *every* delete in the window.

    Any delete makes a key's net action D, so no net step is needed. Taking every
    delete, not only the latest, also covers a key deleted, re-inserted and deleted
    again within the window: the first delete's partition lost the row too.
    """
    rows = changelog_window(log, table, lo, hi, ("D",), ("changed_fields",)).filter(
        F.col("changed_fields").isNotNull()
    )
    return rows.select(*date_parts(epoch_to_date("changed_fields", zone))).distinct()


def affected_delete_dates(
    log: DataFrame, table: str | None = None, lo: int | None = None, hi: int | None = None, zone: str | None = None
) -> DataFrame:
    """``delete_dates`` under its inventory name."""
    return delete_dates(log, table, lo, hi, zone)


def run_date_partitions(spark: SparkSession, run_date: _dt.date, days_back: int = 0) -> DataFrame:
    """The run's own day(s) as partition rows (the 'today' partition of every run)."""
    first = run_date - _dt.timedelta(days=days_back)
    days = spark.range(days_back + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
    return days.select(*date_parts("d"))


def lake_partitions_of_keys(
    lake: DataFrame,
    net: DataFrame,
    table: str | None,
    key: str = "id",
    broadcast_keys: bool | None = None,
    key_values: list | None = None,
) -> DataFrame:
    """Partitions where the lake currently holds any changed key (option for B3).

    Every net action counts. A key updated to a new date and then deleted nets to D,
    and its delete carries the post-update date, so only the lake knows the partition
    that still holds the row. The keys are sized as in ``update_dates``: when they may be
    broadcast, the lake (key and partition columns only) is streamed through a map-side
    semi-join and only its distinct days are shuffled. With
    ``key_values`` (all changed keys, collected under a bound) the lake is filtered with
    ``key IN (..)`` instead, which the parquet scan uses to skip row groups.
    """
    found = lake.select(key, *[F.col(c).cast("bigint").alias(c) for c in PARTITION_COLS])
    if key_values is not None:
        found = found.filter(F.col(key).isin(key_values))
    else:
        rows = net if table is None else net.filter(F.col("table_name") == table)
        found, ids = _sized(found, rows.select(F.col("id").alias(key)).distinct(), key, broadcast_keys)
        found = found.join(ids, key, "left_semi")
    return found.select(*PARTITION_COLS).distinct()


def _sized(df: DataFrame, keys: DataFrame, key: str, broadcast_keys: bool | None) -> tuple[DataFrame, DataFrame]:
    """``df`` and the key set that it is to be joined with.

    The keys are hinted for broadcast if that is known, or found by counting (None), to be within the bound.
    Beyond it both sides are shuffled, and ``df`` is first cut to the intervals that the keys lie in.
    """
    if broadcast_keys is None:
        keys, n = bounded_broadcast(keys, MAX_BROADCAST_KEYS)
        broadcast_keys = n <= MAX_BROADCAST_KEYS
        return (df, keys) if broadcast_keys else (near_keys(df, keys, key), keys)
    return (df, F.broadcast(keys)) if broadcast_keys else (near_keys(df, keys, key), keys)


def update_dates(
    net: DataFrame,
    source: DataFrame,
    table: str | None = None,
    key: str = "id",
    date_col: str = "updated_at",
    source_actions=("U",),
    zone: str | None = None,
    broadcast_keys: bool | None = None,
    key_values: list | None = None,
) -> DataFrame:
    """Partitions of the *current* ``updated_at`` of net-updated keys.

    The source (key and date only) is the streamed side of the join, so it is scanned
    and never shuffled when the key set is broadcast. By default the key set is cut, counted
    and broadcast within ``MAX_BROADCAST_KEYS`` (``keysets.bounded_broadcast``); a caller
    that has counted it already says so with ``broadcast_keys``. Beyond the bound the source is
    filtered by the keys' intervals before both are shuffled (``keysets.near_keys``). Keys gone from the source drop out (B10).

    ``key_values``: the same key set, already collected under a bound (``refresh`` does,
    against ``MAX_KEY_LITERALS``). The source is then filtered with ``key IN (..)``:
    a point lookup the source can answer from its key index, instead of a scan of its
    whole key column.
    """
    if key_values is not None:
        matched = source.select(key, date_col).filter(F.col(key).isin(key_values))
    else:
        rows = net if table is None else net.filter(F.col("table_name") == table)
        keyed = rows.filter(F.col("net_action").isin(*source_actions)).select(F.col("id").alias(key)).distinct()
        own, keyed = _sized(source.select(key, date_col), keyed, key, broadcast_keys)
        matched = own.join(keyed, key, "inner")
    return matched.select(*date_parts(epoch_to_date(date_col, zone))).distinct()


def delete_dates_by_table(log: DataFrame, lo: int | None = None, hi: int | None = None, zone: str | None = None) -> DataFrame:
    """``delete_dates`` of every table at once: ``table_name, year, month, day``."""
    rows = changelog_window(log, None, lo, hi, ("D",), ("table_name", "changed_fields")).filter(
        F.col("changed_fields").isNotNull()
    )
    return rows.select("table_name", *date_parts(epoch_to_date("changed_fields", zone))).distinct()


def source_lookup_actions(include_insert_dates: bool = False) -> tuple[str, ...]:
    """Net actions whose keys get their *current* source date looked up.

    The reference rule looks up net updates only. With ``include_insert_dates`` every
    changed key is looked up: a net insert, and also a key deleted and re-inserted in
    the window, which nets to D (D over I) but is back in the source, perhaps on another
    day. Keys deleted for good are not in the source and drop out of the join (B10).
    """
    return ("U", "I", "D") if include_insert_dates else ("U",)


def affected_from_net(
    spark: SparkSession,
    net: DataFrame,
    deletes: DataFrame,
    source: DataFrame,
    table: str,
    run_date: _dt.date,
    days_back: int = 0,
    key: str = "id",
    date_col: str = "updated_at",
    include_insert_dates: bool = False,
    lake: DataFrame | None = None,
    zone: str | None = None,
    broadcast_keys: bool | None = None,
    broadcast_lake_keys: bool | None = None,
    key_values: list | None = None,
    lake_key_values: list | None = None,
) -> DataFrame:
    """Set A from resolved net actions and delete dates (see ``affected_partitions``).

    ``deletes`` holds ``year, month, day`` (optionally with ``table_name``, then filtered).
    ``broadcast_keys`` / ``broadcast_lake_keys``: the keys joined with the source / the
    lake were counted and are within ``MAX_BROADCAST_KEYS``. ``key_values``: the keys that
    need a source date, collected under ``MAX_KEY_LITERALS`` (see ``update_dates``);
    ``lake_key_values``: all changed keys, likewise, for the lake lookup.
    """
    if "table_name" in deletes.columns:
        deletes = deletes.filter(F.col("table_name") == table)
    actions = source_lookup_actions(include_insert_dates)
    parts = [
        run_date_partitions(spark, run_date, days_back),
        update_dates(net, source, table, key, date_col, actions, zone, broadcast_keys, key_values),
        deletes.select(*PARTITION_COLS),
    ]
    if lake is not None:
        parts.append(lake_partitions_of_keys(lake, net, table, key, broadcast_lake_keys, lake_key_values))
    return reduce(DataFrame.unionByName, parts).distinct()


def affected_partitions(
    spark: SparkSession,
    log: DataFrame,
    source: DataFrame,
    table: str,
    run_date: _dt.date,
    days_back: int = 0,
    key: str = "id",
    date_col: str = "updated_at",
    include_insert_dates: bool = False,
    include_previous_partition: bool = False,
    lake: DataFrame | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Set A of a run: the run day(s), net-update dates and net-delete dates.

    Options: ``include_insert_dates`` adds the current source dates of inserted keys,
    re-inserted ones included (B13; see ``source_lookup_actions``);
    ``include_previous_partition`` adds partitions where ``lake`` still holds changed
    keys, so a row that moved date is removed from its old partition (B3).
    """
    from ..functions.timeutil import day_window

    if include_previous_partition and lake is None:
        raise ValueError("include_previous_partition needs the current lake")
    lo, hi = day_window(run_date, days_back, zone)
    return affected_from_net(
        spark, net_actions(log, table, lo, hi, zone), delete_dates(log, table, lo, hi, zone), source, table, run_date,
        days_back, key, date_col, include_insert_dates, lake if include_previous_partition else None, zone,
    )


def truncated_in_window(log: DataFrame, table: str, lo: int | None = None, hi: int | None = None) -> bool:
    """Whether the window holds a statement-level TRUNCATE of ``table`` (one bounded probe job)."""
    return bool(changelog_window(log, table, lo, hi, ("T",), ("action",)).limit(1).count())


def lake_partitions(lake: DataFrame) -> DataFrame:
    """Every partition currently in the lake (partition columns only)."""
    return lake.select(*[F.col(c).cast("bigint").alias(c) for c in PARTITION_COLS]).distinct()


def partition_slice(df: DataFrame, year: int, month: int, day: int) -> DataFrame:
    """Rows of one date partition (F4); on a partitioned lake this prunes to one folder."""
    return df.filter((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))


def source_days(source: DataFrame) -> DataFrame:
    """Distinct partitions present in ``source``.

    The distinct runs before anything else, so its partial aggregate leaves at most one
    row per day in each task. A day holding a third of the rows never moves as a whole.
    """
    return source.select(*[F.col(c).cast("bigint").alias(c) for c in PARTITION_COLS]).distinct()


def emptied_partitions(affected: DataFrame, source: DataFrame) -> DataFrame:
    """Affected partitions with no row left in the source."""
    return affected.join(source_days(source), list(PARTITION_COLS), "left_anti")
