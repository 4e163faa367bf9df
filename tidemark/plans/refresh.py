"""End-to-end jobs: the daily partition refresh of one table and of all tables."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import day_window
from ..operators import cdc
from ..operators.keysets import bounded_key_values
from ..session import ensure_checkpoint_dir
from ..sinks import lake
from ..sources import jdbc
from ..specs import DEFAULT_SPECS, PARTITION_COLS, SCHEMAS, TableSpec


@dataclass(frozen=True)
class Options:
    """What a refresh covers beyond the run day, net updates and deletes.

    ``include_insert_dates``: current source dates of inserted keys too (B13).
    ``include_previous_partition``: partitions where the lake still holds a changed key (B3).
    ``truncate_marks_all``: a TRUNCATE in the window affects every lake partition (B15).
    ``zone``: time zone of days and window (UTC by default).
    ``one_source_state``: read the source once, from a copy in the shared folder, so the
    dates and the written rows come from the same state (B14). It costs one write of
    the table; without it the source is read twice and must not change in between.
    """

    include_insert_dates: bool = False
    include_previous_partition: bool = False
    truncate_marks_all: bool = False
    zone: str | None = None
    one_source_state: bool = False


def resolve_affected(
    spark: SparkSession,
    log: DataFrame,
    source: DataFrame,
    spec: TableSpec,
    run_date: _dt.date,
    days_back: int = 0,
    include_insert_dates: bool = False,
    lake_df: DataFrame | None = None,
    zone: str | None = None,
    net: DataFrame | None = None,
    deletes: list[tuple[int, int, int]] | None = None,
    sizes: tuple[int, int] | None = None,
) -> list[tuple[int, int, int]]:
    """Affected days of one run, on the driver (bounded by the calendar).

    The net actions (one hash aggregate of the log window) are persisted and read more
    than once: to count the key sets (one job), to collect them when the count is within
    ``MAX_KEY_LITERALS``, and for the lookups in the source and, with ``lake_df``, in the
    lake. The number of jobs does not depend on how many keys changed. A caller that has
    resolved all tables at once passes ``net``, the table's delete days and its ``sizes`` (keys that
    need a source date, all changed keys). A lost cached block is recomputed from the log.
    """
    lo, hi = day_window(run_date, days_back, zone)
    shared = net is not None
    if shared:
        net = net.filter(F.col("table_name") == spec.name)
    else:
        net = cdc.net_actions(log, spec.name, lo, hi, zone).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        actions = cdc.source_lookup_actions(include_insert_dates)
        # one job sizes both key sets: those that need a source date, and all changed keys
        n_src, n_all = sizes or net.agg(
            F.count_if(F.col("net_action").isin(*actions)), F.count(F.lit(1))
        ).first()
        # few keys: collect them (one plain job, the count bounds it) and look them up by
        # value; more: broadcast join within MAX_BROADCAST_KEYS
        values = lake_values = None
        if n_src <= cdc.MAX_KEY_LITERALS:
            values = bounded_key_values(net.filter(F.col("net_action").isin(*actions)), "id", known_at_most=n_src)
        if lake_df is not None and n_all <= cdc.MAX_KEY_LITERALS:
            lake_values = bounded_key_values(net, "id", known_at_most=n_all)
        delete_days = cdc.delete_dates(log, spec.name, lo, hi, zone) if deletes is None else _days(spark, deletes)
        affected = cdc.affected_from_net(
            spark, net, delete_days, source, spec.name, run_date, days_back, spec.key, spec.date_col,
            include_insert_dates, lake_df, zone,
            broadcast_keys=n_src <= cdc.MAX_BROADCAST_KEYS,
            broadcast_lake_keys=n_all <= cdc.MAX_BROADCAST_KEYS,
            key_values=values,
            lake_key_values=lake_values,
        )
        return lake.collect_affected(affected)
    finally:
        if not shared:
            net.unpersist()


def _days(spark: SparkSession, days: list[tuple[int, int, int]]) -> DataFrame:
    return spark.createDataFrame(days, ", ".join(f"{c} bigint" for c in PARTITION_COLS))


def _refresh_one(
    spark: SparkSession, log: DataFrame, source: DataFrame, spec: TableSpec, lake_path: str, run_date: _dt.date,
    days_back: int, options: Options, truncated: bool | None = None, **shared,
) -> lake.RewriteResult:
    if options.one_source_state:
        ensure_checkpoint_dir(spark)
        source = source.checkpoint()
    current = lake.read_lake(spark, lake_path, schema=source.schema) if options.include_previous_partition else None
    keys = resolve_affected(
        spark, log, source, spec, run_date, days_back, options.include_insert_dates, current, options.zone, **shared
    )
    if options.truncate_marks_all:
        if truncated is None:
            lo, hi = day_window(run_date, days_back, options.zone)
            truncated = cdc.truncated_in_window(log, spec.name, lo, hi)
        if truncated:
            whole = cdc.lake_partitions(lake.read_lake(spark, lake_path, schema=source.schema))
            keys = sorted(set(keys) | set(lake.collect_affected(whole)))
    return lake.rewrite_partitions(spark, source, keys, lake_path)


def refresh(
    spark: SparkSession,
    log: DataFrame,
    source: DataFrame,
    spec: TableSpec,
    lake_path: str,
    run_date: _dt.date,
    days_back: int = 0,
    include_insert_dates: bool = False,
    include_previous_partition: bool = False,
    truncate_marks_all: bool = False,
    zone: str | None = None,
    one_source_state: bool = False,
) -> lake.RewriteResult:
    """Bring the lake copy of one table in step with its source for one run.

    Jobs: a fixed handful to resolve the affected days (net-change count, then the
    source join) and one to write them; emptied days are then removed with metadata
    operations only. None of it depends on how many keys changed. See ``Options``.
    """
    options = Options(include_insert_dates, include_previous_partition, truncate_marks_all, zone, one_source_state)
    return _refresh_one(spark, log, source, spec, lake_path, run_date, days_back, options)


def _check_sources(specs, sources: dict[str, DataFrame]) -> None:
    missing = [s.name for s in specs if s.name not in sources]
    if missing:
        raise ValueError(f"no source given for: {', '.join(missing)}")


def affected_all_tables(
    spark: SparkSession,
    log: DataFrame,
    sources: dict[str, DataFrame],
    run_date: _dt.date,
    days_back: int = 0,
    specs=DEFAULT_SPECS,
    zone: str | None = None,
) -> DataFrame:
    """Affected partitions of every spec'd table as one plan (S3): ``table_name, year, month, day``.

    The net change of all tables is aggregated once and cut to the shared checkpoint folder
    (computed once), so the log window is scanned once however many tables there are, and
    one grouped count sizes the keys of all of them. A table with no events in the window
    still gets the run day(s) (B9). Every spec needs a source.
    """
    _check_sources(specs, sources)
    ensure_checkpoint_dir(spark)
    lo, hi = day_window(run_date, days_back, zone)
    net = cdc.net_actions(log, None, lo, hi, zone).checkpoint()
    deletes = cdc.delete_dates_by_table(log, lo, hi, zone).checkpoint()
    n_updated = {
        r["table_name"]: r["n"]
        for r in net.groupBy("table_name").agg(F.count_if(F.col("net_action") == "U").alias("n")).collect()
    }
    parts = [
        cdc.affected_from_net(
            spark, net, deletes, sources[s.name], s.name, run_date, days_back, s.key, s.date_col, zone=zone,
            broadcast_keys=n_updated.get(s.name, 0) <= cdc.MAX_BROADCAST_KEYS,
        ).select(F.lit(s.name).alias("table_name"), *PARTITION_COLS)
        for s in specs
    ]
    return reduce(DataFrame.unionByName, parts)


def each_table(specs, work: Callable[[TableSpec], object], spark: SparkSession, max_parallel: int) -> dict:
    """``work`` for every table, up to ``max_parallel`` at once; all are attempted, then the first failure is raised.

    The threads inherit the caller's local properties (job group, scheduler pool).
    """
    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        futures = {s.name: pool.submit(inheritable_thread_target(spark)(lambda s=s: work(s))) for s in specs}
    return {name: f.result() for name, f in futures.items()}


def run_all(
    spark: SparkSession,
    log: DataFrame | None,
    sources: dict[str, DataFrame],
    lake_root: str,
    run_date: _dt.date | None = None,
    days_back: int = 0,
    specs=DEFAULT_SPECS,
    max_parallel: int = 4,
    mode: str = "refresh",
    options: Options = Options(),
) -> dict[str, lake.RewriteResult]:
    """Backfill or refresh every spec'd table under ``lake_root/<folder>``.

    ``mode="backfill"`` replaces each lake with its source (the log is not read);
    ``mode="refresh"`` rewrites what the run's changes touch, with the same ``options`` as
    ``refresh``. One net-action aggregate over all tables is persisted and filled before any
    table starts; one job sizes the keys of all tables and finds truncates, one collects the delete days.
    Each table then resolves its own days and gets one write. Up to ``max_parallel``
    tables run at once from driver threads, so one table's small jobs overlap another's
    write. Every spec needs a source; every table writes its own folder.
    """
    _check_sources(specs, sources)
    path = lambda s: f"{lake_root.rstrip('/')}/{s.folder}"
    if mode == "backfill":
        def fill(s: TableSpec) -> lake.RewriteResult:
            lake.backfill(sources[s.name], path(s))
            written = lake.collect_affected(lake.read_lake(spark, path(s), schema=sources[s.name].schema))
            return lake.RewriteResult(affected=written, written=written)

        return each_table(specs, fill, spark, max_parallel)
    if mode != "refresh":
        raise ValueError(f"unknown mode {mode!r}: backfill or refresh")
    if log is None or run_date is None:
        raise ValueError("a refresh needs the change log and a run date")
    lo, hi = day_window(run_date, days_back, options.zone)
    actions = cdc.source_lookup_actions(options.include_insert_dates)
    net = cdc.net_actions(log, None, lo, hi, options.zone).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {  # also fills the cache that all tables read
            r["table_name"]: (r["n_src"], r["n_all"])
            for r in net.groupBy("table_name").agg(
                F.count_if(F.col("net_action").isin(*actions)).alias("n_src"), F.count(F.lit(1)).alias("n_all")
            ).collect()
        }
        deletes: dict[str, list[tuple[int, int, int]]] = {}
        for r in cdc.delete_dates_by_table(log, lo, hi, options.zone).collect():  # distinct days of each table
            deletes.setdefault(r["table_name"], []).append((r["year"], r["month"], r["day"]))
        truncated: set[str] = set()
        if options.truncate_marks_all:
            rows = cdc.changelog_window(log, None, lo, hi, ("T",), ("table_name",)).distinct().collect()
            truncated = {r["table_name"] for r in rows}

        def one(s: TableSpec) -> lake.RewriteResult:
            return _refresh_one(
                spark, log, sources[s.name], s, path(s), run_date, days_back, options, truncated=s.name in truncated,
                net=net, deletes=deletes.get(s.name, []), sizes=sizes.get(s.name, (0, 0)),
            )

        return each_table(specs, one, spark, max_parallel)
    finally:
        net.unpersist()


def run_job(
    spark: SparkSession,
    lake_root: str,
    mode: str,
    run_date: _dt.date | None = None,
    days_back: int = 0,
    specs=DEFAULT_SPECS,
    fmt: str = "jdbc",
    source_path: Callable[[TableSpec], str] | None = None,
    log_table: str = "audit.logged_actions",
    log_path: str | None = None,
    options: Options = Options(),
    max_parallel: int = 4,
    **source_options,
) -> dict[str, lake.RewriteResult]:
    """The daily program: read every spec'd table and the change log by their spec, then ``run_all``.

    ``fmt="jdbc"`` reads ``spec.source`` and ``log_table`` with ``source_options`` (see
    ``sources.jdbc.jdbc_options``); ``fmt="parquet"`` reads ``source_path(spec)`` and
    ``log_path``. Only the log's window is read.
    """
    sources = {
        s.name: jdbc.read_source(
            spark, s.source, fmt, source_path(s) if source_path else None, SCHEMAS.get(s.name), **source_options
        )
        for s in specs
    }
    log = None
    if mode == "refresh":
        if run_date is None:
            raise ValueError("a refresh needs a run date")
        lo, hi = day_window(run_date, days_back, options.zone)
        log = jdbc.read_changelog_source(spark, log_table, lo, hi, fmt=fmt, path=log_path, **source_options)
    return run_all(spark, log, sources, lake_root, run_date, days_back, specs, max_parallel, mode, replace(options))
