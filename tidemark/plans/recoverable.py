"""The daily refresh as a staged publish, with the key index instead of a scan of the lake."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..functions.timeutil import day_window
from ..operators import cdc
from ..sinks import lake, publish
from ..sinks.key_index import SPAN, KeyIndex, day_folders
from ..specs import PARTITION_COLS, TableSpec
from .refresh import resolve_affected


def backfill_indexed(source: DataFrame, spec: TableSpec, lake_path: str, index_path: str, span: int = SPAN) -> KeyIndex:
    """Replace the whole lake with the source and index it."""
    lake.backfill(source, lake_path)
    whole = lake.read_lake(source.sparkSession, lake_path, schema=source.schema)
    return KeyIndex.build(whole, index_path, spec.key, span)


def refresh_published(
    spark: SparkSession,
    log: DataFrame,
    source: DataFrame,
    spec: TableSpec,
    lake_path: str,
    run_date: _dt.date,
    days_back: int = 0,
    include_insert_dates: bool = False,
    index_path: str | None = None,
    zone: str | None = None,
    unfinished: str = "resume",
    step: Callable[[str], None] | None = None,
) -> lake.RewriteResult:
    """``refresh`` that can stop anywhere: the lake (and its index) is the old or the new one once ``publish.recover`` has run.

    What an earlier run left is brought to an end first (``unfinished``: resume or undo). The affected days are those
    of ``refresh``; with ``index_path``, also every day under which the lake still holds a changed key, looked up in the
    index. The slice is written once, beside the lake; folders are then swapped under the journal.
    """
    step = step or (lambda _: None)
    publish.recover(spark, lake_path, unfinished, also=[index_path] if index_path else ())
    lo, hi = day_window(run_date, days_back, zone)
    net = cdc.net_actions(log, spec.name, lo, hi, zone).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        days = resolve_affected(spark, log, source, spec, run_date, days_back, include_insert_dates, zone=zone, net=net)
        index = KeyIndex(spark, index_path) if index_path else None
        if index:
            days = sorted(set(days) | set(index.days_of(net.select("id"))))
    finally:
        net.unpersist()
    run = publish.Run(spark, lake_path, step=step)
    step("stage")
    keys = [y * 10000 + m * 100 + d for y, m, d in days]
    (
        lake.slice_days(source, keys).hint("rebalance", *PARTITION_COLS)
        .write.mode("overwrite").partitionBy(*PARTITION_COLS).parquet(run.stage())
    )
    written, emptied = run.replace(day_folders(days), len(PARTITION_COLS))
    if index:
        step("stage index")
        columns = [spec.key, *PARTITION_COLS]
        old = lake.slice_days(lake.read_lake(spark, lake_path, schema=source.schema), keys)
        new = lake.read_lake(spark, run.stage(), schema=source.schema)
        index.stage(run, old.select(*columns), new.select(*columns))
    run.publish()
    as_days = lambda folders: [tuple(int(x.partition("=")[2]) for x in f.split("/")) for f in folders]
    return lake.RewriteResult(affected=days, written=sorted(as_days(written)), emptied=sorted(as_days(emptied)))
