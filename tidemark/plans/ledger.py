"""A stored ledger of covered windows: missed days are found and caught up, a stopped backfill goes on.

Each run that has ended adds a row: table, first and last second covered, run name and kind. Rows are only added, one small file a
run, so a run that stops before its row simply has not happened and is done again. Which seconds no run has covered
is a gaps-and-islands question over these rows: windows that overlap or touch make an island, what lies between two
islands is a gap. ``catch_up`` refreshes each table over its gaps, days that follow each other in one run.

The ledger grows with runs and tables, not with the data; ``compact`` rewrites it as its islands.
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeutil import day_window
from ..sinks import lake
from ..sinks.publish import Files, Run
from ..specs import DEFAULT_SPECS, TableSpec
from . import refresh as refresh_plan

ROWS = "rows=0"
SCHEMA = "table_name string, lo bigint, hi bigint, run string, kind string"


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows; none if there is no ledger yet."""
    if not Files(spark, path).exists(f"{path}/{ROWS}"):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{path}/{ROWS}")


def record(windows: DataFrame, path: str, run: str, kind: str = "refresh") -> None:
    """Add windows (table_name, lo, hi in epoch seconds, both included) that a run has covered."""
    rows = windows.select("table_name", "lo", "hi", F.lit(run).alias("run"), F.lit(kind).alias("kind"))
    rows.coalesce(1).write.mode("append").parquet(f"{path}/{ROWS}")


def islands(windows: DataFrame, by=("table_name",)) -> DataFrame:
    """Windows that overlap or touch, as one: the columns ``by``, lo, hi."""
    order = Window.partitionBy(*by).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    started = windows.where("lo <= hi").select(*by, "lo", "hi", (reach.isNull() | (F.col("lo") > reach + 1)).cast("int").alias("first"))
    numbered = started.withColumn("island", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("island")


def gaps(windows: DataFrame, tables: DataFrame, lo: int, hi: int) -> DataFrame:
    """What no window covers between ``lo`` and ``hi``, for each row of ``tables`` (table_name): table_name, lo, hi."""
    ends = tables.select("table_name").distinct().select(
        "table_name", F.explode(F.array(F.lit(lo - 1).cast("bigint"), F.lit(hi + 1).cast("bigint"))).alias("lo")
    ).withColumn("hi", F.col("lo"))
    inside = windows.select(
        "table_name", F.greatest("lo", F.lit(lo)).alias("lo"), F.least("hi", F.lit(hi)).alias("hi")
    ).join(ends.select("table_name").distinct(), "table_name", "left_semi")
    held = islands(inside.where("lo <= hi").unionByName(ends))
    after = F.lead("lo").over(Window.partitionBy("table_name").orderBy("lo"))
    return (
        held.select("table_name", F.col("hi").alias("left"), after.alias("right")).where("right > left + 1")
        .select("table_name", (F.col("left") + 1).alias("lo"), (F.col("right") - 1).alias("hi"))
    )


def _day(second: int, zone: str | None) -> _dt.date:
    return _dt.datetime.fromtimestamp(second, ZoneInfo(zone) if zone else _dt.timezone.utc).date()


def missed_days(spark: SparkSession, path: str, first: _dt.date, last: _dt.date, specs=DEFAULT_SPECS,
                zone: str | None = None) -> dict[str, list[tuple[_dt.date, _dt.date]]]:
    """Runs of days, by table, of which some part is not covered (bounded by tables and calendar)."""
    names = spark.createDataFrame([(s.name,) for s in specs], "table_name string")
    lo, hi = day_window(first, zone=zone)[0], day_window(last, zone=zone)[1]
    out: dict[str, list[tuple[_dt.date, _dt.date]]] = {s.name: [] for s in specs}
    for r in gaps(read(spark, path), names, lo, hi).orderBy("table_name", "lo").collect():
        a, b = _day(r["lo"], zone), _day(r["hi"], zone)
        own = out[r["table_name"]]
        if own and a <= own[-1][1] + _dt.timedelta(days=1):
            own[-1] = (own[-1][0], max(b, own[-1][1]))
        else:
            own.append((a, b))
    return out


def _covered(spark: SparkSession, path: str, spec: TableSpec, first: _dt.date, last: _dt.date, run: str, kind: str, zone: str | None) -> None:
    window = (spec.name, day_window(first, zone=zone)[0], day_window(last, zone=zone)[1])
    record(spark.createDataFrame([window], "table_name string, lo bigint, hi bigint"), path, run, kind)


def catch_up(
    spark: SparkSession,
    path: str,
    log: DataFrame,
    sources: dict[str, DataFrame],
    lake_root: str,
    first: _dt.date,
    last: _dt.date,
    specs=DEFAULT_SPECS,
    zone: str | None = None,
    run: str | None = None,
    **options,
) -> dict[str, list[tuple[_dt.date, _dt.date]]]:
    """Refresh every table over the days from ``first`` to ``last`` that the ledger does not cover, and record them.

    Usually that is the last day alone; after missed runs, the missed days as well. ``options``: those of
    ``refresh``. Returns the runs of days done.
    """
    refresh_plan._check_sources(specs, sources)
    missed = missed_days(spark, path, first, last, specs, zone)
    for spec in specs:
        for a, b in missed[spec.name]:
            refresh_plan.refresh(
                spark, log, sources[spec.name], spec, f"{lake_root.rstrip('/')}/{spec.folder}", b, (b - a).days, zone=zone, **options)
            _covered(spark, path, spec, a, b, run or f"catch-up-{last}", "refresh", zone)
    return missed


def backfill(
    spark: SparkSession,
    path: str,
    sources: dict[str, DataFrame],
    lake_root: str,
    first: _dt.date,
    last: _dt.date,
    run: str,
    specs=DEFAULT_SPECS,
    zone: str | None = None,
) -> list[str]:
    """Backfill every table once under a run name, covering the days ``first`` to ``last``.

    Called again with the same name after a stop, it goes on with the tables that are not recorded. Returns the tables done
    this time.
    """
    refresh_plan._check_sources(specs, sources)
    rows = read(spark, path).where((F.col("run") == run) & (F.col("kind") == "backfill")).select("table_name").distinct().collect()
    done = {r["table_name"] for r in rows}
    now = [s for s in specs if s.name not in done]
    for spec in now:
        lake.backfill(sources[spec.name], f"{lake_root.rstrip('/')}/{spec.folder}")
        _covered(spark, path, spec, first, last, run, "backfill", zone)
    return [s.name for s in now]


def compact(spark: SparkSession, path: str) -> None:
    """Rewrite the ledger as its islands, published as a whole; refreshes lose their run names. Not while a run records."""
    rows = read(spark, path).withColumn("run", F.when(F.col("kind") == "backfill", F.col("run")).otherwise("compacted"))
    run = Run(spark, path)
    merged = islands(rows, ("table_name", "run", "kind")).select("table_name", "lo", "hi", "run", "kind")
    merged.coalesce(1).write.parquet(f"{run.stage()}/{ROWS}")
    run.replace([ROWS], 1)
    run.publish()
