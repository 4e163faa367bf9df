"""The change log as a store that finds a key's events without reading the log.

Rows lie in one folder per day of their transaction (``log_day=<yyyymmdd>``), sorted by table and key within each file, with a bloom filter
on the key in every row group. A window of time reads its folders only; a table reads the row groups whose table range holds it; a
key reads those whose key range and bloom filter admit it, and within them the pages that the column index admits. So the history
of some keys over all days costs footers and a few pages per file, not the log.

The log only grows, so a day is loaded again as a whole: ``load`` stages the days of a window and swaps them in under a
journal (``sinks.publish``). Loading a window twice, or after a stop, leaves each event once.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeutil import date_key, day_window, epoch_parts
from ..operators.keysets import MAX_KEY_LITERALS, bounded_broadcast
from . import publish

#: Row groups small enough that one key's events are a small part of what is read.
ROW_GROUP_BYTES = 16 << 20
#: Distinct keys that a row group's bloom filter is sized for.
KEYS_PER_GROUP = 200_000


def _day(log: DataFrame) -> DataFrame:
    parts = epoch_parts("action_tstamp_tx")
    return log.withColumns({f"_{n}": p for n, p in zip("ymd", parts)}).withColumn("log_day", date_key("_y", "_m", "_d")).drop("_y", "_m", "_d")


def load(
    log: DataFrame, path: str, first: _dt.date, last: _dt.date, keys_per_group: int = KEYS_PER_GROUP,
    row_group_bytes: int = ROW_GROUP_BYTES, step: Callable[[str], None] | None = None,
) -> list[int]:
    """Store the log's rows of the days ``first`` to ``last``, replacing what the store holds of them. Returns the days that have rows.

    Rows without a transaction time belong to no day and are an error, so that none is lost silently.
    """
    spark = log.sparkSession
    publish.recover(spark, path)
    if log.where("action_tstamp_tx IS NULL").limit(1).count():
        raise ValueError("the change log has rows without a transaction time")
    lo, hi = day_window(first)[0], day_window(last)[1]
    run = publish.Run(spark, path, step=step)
    own = _day(log.where(F.col("action_tstamp_tx").between(lo, hi)))
    (
        own.hint("rebalance", "log_day").sortWithinPartitions("log_day", "table_name", "row_data", "action_tstamp_tx", "event_id")
        .write.mode("overwrite").option("parquet.bloom.filter.enabled#row_data", "true")
        .option("parquet.bloom.filter.expected.ndv#row_data", str(keys_per_group))
        .option("parquet.block.size", str(row_group_bytes)).partitionBy("log_day").parquet(run.stage())
    )
    days = [first + _dt.timedelta(days=i) for i in range((last - first).days + 1)]
    stored, _ = run.replace([f"log_day={d:%Y%m%d}" for d in days], 1)
    run.publish()
    return [int(f.partition("=")[2]) for f in stored]


def read(spark: SparkSession, path: str, schema: T.StructType, first: _dt.date | None = None, last: _dt.date | None = None) -> DataFrame:
    """The stored log (its schema as given), or that of some days: only their folders are read."""
    whole = T.StructType([*schema.fields, T.StructField("log_day", T.LongType())])
    rows = spark.read.schema(whole).parquet(path)
    if first is not None:
        rows = rows.where(F.col("log_day") >= int(f"{first:%Y%m%d}"))
    if last is not None:
        rows = rows.where(F.col("log_day") <= int(f"{last:%Y%m%d}"))
    return rows.drop("log_day")


def history(stored: DataFrame, table: str, keys: DataFrame) -> DataFrame:
    """Every event of some keys (one column) of a table, in no order.

    The keys are counted first. Up to ``MAX_KEY_LITERALS`` their range is stated as a plain filter as well, and up to ten (the scan's
    limit for lists) the keys themselves, which the scan checks against row groups and bloom filters; the exact test is the join.
    """
    own, n = bounded_broadcast(keys.select(F.col(keys.columns[0]).cast("bigint").alias("row_data")).where("row_data IS NOT NULL").distinct())
    rows = stored.where(F.col("table_name") == table)
    limit = int(keys.sparkSession.conf.get("spark.sql.parquet.pushdown.inFilterThreshold"))
    if n <= limit:
        values = sorted(r["row_data"] for r in own.collect())
        return rows.where(F.col("row_data").isin(values))
    if n <= MAX_KEY_LITERALS:
        lo, hi = own.agg(F.min("row_data"), F.max("row_data")).first()
        rows = rows.where(F.col("row_data").between(lo, hi))
    return rows.join(own, "row_data", "left_semi").select(*stored.columns)
