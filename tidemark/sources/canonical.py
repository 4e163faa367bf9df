"""Canonical CDC inputs derived from the driver's tables.

``changelog``: one audit row per ``events`` row. ``snapshot(k)``: the ``orders`` keys as
logical table number ``k`` with ``n_dates`` synthetic partition dates. Both are narrow
projections of one parquet scan each: no shuffle, and window filters reach the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import epoch_parts, epoch_seconds, ntz_literal
from ..specs import TABLE_NAMES

# Fixed values of the canonical fixture: first synthetic date 2024-01-01 (epoch
# seconds 1704067200), 60 dates, event type -> action: signup I, error D, others U.
BASE_EPOCH = 1704067200
N_DATES = 60
#: Created over the first half of these dates, so that later updates lie above the newest creation.
N_CREATED = 30
#: For fixtures with (nearly) one key per day: a hundred years, whatever the number of keys.
MANY_DATES = 36_500
ACTION_OF_EVENT = {"signup": "I", "error": "D"}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table_index(name: str) -> int:
    return TABLE_NAMES.index(name)


def synthetic_updated_at(id_col: Column, k, n_dates: int = N_DATES) -> Column:
    """``updated_at`` of a key in ``snapshot(k)``: one of ``n_dates`` days from the base."""
    return F.lit(BASE_EPOCH) + F.lit(86400) * F.pmod(id_col + k, F.lit(n_dates))


def read_changelog(
    spark: SparkSession,
    sf_dir: str,
    lo: int | None = None,
    hi: int | None = None,
    n_dates: int = N_DATES,
) -> DataFrame:
    """The audit log over ``events``.

    When an inclusive epoch window is given the filter is also stated on the raw
    ``ts`` column, so parquet row groups outside the window are skipped at the scan.
    """
    ev = spark.read.parquet(table_path(sf_dir, "events"))
    epoch = _dt.datetime(1970, 1, 1)
    if lo is not None:
        ev = ev.filter(F.col("ts") >= ntz_literal(epoch + _dt.timedelta(seconds=lo)))
    if hi is not None:
        ev = ev.filter(F.col("ts") < ntz_literal(epoch + _dt.timedelta(seconds=hi + 1)))
    k = F.pmod(F.col("event_id"), F.lit(len(TABLE_NAMES)))
    table_name = F.element_at(F.array(*[F.lit(t) for t in TABLE_NAMES]), (k + 1).cast("int"))
    action = F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for kv in ACTION_OF_EVENT.items() for x in kv]), F.col("event_type")),
        F.lit("U"),
    )
    out = ev.select(
        F.col("event_id"),
        F.lit("public").alias("schema_name"),
        table_name.alias("table_name"),
        action.alias("action"),
        epoch_seconds("ts").alias("action_tstamp_tx"),
        F.col("user_id").alias("row_data"),
        F.when(action == "D", synthetic_updated_at(F.col("user_id"), k, n_dates)).cast("bigint").alias("changed_fields"),
        F.col("props").alias("client_query"),
        F.lit(False).alias("statement_only"),
    )
    if lo is not None:
        out = out.filter(F.col("action_tstamp_tx") >= lo)
    if hi is not None:
        out = out.filter(F.col("action_tstamp_tx") <= hi)
    return out


def read_snapshot(spark: SparkSession, sf_dir: str, table: str = "order", n_dates: int = N_DATES) -> DataFrame:
    """``orders`` keys as logical table ``table`` with synthetic partition dates."""
    k = table_index(table)
    o = spark.read.parquet(table_path(sf_dir, "orders"))
    upd = synthetic_updated_at(F.col("o_orderkey"), k, n_dates)
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        (F.lit(BASE_EPOCH) + F.lit(86400) * F.pmod(F.col("o_orderkey"), F.lit(N_CREATED))).cast("bigint").alias("created_at"),
        upd.cast("bigint").alias("updated_at"),
        *epoch_parts(upd),
    )


def read_edit_pair(spark: SparkSession, sf_dir: str, table: str = "order") -> tuple[DataFrame, DataFrame]:
    """Two snapshots of the same table whose differences follow the rows' own attributes.

    Old lacks the open low-priority orders (they are inserted later); new lacks the
    finished urgent ones (deleted), has ``amount + 1`` on pending orders (updated) and
    ``updated_at + 1`` on high-priority ones (a change to that column only).
    """
    k = table_index(table)
    o = spark.read.parquet(table_path(sf_dir, "orders"))
    upd = synthetic_updated_at(F.col("o_orderkey"), k)
    base = o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        upd.cast("bigint").alias("updated_at"),
        *epoch_parts(upd),
        F.col("o_orderstatus").alias("_st"),
        F.col("o_orderpriority").alias("_pr"),
    )
    cols = ["id", "customer_id", "amount", "updated_at", "year", "month", "day"]
    old = base.filter(~((F.col("_st") == "O") & (F.col("_pr") == "5-LOW"))).select(*cols)
    new = base.filter(~((F.col("_st") == "F") & (F.col("_pr") == "1-URGENT"))).select(
        "id",
        "customer_id",
        F.when(F.col("_st") == "P", F.col("amount") + 1).otherwise(F.col("amount")).alias("amount"),
        F.when(F.col("_pr") == "2-HIGH", F.col("updated_at") + 1).otherwise(F.col("updated_at")).alias("updated_at"),
        "year",
        "month",
        "day",
    )
    return old, new
