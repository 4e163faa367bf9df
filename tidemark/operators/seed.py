"""Seed rows and backdating.

Seeds derive from existing key columns (deterministic: names are ``md5`` of the key,
foreign keys ``1 + key mod 101``), so they are reproducible and grow with the input.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import fk_in_range, md5_of, with_defaults
from ..functions.timeutil import date_parts, epoch_to_date, now_epoch

# Fixed values of the backdating job: (exclusive lower id, exclusive upper id, days back).
# id < 10000: 49; 10000 < id < 20000: 39; 20000 < id < 40000: 29; 40000 < id < 60000: 19;
# 60000 < id < 80000: 9. Ids 10000, 20000, 40000, 60000 and from 80000 up keep their dates.
BACKDATE_BANDS = (
    (None, 10000, 49),
    (10000, 20000, 39),
    (20000, 40000, 29),
    (40000, 60000, 19),
    (60000, 80000, 9),
)


def seed_table(keys: DataFrame, table: str, key: str, now: _dt.datetime | None = None) -> DataFrame:
    """Rows of logical ``table`` for each key value, other columns by the seed rules (G1)."""
    ids = keys.select(F.col(key).cast("bigint").alias("id"))
    if table in ("customer", "manufacturer"):
        ids = ids.withColumn("name", md5_of("id"))
    elif table == "product":
        ids = ids.withColumn("manufacture_id", fk_in_range("id"))
    elif table == "order":
        ids = ids.withColumn("customer_id", fk_in_range("id"))
    elif table == "order_items":
        ids = ids.withColumns({"order_id": fk_in_range("id"), "product_id": fk_in_range("id")})
    return with_defaults(ids, table, now)


def band_days(id_col: Column, bands=BACKDATE_BANDS) -> Column:
    """Days to move a row back, by strict id bands; NULL when no band applies."""
    expr = None
    for lo, hi, days in bands:
        cond = id_col < hi if lo is None else (id_col > lo) & (id_col < hi)
        expr = F.when(cond, F.lit(days)) if expr is None else expr.when(cond, F.lit(days))
    return expr


def seed_backdate(df: DataFrame, now: _dt.datetime, key: str = "id", bands=BACKDATE_BANDS) -> DataFrame:
    """Move ``created_at``, ``updated_at`` and the date parts back by the id band.

    Epochs become ``now - days`` (seconds); the date parts become the calendar date of
    ``now - days``. Rows outside every band are unchanged.
    """
    days = band_days(F.col(key), bands)
    base = now_epoch(now)
    moved = base - days * 86400
    y, m, d = date_parts(epoch_to_date(moved))
    hit = days.isNotNull()
    return df.withColumns(
        {
            "created_at": F.when(hit, moved).otherwise(F.col("created_at")).cast("bigint"),
            "updated_at": F.when(hit, moved).otherwise(F.col("updated_at")).cast("bigint"),
            "year": F.when(hit, y).otherwise(F.col("year")),
            "month": F.when(hit, m).otherwise(F.col("month")),
            "day": F.when(hit, d).otherwise(F.col("day")),
        }
    )
