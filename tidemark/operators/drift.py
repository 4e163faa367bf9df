"""Differences between a lake and its source found by digests, without a change log.

Two tables are equal on a set of rows if they have as many of them and the same digest: the sum and the exclusive or of a 64-bit hash of
every row, which do not depend on the order and are hash aggregates with a partial step. Days are compared first: one row per
day and side, whatever the table's size. Only within days that differ are ranges of keys compared, and only in
ranges that differ are rows joined. So a lake that has drifted in a few days costs one scan of each side, and then
those days alone (a partition filter on the lake).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.lake import collect_affected, slice_days
from ..specs import PARTITION_COLS
from .keysets import bounded_broadcast

#: Keys per range in the second step.
RANGE = 100_000


def _row_hash(columns) -> Column:
    # a null and an absent value must not look like the neighbour's: each column's place is part of it
    return F.xxhash64(*[x for i, c in enumerate(columns) for x in (F.lit(i), F.col(c).isNull(), F.col(c))])


def digests(rows: DataFrame, by, columns) -> DataFrame:
    """Rows, sum and exclusive or of the row hashes for each value of ``by``."""
    h = _row_hash(columns)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("total"), F.bit_xor(h).alias("parity"))


def _differing(lake: DataFrame, source: DataFrame, by, columns) -> DataFrame:
    a, b = digests(lake, by, columns), digests(source, by, columns)
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    for c in ("n", "total", "parity"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = a.alias("a").join(b.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by], "full")
    return joined.where(~same).select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in by])


def drifted_days(lake: DataFrame, source: DataFrame, columns=None) -> DataFrame:
    """Days whose rows differ between lake and source: year, month, day."""
    return _differing(lake, source, list(PARTITION_COLS), columns or source.columns)


def drift(lake: DataFrame, source: DataFrame, key: str = "id", columns=None, span: int = RANGE) -> DataFrame:
    """Every row that differs: the key, the day, and where it is (``lake``, ``source``, or ``both`` with other values).

    A row in other days on the two sides is reported for each of them. Keys must be unique within a day and side; rows
    without a day are not compared.
    """
    columns = list(columns or source.columns)
    days = [y * 10000 + m * 100 + d for y, m, d in collect_affected(drifted_days(lake, source, columns))]
    bucket = F.coalesce(F.expr(f"`{key}` div {span}L"), F.lit(-(2**63)))
    a, b = (slice_days(side.select(*columns), days).withColumn("_range", bucket) for side in (lake, source))
    by = [*PARTITION_COLS, "_range"]
    ranges, _ = bounded_broadcast(_differing(a, b, by, columns))  # days that differ times their key ranges: counted first
    place = [key, *PARTITION_COLS]
    sides = []
    for side, name in ((a, "lake"), (b, "source")):
        near = side.join(ranges, by, "left_semi")
        sides.append(near.select(*[F.col(c).alias(f"{name}_{c}") for c in place], _row_hash(columns).alias(f"{name}_hash"), F.lit(True).alias(f"in_{name}")))
    same = [F.col(f"lake_{c}").eqNullSafe(F.col(f"source_{c}")) for c in place]
    where = F.when(F.col("in_source").isNull(), "lake").when(F.col("in_lake").isNull(), "source").otherwise("both")
    return (
        sides[0].join(sides[1], same, "full").where(~F.col("lake_hash").eqNullSafe(F.col("source_hash")))
        .select(*[F.coalesce(f"lake_{c}", f"source_{c}").alias(c) for c in place], where.alias("side"))
    )
