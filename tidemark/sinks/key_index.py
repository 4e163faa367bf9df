"""A stored index from key to lake partition, in buckets of neighbouring keys.

To find the day under which the lake still holds a changed key, a scan would read the key column of the whole lake. The
index holds one row ``(key, year, month, day)`` for each place of a key, in folders ``bucket=<key div span>`` sorted by key, so a
lookup reads only the buckets of the changed keys (a partition filter on the scan, or dynamic pruning when there are
too many buckets to name).

An update needs no scan of the index either: a rewrite changes the places of keys only within the rewritten days, so the lake's
old rows of these days and their new ones tell which places go and which come. Places that stay are not
touched, and only the buckets of the others are rewritten, staged with the lake's partitions and published under the same
journal (``sinks.publish``).

``span``: keys per bucket. A bucket is rewritten as a whole, so it should hold a few million keys: at a trillion keys and the
default, 250,000 folders of 4 million keys. Each touched bucket costs a few files and renames, one after the other on the driver, whatever it
holds; so ``build`` widens a span that would make more than ``MAX_BUCKETS`` buckets of less than ``FULL_BUCKET`` places.
Keys are integers.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import date_key
from ..operators.keysets import bounded_broadcast
from ..specs import PARTITION_COLS
from .publish import Files, Run

SPAN = 4_000_000
#: More buckets than this are made only of this many places on average.
MAX_BUCKETS, FULL_BUCKET = 256, 1_000_000
#: Most buckets that are named in a partition filter; beyond, the join prunes.
MAX_NAMED_BUCKETS = 10_000
_META = "_index.json"


class KeyIndex:
    """The index stored below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        meta = json.loads(Files(spark, self.path).read(f"{self.path}/{_META}"))
        self.key, self.span = meta["key"], meta["span"]

    @classmethod
    def build(cls, lake: DataFrame, path: str, key: str = "id", span: int = SPAN) -> KeyIndex:
        """Index a whole lake (two scans of its key column)."""
        spark, path = lake.sparkSession, path.rstrip("/")
        span = _widened(lake, key, span)
        _write(_places(lake, key), key, span, path)
        Files(spark, path).write(f"{path}/{_META}", json.dumps({"key": key, "span": span}))
        return cls(spark, path)

    def bucket(self) -> Column:
        return _bucket(self.key, self.span)

    def read(self) -> DataFrame:
        """All places: key, year, month, day, bucket."""
        ddl = f"`{self.key}` bigint, " + ", ".join(f"{c} bigint" for c in PARTITION_COLS) + ", bucket bigint"
        return self.spark.read.schema(ddl).parquet(self.path)

    def buckets_of(self, keys: DataFrame) -> list[int] | None:
        """The buckets of some keys (one column), or None if there are more than ``MAX_NAMED_BUCKETS``."""
        found = keys.select(F.col(keys.columns[0]).alias(self.key)).select(self.bucket().alias("b")).where("b IS NOT NULL").distinct()
        rows = found.limit(MAX_NAMED_BUCKETS + 1).collect()
        return sorted(r["b"] for r in rows) if len(rows) <= MAX_NAMED_BUCKETS else None

    def named(self, buckets: list[int] | None) -> DataFrame:
        """The places in some buckets."""
        return self.read() if buckets is None else self.read().where(F.col("bucket").isin(buckets))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Places of the keys (one column, any type of integer): key, year, month, day."""
        own, _ = bounded_broadcast(keys.select(F.col(keys.columns[0]).cast("bigint").alias(self.key)).where(F.col(self.key).isNotNull()).distinct())
        wanted = own.select(self.key, self.bucket().alias("bucket"))
        return self.named(self.buckets_of(own)).join(wanted, [self.key, "bucket"], "left_semi").select(self.key, *PARTITION_COLS)

    def days_of(self, keys: DataFrame) -> list[tuple[int, int, int]]:
        """The distinct days of the keys' places, on the driver (bounded by the calendar)."""
        rows = self.lookup(keys).select(*PARTITION_COLS).distinct().collect()
        return sorted(tuple(r) for r in rows)

    def stage(self, run: Run, old: DataFrame, new: DataFrame) -> list[str]:
        """Stage the buckets that change when the lake's rows ``old`` are replaced by ``new``, and plan their swap.

        Both hold the key and the partition columns of all rows of the rewritten days. Returns the buckets' folders.
        """
        columns = [self.key, *PARTITION_COLS]
        before, after = _places(old, self.key), _places(new, self.key)
        sided = before.select(*columns, F.lit(-1).alias("side")).unionByName(after.select(*columns, F.lit(1).alias("side")))
        changes, _ = bounded_broadcast(
            sided.groupBy(*columns).agg(F.sum("side").alias("side")).where("side <> 0").withColumn("bucket", self.bucket()))
        named = changes.select("bucket").distinct()
        touched = sorted(r["bucket"] for r in named.collect())  # each is a folder to swap
        if not touched:
            return []
        kept = self.named(touched if len(touched) <= MAX_NAMED_BUCKETS else None)
        if len(touched) > MAX_NAMED_BUCKETS:
            kept = kept.join(F.broadcast(named), "bucket", "left_semi")
        kept = kept.join(changes.where("side < 0"), [*columns, "bucket"], "left_anti").select(*columns)
        added = changes.where("side > 0").select(*columns)
        _write(kept.unionByName(added), self.key, self.span, run.stage(self.path))
        folders = [f"bucket={b}" for b in touched]
        run.replace(folders, 1, self.path)
        return folders


def _bucket(key: str, span: int) -> Column:
    """``key`` divided by ``span``, rounded down."""
    return F.expr(f"`{key}` div {span}L - CASE WHEN `{key}` % {span}L < 0 THEN 1 ELSE 0 END")


def _widened(lake: DataFrame, key: str, span: int) -> int:
    """``span``, doubled until the lake's keys make few enough buckets, or full ones."""
    own = lake.select(F.col(key).cast("bigint").alias(key)).where(F.col(key).isNotNull())
    sizes = own.groupBy(_bucket(key, span).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.count(F.lit(1)).alias("buckets"), F.sum("n").alias("rows")).first()
    most = max(MAX_BUCKETS, (found["rows"] or 0) // FULL_BUCKET)
    while found["buckets"] > most and span < 1 << 61:
        span *= 2
        found = {"buckets": (found["buckets"] + 1) // 2}
    return span


def _places(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("bigint").alias(key), *[F.col(c).cast("bigint").alias(c) for c in PARTITION_COLS]).where(
        F.col(key).isNotNull()).distinct()


def _write(places: DataFrame, key: str, span: int, path: str) -> None:
    (
        places.withColumn("bucket", _bucket(key, span)).hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", key, date_key()).write.mode("overwrite").partitionBy("bucket").parquet(path)
    )


def day_folders(days: Iterable[tuple[int, int, int]]) -> list[str]:
    return ["/".join(f"{c}={v}" for c, v in zip(PARTITION_COLS, d)) for d in days]
