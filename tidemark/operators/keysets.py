"""Key sets that meet a large table: materialised once, broadcast only after a size check.

A change set (keys that changed today) is usually tiny next to the table it is joined
with. If the planner cannot know that, it plans a sort-merge join, and AQE re-plans to
a broadcast only after the large side has already been shuffled. So the key set is
cut here: written to the shared checkpoint folder (computed once, survives the loss of
an executor), counted, and hinted for broadcast only at or below ``MAX_BROADCAST_KEYS``.
Then the large side is streamed through the join and never shuffled. Above the bound,
the join is left to the planner (both sides shuffled on the key), but the large side is first
cut to a few intervals that cover the keys: a plain column filter, which a parquet scan and a JDBC
source both take, so that only rows near a key are shuffled.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: Most keys that may be broadcast. A bigint key costs ~16-24 bytes in a hashed
#: relation, so 4M keys stay under ~100 MB per executor.
MAX_BROADCAST_KEYS = 4_000_000


#: Most keys that are collected and sent to a source as one ``key IN (..)`` filter. A
#: JDBC source answers it from its primary-key index. A parquet scan uses more than a few
#: values (``spark.sql.parquet.pushdown.inFilterThreshold``) only as a range, so scattered
#: keys still read the whole key column there: what is saved is the join, not the scan.
#: Above this, keys meet the source in a join.
MAX_KEY_LITERALS = 10_000


#: Most intervals in a pushed filter, and ranges of keys per interval that are sorted to find them.
MAX_INTERVALS = 32
RANGES_PER_INTERVAL = 16

_log = logging.getLogger(__name__)


@dataclass(frozen=True)
class KeyIntervals:
    """Closed intervals, in order and apart, that hold every key of a set.

    ``n_keys`` counts the set's rows; ``covered`` is the share of the span between the least and the
    greatest key that lies inside the intervals: how much of a table with evenly spread keys passes the filter.
    """

    column: str
    intervals: tuple[tuple[int, int], ...]
    n_keys: int

    @property
    def covered(self) -> float:
        if not self.intervals:
            return 0.0
        span = self.intervals[-1][1] - self.intervals[0][0] + 1
        return sum(hi - lo + 1 for lo, hi in self.intervals) / span

    def condition(self) -> Column:
        """True for rows that may hold a key; of no keys, never."""
        tests = [F.col(self.column).between(lo, hi) for lo, hi in self.intervals]
        return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def key_intervals(keys: DataFrame, col: str, n: int | None = None) -> KeyIntervals | None:
    """At most ``n`` intervals that cover the integer keys ``col``; None for keys of another type.

    The cover is the tightest there is: it is cut at the ``n - 1`` largest gaps between neighbouring keys. The keys are
    range-partitioned, which follows their density; gaps within a range come from its sorted keys, of which only the
    ``n - 1`` largest over all ranges are collected, and gaps between ranges from one row per range. So at most
    ``n * (RANGES_PER_INTERVAL + 1)`` rows come to the driver, whatever the number of keys, and no task
    holds more than a range. Null keys match nothing and are left out. Repeated keys do no harm.
    """
    if not isinstance(keys.schema[col].dataType, T.IntegralType):
        return None
    n = n or MAX_INTERVALS
    ranged = (
        keys.select(F.col(col).cast("bigint").alias("k")).where("k IS NOT NULL")
        .repartitionByRange(n * RANGES_PER_INTERVAL, "k").withColumn("p", F.spark_partition_id())
    )
    rows = ranged.groupBy("p").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n")).collect()
    if not rows:
        return KeyIntervals(col, (), 0)
    ranges = sorted((r["lo"], r["hi"]) for r in rows)
    gaps = {(a[1], b[0]) for a, b in zip(ranges, ranges[1:])}
    if n > 1:
        # a decimal, as the difference of two keys may not fit a bigint
        width = F.col("k").cast("decimal(20,0)") - F.col("before").cast("decimal(20,0)")
        before = F.lag("k").over(Window.partitionBy("p").orderBy("k"))
        inner = ranged.withColumn("before", before).where(width > 1).orderBy(width.desc(), "k").limit(n - 1)
        gaps |= {(r["before"], r["k"]) for r in inner.select("before", "k").collect()}
    # neighbouring keys have no gap between them: nothing is gained by a cut there
    widest = sorted((g for g in gaps if g[1] - g[0] > 1), key=lambda g: (g[0] - g[1], g))[: n - 1]
    ends = [ranges[0][0], *(k for g in sorted(widest) for k in g), ranges[-1][1]]
    found = KeyIntervals(col, tuple(zip(ends[::2], ends[1::2])), sum(r["n"] for r in rows))
    _log.info("%d keys in %d intervals, which cover %.4f of their span", found.n_keys, len(found.intervals), found.covered)
    return found


def near_keys(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """The rows of ``df`` within the intervals of the keys; all rows where the keys have no intervals."""
    found = key_intervals(keys, col)
    return df if found is None else df.where(found.condition())


def bounded_key_values(
    keys: DataFrame, col: str, max_rows: int = MAX_KEY_LITERALS, known_at_most: int | None = None
) -> list | None:
    """The distinct values of ``col`` when there are at most ``max_rows`` of them, else None.

    ``known_at_most``: a count the caller already has that bounds the distinct values
    (e.g. rows of the set). Then, if it is within ``max_rows``, the values are collected
    by one plain job. Otherwise a ``limit(max_rows + 1)`` collect decides: at most
    ``max_rows + 1`` values reach the driver. That collect is an incremental take, whose
    number of jobs depends on how the rows lie over partitions.
    """
    if known_at_most is not None and known_at_most > max_rows:
        return None
    picked = keys.select(col).distinct()
    rows = picked.collect() if known_at_most is not None else picked.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return sorted(r[0] for r in rows if r[0] is not None)


def bounded_broadcast(keys: DataFrame, max_rows: int | None = MAX_BROADCAST_KEYS) -> tuple[DataFrame, int]:
    """``(keys, n)``: the key set cut from its lineage, with a broadcast hint when ``n <= max_rows``.

    ``max_rows=None`` skips the check and returns the plan unchanged (``n = -1``).
    """
    if max_rows is None:
        return keys, -1
    ensure_checkpoint_dir(keys.sparkSession)
    cut = keys.checkpoint(eager=True)
    n = cut.count()
    return (F.broadcast(cut) if n <= max_rows else cut), n
