"""Date-partitioned parquet lake: backfill, partition rewrite, clearing, flat export.

A refresh touches the lake with one write job whatever the number of changed keys:

1. the affected set A (distinct calendar days, so bounded by the calendar and not by the
   data) is collected;
2. the source meets A in a semi-join with the broadcast day set, after the implied
   ``year IN .. AND month IN .. AND day IN ..``, which a partitioned source takes as a
   partition filter and a flat one as pushed filters. The path is the same for any size of A;
3. the slice is rebalanced on the partition columns (AQE splits a hot day into several
   tasks and merges small ones) and written with dynamic partition overwrite; the same
   job reports, through an ``Observation``, which days it wrote;
4. days of A the write did not produce are emptied partitions and are removed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.timeutil import date_key
from ..specs import PARTITION_COLS

@dataclass
class RewriteResult:
    affected: list[tuple[int, int, int]] = field(default_factory=list)
    written: list[tuple[int, int, int]] = field(default_factory=list)
    emptied: list[tuple[int, int, int]] = field(default_factory=list)


def _split_key(k: int) -> tuple[int, int, int]:
    return k // 10000, (k // 100) % 100, k % 100


def _cast_parts(df: DataFrame, cols=PARTITION_COLS) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


def read_lake(spark: SparkSession, path: str, cols=PARTITION_COLS, schema: StructType | None = None) -> DataFrame:
    """Read a partitioned lake; partition columns come back as bigint.

    With ``schema`` nothing is inferred, and a lake with no data files yet reads as empty.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _cast_parts(reader.parquet(path), cols)


def backfill(source: DataFrame, path: str, cols=PARTITION_COLS) -> None:
    """Replace the whole lake with the source, partitioned by date."""
    (
        _cast_parts(source, cols)
        .hint("rebalance", *cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*cols)
        .parquet(path)
    )


def collect_affected(affected: DataFrame) -> list[tuple[int, int, int]]:
    """The affected days on the driver: distinct days, so at most as many as the calendar has."""
    rows = affected.select(*PARTITION_COLS).dropna().distinct().collect()
    return sorted((int(r[0]), int(r[1]), int(r[2])) for r in rows)


def slice_days(source: DataFrame, day_keys) -> DataFrame:
    """Rows of the given days (yyyymmdd keys).

    The exact test is a semi-join with the day set, which is broadcast (one small row per
    calendar day, and their number is known here). The implied ``year IN .. AND month IN
    .. AND day IN ..`` is stated first: plain column filters that prune the folders of a
    date-partitioned source, and that reach a flat parquet scan (row groups skipped by
    their min/max) and a JDBC source (a WHERE clause the database can index).
    """
    parts = [_split_key(k) for k in sorted(day_keys)]
    implied = [F.col(c).isin(sorted({p[i] for p in parts})) for i, c in enumerate(PARTITION_COLS)]
    ddl = ", ".join(f"{c} bigint" for c in PARTITION_COLS)
    days = F.broadcast(source.sparkSession.createDataFrame(parts, ddl))
    return _cast_parts(source).filter(implied[0] & implied[1] & implied[2]).join(days, list(PARTITION_COLS), "left_semi").select(
        *source.columns
    )


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def clear_partitions(spark: SparkSession, path: str, parts, cols=PARTITION_COLS) -> int:
    """Remove the folders of the given partitions (metadata operations only).

    Dynamic overwrite leaves a partition untouched when the new data has no row for it,
    so a partition that became empty must be removed explicitly (B6, B7). One listing per
    month that holds such a day finds the folders there are; only these are deleted, and
    a month or year folder left without any child goes too.
    """
    fs, root = hadoop_fs(spark, path.rstrip("/"))
    join = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    gone = {"/".join(f"{c}={int(v)}" for c, v in zip(cols, p)) for p in parts}
    n = 0
    for depth in range(len(cols) - 1, -1, -1):
        emptied = set()
        for parent in sorted({g.rpartition("/")[0] for g in gone}):
            folder = join(root, parent) if parent else root
            if not fs.exists(folder):
                continue
            left = 0
            for st in fs.listStatus(folder):
                name = f"{parent}/{st.getPath().getName()}".lstrip("/")
                if name in gone:
                    fs.delete(st.getPath(), True)
                    n += depth == len(cols) - 1
                else:
                    left += 1
            if not left and parent:
                emptied.add(parent)
        gone = emptied
    return n


def rewrite_partitions(
    spark: SparkSession,
    source: DataFrame,
    affected: DataFrame | list,
    path: str,
    clear_emptied: bool = True,
) -> RewriteResult:
    """Replace exactly the partitions in ``affected`` with the source's rows.

    Partitions outside the set keep their files; affected partitions with no source row
    are removed. One write job regardless of how many keys changed.
    """
    keys = affected if isinstance(affected, list) else collect_affected(affected)
    result = RewriteResult(affected=list(keys))
    if not keys:
        return result
    day_keys = sorted({y * 10000 + m * 100 + d for y, m, d in keys})
    slice_ = slice_days(source, day_keys)
    obs = Observation(f"tidemark_rewrite_{uuid.uuid4().hex}")  # unique: tables may be rewritten concurrently
    slice_ = slice_.observe(obs, F.collect_set(date_key()).alias("written"))
    (
        slice_.hint("rebalance", *PARTITION_COLS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLS)
        .parquet(path)
    )
    written = _observed_days(obs)
    if written is None:
        # the optimizer may drop the metrics node (e.g. a slice it proves empty); ask directly,
        # the answer is bounded by the affected set
        written = {int(r[0]) for r in slice_days(source, day_keys).select(date_key()).distinct().collect()}
    result.written = [_split_key(k) for k in sorted(written)]
    result.emptied = [_split_key(k) for k in day_keys if k not in written]
    if clear_emptied and result.emptied:
        clear_partitions(spark, path, result.emptied)
    return result


def _observed_days(obs: Observation) -> set[int] | None:
    try:
        metrics = obs.get
    except Exception:  # noqa: BLE001 - metrics missing when the observed node was optimized away
        return None
    if "written" not in metrics:
        return None
    return {int(k) for k in (metrics["written"] or [])}


def export_flat(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One flat parquet export; by default fails if the target exists (K5)."""
    df.write.mode(mode).parquet(path)


def write_incremental(df: DataFrame, path: str, cols=PARTITION_COLS) -> None:
    """Write an incremental slice, replacing only the partitions it contains (K6)."""
    (
        _cast_parts(df, cols)
        .hint("rebalance", *cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .parquet(path)
    )
