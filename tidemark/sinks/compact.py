"""Small files of a lake's days packed by size, without touching anything else.

A stream adds a few files to a day with every batch. ``compact_lake`` lists the data files (metadata only), picks the days with several
small ones and rewrites just these files: they are read by name, rebalanced on the day and written beside the lake; then
the new files are added and the old ones removed under a journal. Files that a running copy adds meanwhile are in nobody's
plan and stay. A stop leaves the lake to be resumed or undone (``publish.recover(.., prefix="compact-")``).

While files are swapped, a reader may see a day's rows twice for the moment between adding and removing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..session import TARGET_PARTITION_BYTES
from ..specs import PARTITION_COLS
from . import publish


def small_files(files: publish.Files, path: str, target_bytes: int, depth: int) -> dict[str, list[str]]:
    """Partition -> its files of less than half the target, where there are at least two."""
    out = {}
    for folder in publish.partition_folders(files, path, depth):
        names = sorted(n for n, size in files.sizes(f"{path}/{folder}").items() if size < target_bytes // 2)
        if len(names) > 1:
            out[folder] = names
    return out


def compact_lake(
    spark: SparkSession, path: str, schema: T.StructType, target_bytes: int = TARGET_PARTITION_BYTES, cols=PARTITION_COLS,
    unfinished: str = "resume", step: Callable[[str], None] | None = None,
) -> dict[str, tuple[int, int]]:
    """Pack the small files of every day. Returns partition -> files before and after, for the days packed.

    ``schema``: that of the lake, partition columns included. ``target_bytes`` should be the session's advisory partition size, which
    decides how large the new files get.
    """
    path = path.rstrip("/")
    publish.recover(spark, path, unfinished, prefix="compact-")
    files = publish.Files(spark, path)
    small = small_files(files, path, target_bytes, len(cols))
    if not small:
        return {}
    run = publish.Run(spark, path, f"compact-{uuid.uuid4().hex}", step)
    names = [f"{path}/{folder}/{n}" for folder, own in small.items() for n in own]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*names)
    rows.hint("rebalance", *cols).write.mode("overwrite").partitionBy(*cols).parquet(run.stage())
    out = {}
    for folder, own in small.items():
        out[folder] = (len(own), len(run.add(folder, run.name)))
        run.drop(f"{folder}/{n}" for n in own)
    run.publish()
    return out
