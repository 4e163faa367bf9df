"""Incremental extraction with a watermark that outlives the run.

The watermark is the greatest ``(column, key)`` taken so far. Rows may have equal timestamps, and rows may become visible late, with
a timestamp below the watermark: a run looks back over an ``overlap`` (0: the watermark's own timestamp) and takes what it has
not taken before. For that, the ``(key, column)`` pairs taken within the overlap are kept with the watermark and anti-joined.
Each version of a row, its key and timestamp, is taken once; a version that becomes visible more than the overlap late is not
seen (the overlap must exceed the longest transaction).

A run has two steps. ``extract`` cuts the slice to the shared checkpoint folder, so what is written and what is remembered are the same
rows, however the source goes on. ``commit``, once the slice is written, stores the kept pairs and then renames a small file that
names them: a run that stops before leaves the old watermark, and the next one takes the same rows again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sinks.publish import Files


@dataclass(frozen=True)
class Slice:
    """Rows to write, and the watermark they lead to (None: nothing new)."""

    rows: DataFrame
    upper: tuple[int, int] | None


class Watermark:
    """The watermark stored below ``path`` for one table's ``col`` and ``key``."""

    def __init__(self, spark: SparkSession, path: str, col: str = "updated_at", key: str = "id", overlap: int = 0):
        self.spark, self.path, self.col, self.key, self.overlap = spark, path.rstrip("/"), col, key, overlap
        self.files = Files(spark, self.path)

    def current(self) -> dict | None:
        """``value``, ``key`` and the folder of kept pairs, or None before the first commit."""
        name = f"{self.path}/watermark.json"
        return json.loads(self.files.read(name)) if self.files.exists(name) else None

    def _kept(self, state: dict) -> DataFrame:
        ddl = f"`{self.key}` bigint, `{self.col}` bigint"
        return self.spark.read.schema(ddl).parquet(f"{self.path}/{state['kept']}")

    def extract(self, source: DataFrame) -> Slice:
        """Rows of the source not taken yet; rows with a null column or key are never taken."""
        c, k, state = F.col(self.col), F.col(self.key), self.current()
        rows = source.where(c.isNotNull() & k.isNotNull())
        if state:
            # a plain lower bound, which reaches the scan; the pairs taken since then are within it
            rows = rows.where(c >= state["value"] - self.overlap).join(self._kept(state), [self.key, self.col], "left_anti")
        ensure_checkpoint_dir(self.spark)
        rows = rows.select(*source.columns).checkpoint()
        top = rows.groupBy(c.alias("value")).agg(F.max(k).alias("key")).orderBy(F.desc("value")).limit(1).collect()
        if not top:
            return Slice(rows, None)
        upper = (top[0]["value"], top[0]["key"])
        return Slice(rows, max(upper, (state["value"], state["key"])) if state else upper)

    def commit(self, taken: Slice) -> None:
        """Move the watermark past a slice that is written for good."""
        if taken.upper is None:
            return
        state, kept = self.current(), f"kept-{uuid.uuid4().hex}"
        since = F.col(self.col) >= taken.upper[0] - self.overlap
        pairs = taken.rows.where(since).select(F.col(self.key).cast("bigint").alias(self.key), F.col(self.col).cast("bigint").alias(self.col))
        if state:
            pairs = pairs.unionByName(self._kept(state).where(since))
        pairs.distinct().write.parquet(f"{self.path}/{kept}")
        self.files.write(f"{self.path}/watermark.json", json.dumps({"value": taken.upper[0], "key": taken.upper[1], "kept": kept}))
        for name in self.files.folders(self.path):  # of earlier runs, stopped ones among them
            if name.startswith("kept-") and name != kept:
                self.files.remove(f"{self.path}/{name}")
