"""Structured Streaming: lake copy and change-driven partition refresh.

``stream_lake_copy`` is a file source with a supplied schema. Each batch is written beside the lake, rebalanced on
its days by size (a day that holds most of a batch gets several tasks, small days share one), and its
files are then added to the day folders under a journal, together with the batch's number: a batch that
Spark runs again after a stop adds nothing twice. The lake has no file list of its own, so files may be compacted beside it.

``stream_partition_refresh`` runs the batch refresh on the change-log files that each
trigger finds, through ``foreachBatch``. A partition rewrite costs the whole partition
however few rows changed, so a trigger takes all the files there are (or as many as a byte
limit allows) and rewrites each affected partition once; the trigger interval sets how
much is gathered. A rewrite depends only on the source, never on earlier lake state, so
replaying a batch after a failure gives the same lake: no state store and no watermark
are needed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.timeutil import epoch_parts
from ..operators import cdc
from ..operators.keysets import bounded_key_values
from ..sinks import lake, publish
from ..specs import ACTIONS, PARTITION_COLS, TableSpec


def stream_lake_copy(
    spark: SparkSession,
    src_dir: str,
    dst_dir: str,
    checkpoint: str,
    schema: T.StructType,
    partition_cols=PARTITION_COLS,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    step: Callable[[str], None] | None = None,
) -> StreamingQuery:
    """Copy new parquet files of ``src_dir`` into a partitioned lake at ``dst_dir``.

    Several copies may feed one lake, each with a checkpoint of its own.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    name = f"copy-{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:12]}"
    root, state = dst_dir.rstrip("/"), f"_copied/{name}.json"

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        publish.recover(spark, root, prefix=f"{name}-", step=step)
        files = publish.Files(spark, root)
        had = files.exists(f"{root}/{state}")
        if had and json.loads(files.read(f"{root}/{state}"))["batch"] >= epoch_id:
            return  # published before the stop
        run = publish.Run(spark, root, f"{name}-{epoch_id}", step)
        conf = batch.sparkSession.conf
        adaptive = conf.get("spark.sql.adaptive.enabled")
        conf.set("spark.sql.adaptive.enabled", "true")  # off in a stream's session; it sizes the tasks of this write
        try:
            batch.hint("rebalance", *partition_cols).write.mode("overwrite").partitionBy(*partition_cols).parquet(run.stage())
        finally:
            conf.set("spark.sql.adaptive.enabled", adaptive)
        for folder in publish.partition_folders(files, run.stage(), len(partition_cols)):
            run.add(folder, f"{name}-{epoch_id}")
        files.write(f"{run.stage()}/{state}", json.dumps({"batch": epoch_id}))
        run.swaps.append(publish.Swap(f"{root}/{state}", f"{run.folder}/old/{state}", had, f"{run.stage()}/{state}"))
        run.publish()

    writer = reader.parquet(src_dir).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def batch_affected(
    batch: DataFrame, source: DataFrame, spec: TableSpec, zone: str | None = None,
    include_insert_dates: bool = False, lake_df: DataFrame | None = None,
) -> DataFrame:
    """Affected partitions of one micro-batch of change-log rows of the table.

    The batch's own days play the role of the run day; net change is per
    (table, day, key) exactly as in the batch refresh. The keys are sized
    first, as in ``refresh``: up to ``MAX_KEY_LITERALS`` they are collected and looked up
    by value; up to ``MAX_BROADCAST_KEYS`` they are broadcast, so the source (and the lake,
    with ``lake_df``) is streamed through the join instead of being shuffled every batch.
    """
    batch = batch.filter(F.col("table_name") == spec.name)
    net = cdc.net_actions(batch, spec.name, zone=zone)
    actions = cdc.source_lookup_actions(include_insert_dates)
    looked_up = net.filter(F.col("net_action").isin(*actions))
    n_src, n_all = net.agg(F.count_if(F.col("net_action").isin(*actions)), F.count(F.lit(1))).first()
    days = batch.select(*epoch_parts("action_tstamp_tx", zone))
    out = days.unionByName(
        cdc.update_dates(
            net, source, spec.name, spec.key, spec.date_col, actions, zone,
            n_src <= cdc.MAX_BROADCAST_KEYS, bounded_key_values(looked_up, "id", cdc.MAX_KEY_LITERALS, known_at_most=n_src),
        )
    ).unionByName(cdc.delete_dates(batch, spec.name, zone=zone))
    if lake_df is not None:
        out = out.unionByName(
            cdc.lake_partitions_of_keys(
                lake_df, net, spec.name, spec.key, n_all <= cdc.MAX_BROADCAST_KEYS,
                bounded_key_values(net, "id", cdc.MAX_KEY_LITERALS, known_at_most=n_all),
            )
        )
    return out.distinct()


def stream_partition_refresh(
    spark: SparkSession,
    log_dir: str,
    log_schema: T.StructType,
    source: DataFrame,
    spec: TableSpec,
    lake_path: str,
    checkpoint: str,
    max_bytes_per_trigger: str | None = None,
    processing_time: str | None = None,
    zone: str | None = None,
    include_insert_dates: bool = False,
    include_previous_partition: bool = False,
    truncate_marks_all: bool = True,
    rejected_path: str | None = None,
) -> StreamingQuery:
    """Keep ``lake_path`` in step with ``source`` as change-log files arrive.

    Takes all files there are and stops, or with ``processing_time`` runs on and gathers the files
    of each interval. A TRUNCATE of the table affects every lake partition. Rows of the
    table whose action is none of I, U, D and T (or null) are kept, not dropped: each
    batch's are written to ``rejected_path`` (by default beside the checkpoint).
    """
    rejected = rejected_path or f"{checkpoint.rstrip('/')}-rejected"
    reader = spark.readStream.schema(log_schema)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    stream = reader.parquet(log_dir).filter(F.col("table_name") == spec.name)
    known = F.coalesce(F.col("action").isin(*ACTIONS), F.lit(False))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # the batch is read several times (counts, net change, days); lost blocks are re-read from its files
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            session = batch.sparkSession
            n_bad, n_truncates = batch.agg(F.count_if(~known), F.count_if(F.col("action") == "T")).first()
            if n_bad:  # a replayed batch replaces what it wrote before
                batch.filter(~known).write.mode("overwrite").parquet(f"{rejected}/batch={epoch_id}")
            current = lake.read_lake(session, lake_path, schema=source.schema)
            affected = batch_affected(
                batch.filter(known), source, spec, zone, include_insert_dates, current if include_previous_partition else None
            )
            if n_truncates and truncate_marks_all:
                affected = affected.unionByName(cdc.lake_partitions(current)).distinct()
            lake.rewrite_partitions(session, source, affected, lake_path)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
