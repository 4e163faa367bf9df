"""Change capture from a stream of full snapshots, with the last state of every key kept by Spark.

Snapshots of a table arrive one after the other as files of rows ``(snapshot, id, ..)`` in folders of their own; a *mark*
(``complete`` true) says that a snapshot has arrived whole. A key that the snapshot before lacks is an insert, one with another
digest an update, and one that a complete snapshot lacks a delete.

Each row counts twice: as the new state of its key in its snapshot, and as the old one in the next. One streaming aggregate by
key and snapshot brings both together, without Python code: a group with an old state only is a delete, one with a new state only an
insert. A group is final when its snapshot's mark has arrived, which the event time tells: the groups of
snapshot n are at ``2 * n`` seconds, so its rows take the time to 2n + 2, those that they are old states for, and its mark to 2n + 3. The
watermark is three seconds behind: rows leave the groups of their snapshot open, and further rows of it are not late;
the mark closes them. So the events of a snapshot, of all kinds, come with its mark.

The state is a digest and a date per key, partitioned by key over the shuffle partitions and kept in Spark's state store
(RocksDB for states larger than memory: ``spark.sql.streaming.stateStore.providerClass``). The checkpoint holds
offsets and state together: a restarted stream emits nothing twice. Checkpoints of the former keyed Python state can't be read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def write_snapshot(rows: DataFrame, folder: str, number: int) -> None:
    """Add snapshot ``number`` (from 1, one after the other) to the stream's folder: its rows, then its mark."""
    numbered = rows.select(F.lit(number).cast("bigint").alias("snapshot"), F.lit(False).alias("complete"), *rows.columns)
    numbered.write.mode("append").parquet(folder)
    mark = rows.sparkSession.createDataFrame([(number, True)], "snapshot bigint, complete boolean")
    mark.coalesce(1).write.mode("append").parquet(folder)


def captured(stream: DataFrame, key: str = "id", date_col: str = "updated_at", columns=None) -> DataFrame:
    """Events of a stream of snapshot rows and marks: ``snapshot, action, row_data, changed_fields``.

    ``columns``: the compared ones (by default all but the key). Keys are unique within a snapshot; rows without one are
    passed over. Should a key repeat, its states in a snapshot follow one another by digest.
    """
    compared = columns or [c for c in stream.columns if c not in (key, "snapshot", "complete")]
    digest = F.xxhash64(*[x for i, c in enumerate(compared) for x in (F.lit(i), F.col(c).isNull(), F.col(c))])
    state = F.struct(digest.alias("digest"), F.col(date_col).cast("bigint").alias("dated"))
    own = F.when(~F.col("complete") & F.col(key).isNotNull(), state)
    entry = lambda seconds, new, old: F.struct(F.timestamp_seconds(seconds).alias("at"), new.alias("new"), old.alias("old"))
    time, none = 2 * F.col("snapshot"), F.when(F.lit(False), state)
    entries = F.when(F.col("complete"), F.array(entry(time + 3, none, none))).otherwise(
        F.array(entry(time, own, none), entry(time + 2, none, own)))
    rows = (
        stream.select(F.when(~F.col("complete"), F.col(key).cast("bigint")).alias("key"), F.explode(entries).alias("e"))
        .select("key", "e.*").withWatermark("at", "3 seconds")
    )
    # marks make groups without a state; a filter for them on the key would be pushed below the watermark, and the time would stand still
    groups = rows.groupBy("key", "at").agg(F.collect_set("new.digest").alias("digests"), F.max("old").alias("old"))
    # repeated keys: one event for each digest, but for the least if it is the old one
    known = F.col("old").isNotNull() & (F.array_min("digests") == F.col("old.digest"))
    actions = (
        F.when(F.size("digests") == 0, F.when(F.col("old").isNotNull(), F.array(F.lit("D"))))
        .when(F.col("old").isNull(), F.concat(F.array(F.lit("I")), F.array_repeat(F.lit("U"), F.size("digests") - 1)))
        .otherwise(F.array_repeat(F.lit("U"), F.size("digests") - known.cast("int")))
    )
    return groups.select(
        F.expr("unix_seconds(at) div 2").alias("snapshot"), F.explode(actions).alias("action"), F.col("key").alias("row_data"),
        F.col("old.dated").alias("dated"),
    ).select("snapshot", "action", "row_data", F.when(F.col("action") == "D", F.col("dated")).alias("changed_fields"))


def stream_capture(
    spark: SparkSession, folder: str, schema: T.StructType, out: str, checkpoint: str, key: str = "id", date_col: str = "updated_at",
    columns=None, max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Take all snapshots there are and append their events to ``out``; a later call goes on from the checkpoint.

    ``schema``: that of the table's rows.
    """
    whole = T.StructType([T.StructField("snapshot", T.LongType()), T.StructField("complete", T.BooleanType()), *schema.fields])
    reader = spark.readStream.schema(whole)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    events = captured(reader.parquet(folder), key, date_col, columns)
    return (
        events.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(out)
    )
