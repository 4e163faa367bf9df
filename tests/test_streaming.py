"""Structured Streaming: availableNow copy, restart adds nothing, change-driven refresh."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import ep, log_df, src_df
from test_cdc import D10, D12, RUN, scenario_log, scenario_source_after
from test_lake import _before, _contents
from tidemark.sinks import lake
from tidemark.specs import CHANGELOG_SCHEMA, TableSpec
from tidemark.specs import PARTITION_COLS as PARTS
from tidemark.streaming.lake_stream import stream_lake_copy, stream_partition_refresh


def test_copy_then_restart_adds_nothing(spark, tmpdir_fresh):
    src, dst, ck = f"{tmpdir_fresh}/src", f"{tmpdir_fresh}/dst", f"{tmpdir_fresh}/ck"
    lake.backfill(_before(spark), src)
    schema = lake.read_lake(spark, src).schema
    stream_lake_copy(spark, src, dst, ck, schema).awaitTermination()
    n1 = lake.read_lake(spark, dst).count()
    stream_lake_copy(spark, src, dst, ck, schema).awaitTermination()
    assert n1 == 4 and lake.read_lake(spark, dst).count() == 4


def test_stream_refresh_matches_batch(spark, tmpdir_fresh):
    log_dir, path, ck = f"{tmpdir_fresh}/log", f"{tmpdir_fresh}/lake", f"{tmpdir_fresh}/ck"
    scenario_log(spark).coalesce(1).write.parquet(log_dir)
    lake.backfill(_before(spark), path)
    q = stream_partition_refresh(spark, log_dir, CHANGELOG_SCHEMA, scenario_source_after(spark), TableSpec("order"), path, ck)
    q.awaitTermination()
    got = _contents(spark, path)
    # the stream also covers the 14th (one late U on id 2): its partition is rewritten from the source
    assert got[D10] == {(1, 11.0), (2, 2.0)} and got[D12] == {(4, 4.0)} and got[RUN] == {(5, 5.0), (6, 6.0)}
    assert dt.date(2024, 1, 11) not in got


def test_stream_refresh_replay_is_idempotent(spark, tmpdir_fresh):
    """A rerun with a fresh checkpoint (as after losing it) leaves the same lake."""
    log_dir, path = f"{tmpdir_fresh}/log", f"{tmpdir_fresh}/lake"
    scenario_log(spark).coalesce(1).write.parquet(log_dir)
    lake.backfill(_before(spark), path)
    for ck in ("ck1", "ck2"):
        stream_partition_refresh(
            spark, log_dir, CHANGELOG_SCHEMA, scenario_source_after(spark), TableSpec("order"), path, f"{tmpdir_fresh}/{ck}"
        ).awaitTermination()
    assert _contents(spark, path)[RUN] == {(5, 5.0), (6, 6.0)}


def _day_files(path):
    import os

    return {
        os.path.join(top, f): os.stat(os.path.join(top, f)).st_mtime_ns
        for top, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def test_refresh_writes_each_partition_once_per_trigger(spark, tmpdir_fresh):
    """Many small log files: the affected days are gathered and each is rewritten once, not once a file."""
    log_dir, path = f"{tmpdir_fresh}/log", f"{tmpdir_fresh}/lake"
    scenario_log(spark).repartition(10).write.option("maxRecordsPerFile", 1).parquet(log_dir)
    lake.backfill(_before(spark), path)
    writes = []
    real = lake.rewrite_partitions

    def counting(session, source, affected, target, **kw):
        res = real(session, source, affected, target, **kw)
        writes.extend(res.written)
        return res

    lake.rewrite_partitions = counting
    try:
        stream_partition_refresh(
            spark, log_dir, CHANGELOG_SCHEMA, scenario_source_after(spark), TableSpec("order"), path, f"{tmpdir_fresh}/ck"
        ).awaitTermination()
    finally:
        lake.rewrite_partitions = real
    assert writes and len(writes) < 2 * len(set(writes))
    assert _contents(spark, path)[RUN] == {(5, 5.0), (6, 6.0)}


def test_stream_truncate_other_tables_and_unknown_actions(spark, tmpdir_fresh):
    log_dir, path, ck = f"{tmpdir_fresh}/log", f"{tmpdir_fresh}/lake", f"{tmpdir_fresh}/ck"
    rows = [
        (1, "order", "T", ep(RUN, 60), None, None), (2, "order", "X", ep(RUN, 61), 1, None),
        (3, "product", "D", ep(RUN, 62), 1, ep(D12)),
    ]
    log = log_df(spark, rows).unionByName(log_df(spark, [(4, "order", "U", ep(RUN, 63), 1, None)]).withColumn("action", F.lit(None).cast("string")))
    log.coalesce(1).write.parquet(log_dir)
    lake.backfill(_before(spark), path)
    kept = src_df(spark, [(4, 4, D12)])
    stream_partition_refresh(spark, log_dir, CHANGELOG_SCHEMA, kept, TableSpec("order"), path, ck).awaitTermination()
    assert _contents(spark, path) == {D12: {(4, 4.0)}}
    assert sorted(r.event_id for r in spark.read.parquet(f"{ck}-rejected").collect()) == [2, 4]


def test_batch_affected_ignores_other_tables(spark):
    from tidemark.streaming.lake_stream import batch_affected

    log = log_df(spark, [(1, "product", "U", ep(dt.date(2024, 1, 3)), 1, None), (2, "order", "I", ep(RUN), 5, None)])
    assert [tuple(r) for r in batch_affected(log, _before(spark), TableSpec("order")).collect()] == [(2024, 1, 15)]


def _names(path):
    return sorted(f[len(path):] for f in _day_files(path) if "/_" not in f[len(path):])


def test_a_hot_day_is_split_by_size(spark, tmpdir_fresh):
    src, dst, day = f"{tmpdir_fresh}/src", f"{tmpdir_fresh}/dst", D10
    rows = src_df(spark, [(1, 1, D12)]).unionByName(
        spark.range(200_000).selectExpr("id", "rand(7) AS amount", "id AS updated_at").withColumns(
            {"year": F.lit(day.year).cast("bigint"), "month": F.lit(day.month).cast("bigint"), "day": F.lit(day.day).cast("bigint")}))
    rows.repartition(8).write.parquet(src)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        stream_lake_copy(spark, src, dst, f"{tmpdir_fresh}/ck", rows.schema).awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    names = _names(dst)
    assert sum("day=10" in n for n in names) > 4 and sum("day=12" in n for n in names) == 1
    assert lake.read_lake(spark, dst).count() == 200_001


def test_copy_stopped_at_any_step_adds_each_row_once(spark, tmpdir_fresh):
    src = f"{tmpdir_fresh}/src"
    lake.backfill(_before(spark), src)
    schema = lake.read_lake(spark, src).schema
    n = 1
    while True:
        seen, dst = [], f"{tmpdir_fresh}/dst-{n}"

        def step(name):
            seen.append(name)
            if len(seen) == n:
                raise RuntimeError("stopped here")

        q = stream_lake_copy(spark, src, dst, f"{tmpdir_fresh}/ck-{n}", schema, step=step)
        try:
            q.awaitTermination()
            whole = True
        except Exception as e:  # noqa: BLE001
            assert "stopped here" in str(e)
            whole = False
        stream_lake_copy(spark, src, dst, f"{tmpdir_fresh}/ck-{n}", schema).awaitTermination()
        assert _contents(spark, dst) == _contents(spark, src) and lake.read_lake(spark, dst).count() == 4
        if whole:
            break
        n += 1
    assert n >= 7


def test_compaction_packs_days_and_keeps_every_row(spark, tmpdir_fresh):
    from tidemark.operators import drift
    from tidemark.sinks import publish
    from tidemark.sinks.compact import compact_lake

    src, dst, ck = f"{tmpdir_fresh}/src", f"{tmpdir_fresh}/dst", f"{tmpdir_fresh}/ck"
    for i in range(6):
        src_df(spark, [(10 * i + j, i, D10 if j % 2 else D12) for j in range(6)]).coalesce(1).write.mode("append").parquet(src)
    schema = _before(spark).schema
    stream_lake_copy(spark, src, dst, ck, schema, max_files_per_trigger=1).awaitTermination()
    digests = lambda df: sorted(drift.digests(df, PARTS, schema.names).collect())
    before = digests(lake.read_lake(spark, dst, schema=schema))
    assert len(_names(dst)) == 12
    late = []

    def copy_meanwhile(name):
        """A batch of the copy comes in after the files to pack are chosen."""
        if name == "journal" and not late:
            late.append(src_df(spark, [(900, 9, D10)]))
            late[0].coalesce(1).write.mode("append").parquet(src)
            stream_lake_copy(spark, src, dst, ck, schema).awaitTermination()

    assert compact_lake(spark, dst, schema, step=copy_meanwhile) == {
        "year=2024/month=1/day=10": (6, 1), "year=2024/month=1/day=12": (6, 1)}
    assert len(_names(dst)) == 3 and publish.pending(spark, dst) == []
    rows = lake.read_lake(spark, dst, schema=schema)
    assert digests(rows.where("id <> 900")) == before and rows.where("id = 900").count() == 1

    class Stop(Exception):
        pass

    def stop(name):
        if name.startswith("set aside"):
            raise Stop

    for mode, n_files in (("undo", 3), ("resume", 2)):
        try:
            compact_lake(spark, dst, schema, step=stop)
        except Stop:
            publish.recover(spark, dst, mode, prefix="compact-")
        assert len(_names(dst)) == n_files and lake.read_lake(spark, dst, schema=schema).count() == 37
    assert compact_lake(spark, dst, schema) == {}
