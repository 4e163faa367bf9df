"""Session helpers: shared scratch space and the configuration the jobs expect."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Session settings every job in this package is written against. AQE re-plans joins
#: and splits skewed shuffle partitions at run time; ``dynamic`` overwrite keeps the
#: partitions that a refresh does not write.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # key sets cut with checkpoint() are removed once the driver no longer references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


#: Bytes per scan split and the advisory size AQE aims for after a shuffle.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def sized_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Partition settings for jobs reading about ``input_bytes`` on ``total_cores`` cores.

    Scans split files into ``TARGET_PARTITION_BYTES`` tasks. Shuffles start with one
    partition per target size of input, clamped to 2-8 per core. At 100 TB on 8,000
    cores that is 64,000, not the 390,000 an uncapped count would give, because the map
    x reduce file count grows with its square. AQE then merges small partitions up to the
    advisory size and splits skewed ones, so a hot key does not decide a task's size.
    """
    n = max(2 * total_cores, min(8 * total_cores, -(-input_bytes // TARGET_PARTITION_BYTES)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
    }


def with_recommended_conf(builder):
    """Apply ``RECOMMENDED_CONF`` to a ``SparkSession.builder`` (some keys only take effect at start)."""
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    return builder


def shared_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors, taken from ``spark.checkpoint.dir``.

    On a cluster that setting must name distributed storage; a cluster session without it
    is refused. Only a bare local session (as in tests) gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # spark.checkpoint.dir cannot be changed on a running session; register the
        # folder with the context instead, which later calls then find
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared root, in the application's own part of it."""
    return f"{_application_root(spark)}/{name}-{uuid.uuid4().hex}"


def _application_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/tidemark/{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete every scratch folder of this application; for the end of a job, when its results are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_application_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable: register the shared root if needed."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
