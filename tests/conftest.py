import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests bring their own shared folder only where the session names none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_fresh(spark):
    """A fresh folder under the session's shared folder (local in tests, so os calls work)."""
    from tidemark.session import scratch_path

    p = scratch_path(spark, "test")
    local = p[len("file:"):] if p.startswith("file:") else p
    os.makedirs(local, exist_ok=True)
    return local
