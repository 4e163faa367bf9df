"""Parquet lake scans: named files, globs, schema reuse.

Partition columns are kept by naming the lake root as ``basePath`` (B19) and are
typed bigint by supplying the schema (B18), so no scan relies on inference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_parquet_files(spark: SparkSession, files, base_path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read named part files and keep the partition columns of their folders."""
    r = spark.read.option("basePath", base_path)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(*files)


def scan_parquet_glob(spark: SparkSession, pattern: str, base_path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read every folder matching a Hadoop glob.

    Note ``year=2022?`` needs one more character after 2022 (B20); prefer a partition
    filter on a plain lake read, which prunes folders just as well.
    """
    r = spark.read.option("basePath", base_path)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(pattern)


def schema_from_sample(spark: SparkSession, sample_file: str, base_path: str, partition_types=None) -> T.StructType:
    """Schema of one sample file, partition columns included and retyped.

    Reading one file's footer is a metadata job; the schema is then reused by batch and
    streaming readers instead of inferring it again.
    """
    sch = spark.read.option("basePath", base_path).parquet(sample_file).schema
    partition_types = partition_types or {}
    return T.StructType(
        [T.StructField(f.name, partition_types.get(f.name, f.dataType), f.nullable) for f in sch.fields]
    )


def schema_apply(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """Re-create a frame under a given schema straight from storage.

    Replaces ``createDataFrame(collected_rows, schema)``: the rows never pass through
    the driver.
    """
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def first_file(spark: SparkSession, root: str, suffix: str = ".parquet") -> str:
    """Some data file below ``root``: the listing stops at the first one found."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    it = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    while it.hasNext():
        path = it.next().getPath()
        if path.getName().endswith(suffix) and not path.getName().startswith((".", "_")):
            return path.toString()
    raise FileNotFoundError(f"no {suffix} file below {root}")


def folder_files(spark: SparkSession, folder: str, suffix: str = ".parquet") -> list[str]:
    """Every data file of one folder, not of those below it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    paths = [f.getPath() for f in found if f.isFile()]
    return [x.toString() for x in paths if x.getName().endswith(suffix) and not x.getName().startswith((".", "_"))]
