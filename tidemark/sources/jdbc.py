"""Source table reads (S1, S2, S4, S11) and normalisation to the logical schemas.

JDBC connection settings come from environment variables whose *names* the caller
chooses; no credential is ever written in code. A partitioned read splits the key
range over ``num_partitions`` concurrent queries instead of one full-table cursor.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: The names of the variables that hold the connection settings by default.
URL_ENV, USER_ENV, PASSWORD_ENV = "DB_URL", "DB_USER", "DB_PW"


def _setting(name: str) -> str:
    value = os.environ.get(name)
    if not value:
        raise ValueError(f"environment variable {name} is not set")
    return value


def jdbc_options(
    table: str,
    url_env: str = URL_ENV,
    user_env: str = USER_ENV,
    password_env: str = PASSWORD_ENV,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
) -> dict[str, str]:
    """Reader options for one table; bounds only shape the split, they filter nothing."""
    opts = {
        "url": _setting(url_env),
        "dbtable": table,
        "user": _setting(user_env),
        "password": _setting(password_env),
        "fetchsize": str(fetch_size),
    }
    if driver:
        opts["driver"] = driver
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def normalize(df: DataFrame, schema: T.StructType | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    """Rename source columns and cast those the logical schema knows (int keys -> bigint)."""
    if rename:
        df = df.select(*[F.col(c).alias(rename.get(c, c)) for c in df.columns])
    if schema is None:
        return df
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def read_source(
    spark: SparkSession,
    table: str,
    fmt: str = "jdbc",
    path: str | None = None,
    schema: T.StructType | None = None,
    rename: dict[str, str] | None = None,
    **jdbc_kw,
) -> DataFrame:
    """One source table as a DataFrame (S1, S4): ``jdbc`` or ``parquet``."""
    if fmt == "jdbc":
        df = spark.read.format("jdbc").options(**jdbc_options(table, **jdbc_kw)).load()
    elif fmt == "parquet":
        df = spark.read.parquet(path or table)
    else:
        raise ValueError(f"unsupported source format {fmt!r}")
    return normalize(df, schema, rename)


def read_changelog_source(spark: SparkSession, table: str = "audit.logged_actions", lo=None, hi=None, **kw) -> DataFrame:
    """The change log with only the columns the refresh reads; the window filter is pushed to the source."""
    df = read_source(spark, table, **kw).select(
        "event_id", "table_name", "action", "action_tstamp_tx", "row_data", "changed_fields"
    )
    if lo is not None:
        df = df.filter(F.col("action_tstamp_tx") >= lo)
    if hi is not None:
        df = df.filter(F.col("action_tstamp_tx") <= hi)
    return df
