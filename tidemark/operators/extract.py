"""Browsing the change log and incremental extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import ACTIONS


def audit_history(log: DataFrame, table: str) -> DataFrame:
    """Every change-log row of one table."""
    return log.filter(F.col("table_name") == table)


def audited_tables(log: DataFrame) -> DataFrame:
    """Tables that have audit rows, ordered by schema then table."""
    return (
        log.filter(F.col("action").isin(*ACTIONS))
        .select(F.col("schema_name").alias("schema"), F.col("table_name").alias("audited_table"))
        .distinct()
        .orderBy("schema", "audited_table")
    )


def preview_topn(df: DataFrame, order_cols, n: int = 20) -> DataFrame:
    """First ``n`` rows by ``order_cols`` (O1, K9); add a unique column to make ties deterministic.

    Spark plans this as a per-partition top-n followed by one merge of ``n`` rows per task.
    """
    return df.orderBy(*order_cols).limit(n)


def high_watermark(df: DataFrame, col: str, by=None, alias: str = "high_watermark") -> DataFrame:
    """``max(col)``, globally or per group (A2)."""
    agg = F.max(col).alias(alias)
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def row_as_json(df: DataFrame, cols=None, name: str = "json") -> DataFrame:
    """Each row as JSON text."""
    cols = cols or df.columns
    return df.select(*[c for c in df.columns if c not in cols], F.to_json(F.struct(*cols)).alias(name))


def json_field(col: str, field: str):
    """A top-level field of a JSON text column, as text."""
    return F.get_json_object(F.col(col), f"$.{field}")


def incremental_extract(df: DataFrame, watermark: int | None, col: str = "updated_at") -> DataFrame:
    """Rows with ``col`` strictly above the watermark (C7, F7); rows with NULL ``col`` drop out.

    The watermark is one scalar, so the predicate is a literal that reaches the scan.
    """
    if watermark is None:
        return df.filter(F.col(col).isNotNull())
    return df.filter(F.col(col) > F.lit(watermark))


def scalar_watermark(df: DataFrame, col: str) -> int | None:
    """Collect the single value ``max(col)`` (one row by construction)."""
    return df.agg(F.max(col)).first()[0]
