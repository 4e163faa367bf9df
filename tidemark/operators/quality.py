"""Constraint checks as table jobs.

Each returns one row per check, so a clean table still yields a row with count 0.
Key checks pre-aggregate per key before any join, so a key holding a large share of
the rows is collapsed map-side and never moves as a whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import ACTIONS, FOREIGN_KEYS, SCHEMAS, VARCHAR_LENGTHS

CHECK_COLS = ("check", "table_name", "column_name", "n_violations")


def _rows(agg: DataFrame, checks: list[tuple[str, str, str, str]]) -> DataFrame:
    """One row per (check, table, column, aggregate column) of a single-row aggregate: the table is scanned once."""
    rows = F.array(*[
        F.struct(
            F.lit(check).alias("check"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
            F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("n_violations"),
        )
        for check, table, column, n in checks
    ])
    return agg.select(F.explode(rows).alias("r")).select("r.*")


def _column_checks(df: DataFrame, table: str, not_null, limits: dict[str, int]) -> DataFrame:
    """NULL counts and over-long values of any columns, in one aggregate."""
    aggs, checks = [], []
    for c in not_null:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"null_{c}"))
        checks.append(("not_null", table, c, f"null_{c}"))
    for c, n in limits.items():
        aggs.append(F.count_if(F.length(F.col(c)) > n).alias(f"long_{c}"))
        checks.append((f"length<={n}", table, c, f"long_{c}"))
    return _rows(df.agg(*aggs), checks)


def dq_not_null(df: DataFrame, table: str, cols) -> DataFrame:
    """NULL count per column, all columns in one pass (Q1)."""
    return _column_checks(df, table, cols, {})


def dq_pk_duplicates(df: DataFrame, table: str, key_cols) -> DataFrame:
    """Number of key values that occur more than once."""
    dup = df.groupBy(*key_cols).count().filter(F.col("count") > 1)
    return _rows(dup.agg(F.count(F.lit(1)).alias("n")), [("pk_unique", table, ",".join(key_cols), "n")])


def dq_fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, table: str) -> DataFrame:
    """Child rows whose foreign key has no parent (Q3, J5); NULL keys are not orphans.

    The child side is first reduced to (key, rows) so the anti-join moves one row per
    key value per task, whatever the skew of the foreign key.
    """
    per_key = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    orphans = per_key.join(parent.select(F.col(pk).alias("_k")), "_k", "left_anti")
    return _rows(orphans.agg(F.sum("_n").alias("n")), [("fk_exists", table, fk, "n")])


def dq_fk_orphans_all(frames: dict[str, DataFrame], fks) -> DataFrame:
    """``dq_fk_orphans`` of any foreign keys ``(child, column, parent, key column)`` at once.

    Every child is scanned once: its key columns are stacked as ``(column, key)`` and reduced to row counts before they
    move. Every parent is scanned once per key column it is referred by: a key carries one bit for each
    constraint that it satisfies. The two meet in one join, with one shuffle each, however many constraints there are.
    Keys are compared as bigint if all are integers, else as text.
    """
    fks = list(fks)
    whole = all(frames[t].schema[c].dataType.typeName() in ("byte", "short", "integer", "long") for f in fks for t, c in (f[:2], f[2:]))
    as_key = lambda c: F.col(c).cast("bigint" if whole else "string")
    columns = list(dict.fromkeys((c, fk) for c, fk, _, _ in fks))
    place = lambda rows: rows.where("r._k IS NOT NULL").select("r.*")

    def stacked(df: DataFrame, entries) -> DataFrame:
        return place(df.select(F.explode(F.array(*[F.struct(*e) for e in entries])).alias("r")))

    children = [
        stacked(frames[t], [(F.lit(i).alias("_c"), as_key(fk).alias("_k")) for i, (own, fk) in enumerate(columns) if own == t])
        for t in dict.fromkeys(c for c, _ in columns)
    ]
    parents = [
        stacked(frames[t], [
            (F.lit(columns.index((c, fk))).alias("_c"), as_key(pk).alias("_k"), F.lit(1 << n).cast("bigint").alias("_bit"))
            for n, (c, fk, p, pk) in enumerate(fks) if (p, pk) == (t, key)])
        for t, key in dict.fromkeys((p, pk) for _, _, p, pk in fks)
    ]
    counts = reduce(DataFrame.unionByName, children).groupBy("_c", "_k").agg(F.count(F.lit(1)).alias("_n"))
    known = reduce(DataFrame.unionByName, parents).groupBy("_c", "_k").agg(F.bit_or("_bit").alias("_bits"))
    bits = F.coalesce("_bits", F.lit(0).cast("bigint"))
    sums = [
        F.sum(F.when((F.col("_c") == columns.index((c, fk))) & (bits.bitwiseAND(F.lit(1 << n).cast("bigint")) == 0), F.col("_n"))).alias(f"n{n}")
        for n, (c, fk, _, _) in enumerate(fks)
    ]
    agg = counts.join(known, ["_c", "_k"], "left").agg(*sums)
    return _rows(agg, [("fk_exists", c, fk, f"n{n}") for n, (c, fk, _, _) in enumerate(fks)])


def dq_action_domain(log: DataFrame, table: str = "logged_actions") -> DataFrame:
    """Rows whose action is outside I, D, U, T (Q4); a NULL passes, as in a CHECK constraint."""
    bad = log.agg(F.count_if(F.col("action").isNotNull() & ~F.col("action").isin(*ACTIONS)).alias("n"))
    return _rows(bad, [("action_domain", table, "action", "n")])


def dq_length(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """Values longer than their varchar limit, per column, in one pass (Q5)."""
    return _column_checks(df, table, (), limits)


def declared_checks(frames: dict[str, DataFrame]) -> DataFrame:
    """Every constraint that the specs declare, over the given tables: NOT NULL and lengths
    (one scan per table), the primary key, and each foreign key whose parent is given too."""
    parts = []
    for table, df in frames.items():
        required = [f.name for f in SCHEMAS[table].fields if not f.nullable and f.name in df.columns]
        limits = {c: n for c, n in VARCHAR_LENGTHS.get(table, {}).items() if c in df.columns}
        parts.append(_column_checks(df, table, required, limits))
        parts.append(dq_pk_duplicates(df, table, ["id"]))
    fks = [
        (child, column, parent, "id") for child, column, parent in FOREIGN_KEYS
        if child in frames and parent in frames and column in frames[child].columns
    ]
    if fks:
        parts.append(dq_fk_orphans_all(frames, fks))
    return reduce(DataFrame.unionByName, parts)
