"""Constraint counts kept per day, so that a refresh checks only the days that it rewrote.

A table's summary is a small date-partitioned lake of its own, ``<root>/<table>/year=../month=../day=..``, with rows
``kind, column, key, n``:

- one per declared NOT NULL or length check that fails on that day: how many rows fail;
- one per day and value of the primary key and of each foreign key: how many rows hold it.

Rows of a day depend on that day's rows only, and all counts are sums. So the summary of a rewritten day replaces the old
one, whatever the other days hold, and the checks of the whole tables follow by adding up the days. Uniqueness and references
reach across days and tables: they need the kept keys of all days, but not the tables.

``report`` gives the rows of ``quality.declared_checks``. All keys meet in one aggregate: the ids of a table and every foreign
key that refers to it are grouped by value, so each constraint is decided there without a join.

Edge cases: rows without a date are kept under day (0, 0, 0), which ``refresh`` takes like any other. A null primary key counts as a
value that occurs (as in ``dq_pk_duplicates``); a null foreign key is no orphan. A table without rows has no
summary rows and zero violations. Keys are integers, as in all specs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import FOREIGN_KEYS, PARTITION_COLS, SCHEMAS, VARCHAR_LENGTHS
from . import lake

KEY = "key"
NO_DAY = (0, 0, 0)
_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("column", T.StringType()),
    T.StructField("key", T.LongType()), T.StructField("n", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in PARTITION_COLS],
])


def _column_checks(table: str, columns) -> list[tuple[str, str, int | None]]:
    """(kind, column, most characters) of the declared checks of single rows."""
    required = [("not_null", f.name, None) for f in SCHEMAS[table].fields if not f.nullable and f.name in columns]
    return required + [(f"length<={n}", c, n) for c, n in VARCHAR_LENGTHS.get(table, {}).items() if c in columns]


def _references(tables, columns: dict[str, list[str]]) -> list[tuple[str, str, str]]:
    return [(c, fk, p) for c, fk, p in FOREIGN_KEYS if c in tables and p in tables and fk in columns[c]]


def _named(table: str, columns) -> list[tuple[str, str, int | None]]:
    """(kind, column, most characters) of all entries that rows of a table may have."""
    keys = ["id", *dict.fromkeys(fk for c, fk, _ in FOREIGN_KEYS if c == table and fk in columns)]
    return [(KEY, c, None) for c in keys] + _column_checks(table, columns)


def _counts(df: DataFrame, table: str) -> DataFrame:
    """``what, key, n`` and the day: the summary rows with their kind and column as a number, so that short rows are
    hashed, shuffled and sorted."""
    entries = []
    for what, (kind, c, most) in enumerate(_named(table, df.columns)):
        key = F.col(c) if kind == KEY else F.lit(None)
        entry = F.struct(F.lit(what).alias("what"), key.cast("bigint").alias("key"))
        if kind == KEY:
            entries.append(entry if c == "id" else F.when(F.col(c).isNotNull(), entry))
        else:
            entries.append(F.when(F.col(c).isNull() if most is None else F.length(F.col(c)) > most, entry))
    dated = F.col("year").isNotNull() & F.col("month").isNotNull() & F.col("day").isNotNull()
    days = [F.when(dated, F.col(c)).otherwise(F.lit(0)).cast("bigint").alias(c) for c in PARTITION_COLS]
    return (
        df.select(*days, F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").select("e.*", *PARTITION_COLS)
        .groupBy("what", "key", *PARTITION_COLS).agg(F.count(F.lit(1)).alias("n"))
    )


def _with_names(counts: DataFrame, named) -> DataFrame:
    name = lambda j: reduce(
        lambda rest, e: F.when(F.col("what") == e[0], F.lit(e[1][j])).otherwise(rest), enumerate(named), F.lit(None).cast("string"))
    return counts.withColumns({"kind": name(0), "column": name(1)}).select(*[f.name for f in _SCHEMA.fields])


def summarise(df: DataFrame, table: str) -> DataFrame:
    """The summary rows of a table with date columns: one scan, one aggregate with a partial step.

    Each row is stacked into its keys and the checks that it fails, so clean columns add nothing.
    """
    return _with_names(_counts(df, table), _named(table, df.columns))


class ConstraintStore:
    """The summaries of some tables below one folder; ``columns`` names the columns that each table has."""

    def __init__(self, spark: SparkSession, root: str, columns: dict[str, list[str]]):
        self.spark, self.root, self.columns = spark, root.rstrip("/"), columns

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def build(self, table: str, df: DataFrame) -> None:
        """Summarise the whole table, as a backfill does."""
        counts = _counts(df, table).hint("rebalance", *PARTITION_COLS)
        (
            _with_names(counts, _named(table, df.columns))
            .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*PARTITION_COLS).parquet(self._path(table))
        )

    def refresh(self, table: str, df: DataFrame, days) -> lake.RewriteResult:
        """Replace the summaries of the given days (``(year, month, day)``); only these days of ``df`` are read.

        A day that has no rows any more loses its summary. Run again after a stop, it gives the same result.
        """
        ddl = ", ".join(f"{c} bigint" for c in PARTITION_COLS)
        affected = self.spark.createDataFrame(sorted(set(map(tuple, days))), ddl)
        return lake.rewrite_partitions(self.spark, summarise(df, table), affected, self._path(table))

    def read(self, table: str) -> DataFrame:
        return lake.read_lake(self.spark, self._path(table), schema=_SCHEMA)

    def report(self) -> DataFrame:
        """``check, table_name, column_name, n_violations``, one row per declared constraint, violated or not."""
        tables = list(self.columns)
        fks = _references(tables, self.columns)
        every = reduce(DataFrame.unionByName, [self.read(t).withColumn("table_name", F.lit(t)) for t in tables])

        declared = [(k, t, c) for t in tables for k, c, _ in _column_checks(t, self.columns[t])]
        named = self.spark.createDataFrame(declared, "check string, table_name string, column_name string")
        failed = every.where(F.col("kind") != KEY).groupBy(
            F.col("kind").alias("check"), "table_name", F.col("column").alias("column_name")
        ).agg(F.sum("n").alias("n_violations"))
        single = F.broadcast(named).join(failed, ["check", "table_name", "column_name"], "left").withColumn(
            "n_violations", F.coalesce("n_violations", F.lit(0)).cast("bigint"))

        # the keys of one space: a table's ids, and the foreign keys that refer to it, each in a slot of its own
        slots: dict[str, list[int]] = {t: [] for t in tables}
        for i, (_, _, p) in enumerate(fks):
            slots[p].append(i)
        places = {(c, fk): (tables.index(p), 1 + slots[p].index(i)) for i, (c, fk, p) in enumerate(fks)}

        def placed(t: str) -> DataFrame:
            own = {"id": (tables.index(t), 0)} | {fk: at for (c, fk), at in places.items() if c == t}
            part = lambda j: reduce(
                lambda rest, e: F.when(F.col("column") == e[0], F.lit(e[1][j])).otherwise(rest), own.items(), F.lit(None).cast("int"))
            rows = self.read(t).where((F.col("kind") == KEY) & F.col("column").isin(list(own)))
            return rows.select(part(0).alias("space"), part(1).alias("slot"), "key", "n")

        width = 1 + max((len(x) for x in slots.values()), default=0)
        keys = reduce(DataFrame.unionByName, [placed(t) for t in tables]).groupBy("space", "key").agg(
            *[F.sum(F.when(F.col("slot") == j, F.col("n"))).alias(f"n{j}") for j in range(width)])
        sums = keys.agg(
            *[F.count_if((F.col("space") == i) & (F.col("n0") > 1)).alias(f"pk{i}") for i in range(len(tables))],
            *[F.sum(F.when((F.col("space") == tables.index(p)) & F.col("n0").isNull(), F.col(f"n{places[c, fk][1]}"))).alias(f"fk{i}")
              for i, (c, fk, p) in enumerate(fks)],
        )
        across = [("pk_unique", t, "id", f"pk{i}") for i, t in enumerate(tables)]
        across += [("fk_exists", c, fk, f"fk{i}") for i, (c, fk, _) in enumerate(fks)]
        rows = F.array(*[
            F.struct(F.lit(k).alias("check"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"),
                     F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("n_violations"))
            for k, t, c, n in across
        ])
        return single.unionByName(sums.select(F.explode(rows).alias("r")).select("r.*"))
