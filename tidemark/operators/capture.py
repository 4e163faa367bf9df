"""Change capture between snapshots, and change application.

The source's row trigger becomes a comparison of two snapshots: a full outer join on
the key (both sides shuffled on the key, each carrying only the compared columns),
classifying keys as I (new only), D (old only) or U (some compared column differs,
null-safe). Keys are unique per snapshot, so the join cannot fan out or skew.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeutil import date_parts, epoch_to_date, now_epoch, ntz_literal
from .keysets import MAX_BROADCAST_KEYS, bounded_broadcast, near_keys

DIFF_COLS = (
    "event_id",
    "table_name",
    "action",
    "action_tstamp_tx",
    "row_data",
    "changed_fields",
    "statement_only",
)


def _joined(old: DataFrame, new: DataFrame, key: str, compare, date_col: str) -> tuple[DataFrame, Column]:
    o_cols = sorted(set(compare) | {date_col})
    o = old.select(F.col(key), *[F.col(c).alias(f"_o_{c}") for c in o_cols], F.lit(True).alias("_in_old"))
    n = new.select(F.col(key), *[F.col(c).alias(f"_n_{c}") for c in compare], F.lit(True).alias("_in_new"))
    j = o.join(n, key, "full_outer")
    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}")) for c in compare],
        F.lit(False),
    )
    action = (
        F.when(F.col("_in_old").isNull(), "I")
        .when(F.col("_in_new").isNull(), "D")
        .when(differs, "U")
    )
    return j, action


def compared_columns(old: DataFrame, new: DataFrame, key: str, ignore_cols=()) -> list[str]:
    ignore = set(ignore_cols)
    return [c for c in new.columns if c != key and c in old.columns and c not in ignore]


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    table: str,
    key: str = "id",
    ignore_cols=(),
    now=None,
    date_col: str = "updated_at",
    session_columns: bool = False,
) -> DataFrame:
    """Row events that turn ``old`` into ``new`` (C8), in the change-log layout.

    ``row_data`` is the key; ``changed_fields`` is OLD.updated_at for deletes, NULL
    otherwise. Updates that change only ``ignore_cols`` emit nothing (C9, documented
    meaning). ``event_id`` is a hash of (table, key, action, time) so a rerun gives the
    same ids (X16); ``action_tstamp_tx`` is the injected ``now``.
    """
    compare = compared_columns(old, new, key, ignore_cols)
    j, action = _joined(old, new, key, compare, date_col)
    ts = now_epoch(now)
    ev = j.select(
        F.lit(table).alias("table_name"),
        action.alias("action"),
        ts.alias("action_tstamp_tx"),
        F.col(key).cast("bigint").alias("row_data"),
        F.when(action == "D", F.col(f"_o_{date_col}")).cast("bigint").alias("changed_fields"),
        F.lit(False).alias("statement_only"),
    ).filter(F.col("action").isNotNull())
    out = ev.withColumn(
        "event_id", F.xxhash64("table_name", "row_data", "action", "action_tstamp_tx")
    ).select(*DIFF_COLS)
    if session_columns:
        facts = SessionFacts.of(old.sparkSession)
        out = out.withColumns({"session_user_name": facts.user_column(), "application_name": F.lit(facts.application).cast("string")})
    return out


@dataclass(frozen=True)
class SessionFacts:
    """Who and what produced a batch of events, as the change log keeps it.

    The statement's and the wall clock's time, the transaction, the application, the client's address and port, the user and the query's
    text. All are given, so that a rerun of a batch writes the same rows; ``of`` takes them from the session.
    """

    statement_time: _dt.datetime | None = None
    clock_time: _dt.datetime | None = None
    transaction_id: int | None = None
    application: str | None = None
    client_addr: str | None = None
    client_port: int | None = None
    user: str | None = None
    query: str | None = None

    @classmethod
    def of(cls, spark, transaction_id: int | None = None, now: _dt.datetime | None = None, query: str | None = None) -> SessionFacts:
        """Facts of a Spark session: its application name, the driver's host and port; one clock for both times."""
        get = lambda k: spark.conf.get(k, None)
        port = get("spark.driver.port")
        return cls(now, now, transaction_id, get("spark.app.name"), get("spark.driver.host"), int(port) if port else None, None, query)

    def user_column(self) -> Column:
        return F.current_user() if self.user is None else F.lit(self.user)


def with_session_facts(events: DataFrame, facts: SessionFacts, schema_name: str = "public", spec=None) -> DataFrame:
    """Events in the whole layout of the change log: their own columns and those of the session.

    Times without a value are the batch's current time. The query's text is left out where the spec says so (F10).
    """
    time = lambda t: F.current_timestamp().cast("timestamp_ntz") if t is None else ntz_literal(t)
    text = facts.query if spec is None or spec.audit_query_text is not False else None
    return events.select(
        "event_id", F.lit(schema_name).alias("schema_name"), "table_name", facts.user_column().alias("session_user_name"), "action_tstamp_tx",
        time(facts.statement_time).alias("action_tstamp_stm"), time(facts.clock_time).alias("action_tstamp_clk"),
        F.lit(facts.transaction_id).cast("bigint").alias("transaction_id"), F.lit(facts.application).cast("string").alias("application_name"),
        F.lit(facts.client_addr).cast("string").alias("client_addr"), F.lit(facts.client_port).cast("int").alias("client_port"),
        F.lit(text).cast("string").alias("client_query"), "action", "row_data", "changed_fields", "statement_only",
    )


def statement_events(
    old: DataFrame,
    new: DataFrame,
    table: str,
    key: str = "id",
    ignore_cols=(),
    date_col: str = "updated_at",
) -> DataFrame:
    """Statement-level summary of one batch (C10): ``table_name, action, row_data, statement_only, n_rows``.

    One row per row action that occurred, with ``row_data`` NULL; when the new snapshot
    is empty and the old one is not, a single ``T`` (truncate) instead. Counts come from
    one global aggregate over the same join as ``snapshot_diff`` (partial per task).
    """
    compare = compared_columns(old, new, key, ignore_cols)
    j, action = _joined(old, new, key, compare, date_col)
    counts = j.select(action.alias("a"), F.col("_in_old"), F.col("_in_new")).agg(
        F.count_if(F.col("a") == "I").alias("n_i"),
        F.count_if(F.col("a") == "U").alias("n_u"),
        F.count_if(F.col("a") == "D").alias("n_d"),
        F.count_if(F.col("_in_old")).alias("n_old"),
        F.count_if(F.col("_in_new")).alias("n_new"),
    )
    truncated = (F.col("n_new") == 0) & (F.col("n_old") > 0)
    rows = F.array(
        F.struct(F.lit("T").alias("action"), F.col("n_old").alias("n_rows"), truncated.alias("keep")),
        *[
            F.struct(F.lit(a).alias("action"), F.col(c).alias("n_rows"), (~truncated & (F.col(c) > 0)).alias("keep"))
            for a, c in (("I", "n_i"), ("U", "n_u"), ("D", "n_d"))
        ],
    )
    return (
        counts.select(F.explode(rows).alias("r"))
        .filter(F.col("r.keep"))
        .select(
            F.lit(table).alias("table_name"),
            F.col("r.action").alias("action"),
            F.lit(None).cast("bigint").alias("row_data"),
            F.lit(True).alias("statement_only"),
            F.col("r.n_rows").alias("n_rows"),
        )
    )


def audit_events(old: DataFrame, new: DataFrame, spec, now=None) -> DataFrame:
    """What auditing one table records, by its spec (C10, C13): row events without those that change
    ignored columns only, or, with ``audit_rows`` off, one statement row per operation."""
    if spec.audit_rows:
        return snapshot_diff(old, new, spec.name, spec.key, spec.ignored_cols, now, spec.date_col)
    return statement_events(old, new, spec.name, spec.key, spec.ignored_cols, spec.date_col)


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    new: DataFrame,
    key: str = "id",
    max_broadcast_keys: int | None = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """Replica after applying row events.

    Keys with U or D leave ``base``; keys with I or U come from ``new``. Each changed key
    is classified once: one aggregate ORs a two-bit code per key (1 = leaves base,
    2 = comes from new), partially per task, so a key with many events is combined
    before the shuffle. That keyed set is cut and counted once (``bounded_broadcast``):
    up to ``max_broadcast_keys`` it is broadcast and neither ``base`` nor ``new`` is
    shuffled; above it both joins shuffle on the key. ``max_broadcast_keys=None``
    leaves the choice to the planner and keeps the result fully lazy.
    """
    code = F.when(F.col("action") == "U", 3).when(F.col("action") == "D", 1).when(F.col("action") == "I", 2)
    keys = (
        changes.filter(F.col("row_data").isNotNull())
        .groupBy(F.col("row_data").alias(key))
        .agg(F.bit_or(code).alias("_code"))
    )
    keys, n = bounded_broadcast(keys, max_broadcast_keys)
    if max_broadcast_keys is not None and n > max_broadcast_keys:
        new = near_keys(new, keys, key)  # the base keeps its other rows, so only this side can be cut
    kept = base.join(keys.filter((F.col("_code").bitwiseAND(1)) == 1).select(key), key, "left_anti")
    added = new.join(keys.filter((F.col("_code").bitwiseAND(2)) == 2).select(key), key, "left_semi")
    return kept.unionByName(added.select(*base.columns))


def touch_rows(
    df: DataFrame,
    keys: DataFrame,
    now: _dt.datetime | None = None,
    key: str = "id",
    date_col: str = "updated_at",
    max_broadcast_keys: int | None = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """Set ``updated_at`` and the date parts to ``now`` for the rows whose key is in ``keys``.

    Month and day are the real month and day of ``now`` (B4 fixed). The distinct keys
    are cut and counted once: when at most ``max_broadcast_keys``, they are broadcast
    and ``df`` is streamed through the join without a shuffle.
    """
    ts = now_epoch(now)
    flagged, _ = bounded_broadcast(keys.select(F.col(key)).distinct(), max_broadcast_keys)
    flagged = flagged.withColumn("_touch", F.lit(True))
    j = df.join(flagged, key, "left")
    parts = date_parts(epoch_to_date(ts))
    touched = F.col("_touch").isNotNull()
    out = j.withColumns(
        {
            date_col: F.when(touched, ts).otherwise(F.col(date_col)),
            "year": F.when(touched, parts[0]).otherwise(F.col("year")),
            "month": F.when(touched, parts[1]).otherwise(F.col("month")),
            "day": F.when(touched, parts[2]).otherwise(F.col("day")),
        }
    )
    return out.select(*df.columns)


def redact_query_text(log: DataFrame, specs) -> DataFrame:
    """Blank ``client_query`` for tables whose ``audit_query_text`` is exactly false.

    A NULL flag keeps the text (``NOT flag IS DISTINCT FROM false`` is false for NULL).
    The per-table flags become one map literal, so no join is needed.
    """
    pairs = []
    for s in specs:
        pairs += [F.lit(s.name), F.lit(s.audit_query_text).cast("boolean")]
    flag = F.element_at(F.create_map(*pairs), F.col("table_name")) if pairs else F.lit(None).cast("boolean")
    return log.withColumn(
        "client_query", F.when(flag.eqNullSafe(F.lit(False)), F.lit(None).cast("string")).otherwise(F.col("client_query"))
    )


def first_letter(op) -> Column:
    """Action letter of an operation name (X7): INSERT -> I, UPDATE -> U, DELETE -> D, TRUNCATE -> T."""
    return F.substring(F.upper(F.col(op) if isinstance(op, str) else op), 1, 1)
