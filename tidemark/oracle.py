"""DuckDB SQL text for the canonical inputs, used by ``__spark_entry__.oracle_sql``.

These are the same definitions as ``sources.canonical`` written as SQL common table
expressions, so each oracle query states its inputs from the raw driver tables.
"""

from __future__ import annotations

import datetime as _dt

from .functions.timeutil import day_window
from .sources.canonical import BASE_EPOCH, N_CREATED, N_DATES
from .specs import TABLE_NAMES


def epoch_date(e: str) -> str:
    return f"(DATE '1970-01-01' + CAST(({e}) // 86400 AS INTEGER))"


def parts(e: str, prefix: str = "") -> str:
    d = epoch_date(e)
    return (
        f"CAST(year({d}) AS BIGINT) AS {prefix}year, CAST(month({d}) AS BIGINT) AS {prefix}month, "
        f"CAST(day({d}) AS BIGINT) AS {prefix}day"
    )


def table_case(k: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TABLE_NAMES))
    return f"CASE {k} {whens} END"


def changelog_cte(n_dates: int = N_DATES, name: str = "changelog") -> str:
    k = f"(event_id % {len(TABLE_NAMES)})"
    off = f"((user_id + {k}) % {n_dates})"
    upd = f"{BASE_EPOCH} + 86400 * {off}"
    return f"""{name} AS (
  SELECT event_id, 'public' AS schema_name, {table_case(k)} AS table_name,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS action,
         epoch_us(ts) // 1000000 AS action_tstamp_tx,
         user_id AS row_data,
         CASE WHEN event_type = 'error' THEN CAST({upd} AS BIGINT) END AS changed_fields,
         props AS client_query, false AS statement_only
  FROM events)"""


def snapshot_cte(table: str = "order", n_dates: int = N_DATES, name: str = "snapshot") -> str:
    k = TABLE_NAMES.index(table)
    off = f"((o_orderkey + {k}) % {n_dates})"
    upd = f"CAST({BASE_EPOCH} + 86400 * {off} AS BIGINT)"
    return f"""{name} AS (
  SELECT o_orderkey AS id, o_custkey AS customer_id, o_totalprice AS amount,
         CAST({BASE_EPOCH} + 86400 * (o_orderkey % {N_CREATED}) AS BIGINT) AS created_at,
         {upd} AS updated_at, {parts(upd)}
  FROM orders)"""


def net_cte(table: str | None, run_date: _dt.date | None, days_back: int = 0, src: str = "changelog",
            name: str = "net") -> str:
    conds = ["action IN ('I','U','D')", "row_data IS NOT NULL"]
    if table is not None:
        conds.append(f"table_name = '{table}'")
    if run_date is not None:
        lo, hi = day_window(run_date, days_back)
        conds.append(f"action_tstamp_tx BETWEEN {lo} AND {hi}")
    return f"""{name} AS (
  SELECT table_name, {epoch_date('action_tstamp_tx')} AS change_date, row_data AS id,
         CASE WHEN bool_or(action = 'D') THEN 'D' WHEN bool_or(action = 'I') THEN 'I' ELSE 'U' END AS net_action,
         arg_max(changed_fields, (action_tstamp_tx, event_id)) FILTER (WHERE action = 'D') AS deleted_updated_at
  FROM {src} WHERE {' AND '.join(conds)}
  GROUP BY table_name, change_date, row_data)"""


def affected_cte(table: str, run_date: _dt.date, days_back: int = 0, net: str = "net", src: str = "snapshot",
                 name: str = "affected", log: str = "changelog") -> str:
    lo, hi = day_window(run_date, days_back)
    runs = " UNION ".join(
        f"SELECT {d.year}::BIGINT AS year, {d.month}::BIGINT AS month, {d.day}::BIGINT AS day"
        for d in (run_date - _dt.timedelta(days=i) for i in range(days_back, -1, -1))
    )
    return f"""{name} AS (
  {runs}
  UNION
  SELECT DISTINCT s.year, s.month, s.day FROM {src} s
    WHERE s.id IN (SELECT id FROM {net} WHERE net_action = 'U' AND table_name = '{table}')
  UNION
  SELECT DISTINCT {parts('changed_fields')} FROM {log}
    WHERE action = 'D' AND changed_fields IS NOT NULL AND table_name = '{table}'
      AND action_tstamp_tx BETWEEN {lo} AND {hi})"""


def edit_pair_ctes(table: str = "order") -> list[str]:
    k = TABLE_NAMES.index(table)
    upd = f"CAST({BASE_EPOCH} + 86400 * ((o_orderkey + {k}) % {N_DATES}) AS BIGINT)"
    return [
        f"""base AS (
  SELECT o_orderkey AS id, o_custkey AS customer_id, o_totalprice AS amount, {upd} AS updated_at,
         {parts(upd)}, o_orderstatus AS st, o_orderpriority AS pr FROM orders)""",
        """old AS (SELECT id, customer_id, amount, updated_at, year, month, day FROM base
  WHERE NOT (st = 'O' AND pr = '5-LOW'))""",
        """new AS (SELECT id, customer_id, CASE WHEN st = 'P' THEN amount + 1 ELSE amount END AS amount,
  CASE WHEN pr = '2-HIGH' THEN updated_at + 1 ELSE updated_at END AS updated_at, year, month, day
  FROM base WHERE NOT (st = 'F' AND pr = '1-URGENT'))""",
    ]


def diff_cte(table: str, now_epoch: int, compare=("customer_id", "amount", "updated_at", "year", "month", "day"),
             old: str = "old", new: str = "new", name: str = "diff") -> str:
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in compare) or "false"
    return f"""{name} AS (
  SELECT '{table}' AS table_name,
         CASE WHEN o.id IS NULL THEN 'I' WHEN n.id IS NULL THEN 'D' ELSE 'U' END AS action,
         CAST({now_epoch} AS BIGINT) AS action_tstamp_tx, COALESCE(o.id, n.id) AS row_data,
         CASE WHEN n.id IS NULL THEN o.updated_at END AS changed_fields, false AS statement_only
  FROM {old} o FULL JOIN {new} n ON o.id = n.id
  WHERE o.id IS NULL OR n.id IS NULL OR {differs})"""
