"""Column defaults and small expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import LITERAL_DEFAULTS, NOW_EPOCH_DEFAULTS, SCHEMAS
from .timeutil import date_parts, epoch_to_date, now_epoch


def with_defaults(df: DataFrame, table: str, now: _dt.datetime | None = None) -> DataFrame:
    """Add each defaulted column of ``table`` that is *absent* from ``df``.

    A column that is present keeps its values, NULLs included, as a database keeps an
    explicit NULL. Output follows the table's schema order, with types cast to it.
    """
    ts = now_epoch(now)
    y, m, d = date_parts(epoch_to_date(ts))
    fills: dict[str, Column] = {"year": y, "month": m, "day": d}
    for c in NOW_EPOCH_DEFAULTS.get(table, ()):
        fills[c] = ts
    for c, v in LITERAL_DEFAULTS.get(table, {}).items():
        fills[c] = F.lit(v)
    schema = SCHEMAS[table]
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in fills:
            out.append(fills[f.name].cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def arith_expr(x, y, z) -> Column:
    """``x + y * z``."""
    c = [F.col(a) if isinstance(a, str) else a for a in (x, y, z)]
    return c[0] + c[1] * c[2]


def md5_of(col) -> Column:
    """``md5`` of a value's text: the deterministic stand-in for ``md5(random()::text)``."""
    return F.md5(F.col(col).cast("string") if isinstance(col, str) else col.cast("string"))


def fk_in_range(col, n: int = 101) -> Column:
    """Deterministic foreign key in ``1..n`` from a key, standing in for ``random()*100+1``."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.pmod(c, F.lit(n)) + 1).cast("bigint")
