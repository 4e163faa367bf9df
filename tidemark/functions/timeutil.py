"""Zone-free epoch/date helpers.

Partition dates are computed from epoch seconds in UTC or in a named zone, with no
dependence on ``spark.sql.session.timeZone``: the session belongs to the caller.
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400
_EPOCH = _dt.date(1970, 1, 1)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_window(run_date: _dt.date, days_back: int = 0, zone: str | None = None) -> tuple[int, int]:
    """Inclusive epoch-second bounds ``(lo, hi)`` covering ``run_date - days_back`` .. ``run_date``.

    The days are those of ``zone`` (UTC by default), so they are the days that
    ``epoch_to_date`` gives under the same zone, also where a day has 23 or 25 hours.
    """
    first, after = run_date - _dt.timedelta(days=days_back), run_date + _dt.timedelta(days=1)
    if zone is None:
        return (first - _EPOCH).days * SECONDS_PER_DAY, (after - _EPOCH).days * SECONDS_PER_DAY - 1
    start = lambda d: int(_dt.datetime(d.year, d.month, d.day, tzinfo=ZoneInfo(zone)).timestamp())
    return start(first), start(after) - 1


def ntz_literal(when: _dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal built from text, so no session time zone is involved."""
    return F.lit(when.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a ``timestamp_ntz`` (read as UTC) or ``timestamp`` column.

    ``unix_timestamp`` converts a ``timestamp_ntz`` without the session zone. A
    ``timestamp_diff`` against 1970 does not: it goes through the session zone and is
    an hour off for wall times inside a daylight-saving gap.
    """
    return F.unix_timestamp(_c(ts))


def epoch_to_date(epoch, zone: str | None = None) -> Column:
    """Calendar date of epoch seconds; UTC unless ``zone`` names a time zone."""
    e = _c(epoch)
    if zone is None:
        return F.date_from_unix_date(F.floor(e / SECONDS_PER_DAY).cast("int"))
    # a wall time without a zone, built from the epoch by plain arithmetic, then moved to
    # the named zone: the session zone never takes part
    days = F.floor(e / SECONDS_PER_DAY).cast("int")
    rest = (e - F.floor(e / SECONDS_PER_DAY) * SECONDS_PER_DAY).cast("decimal(18,6)")
    zero = F.lit(0)
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days, zero, zero, rest)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date")


def date_parts(date, prefix: str = "") -> list[Column]:
    """``year``, ``month``, ``day`` of a date as bigint columns."""
    d = _c(date)
    return [
        F.year(d).cast("bigint").alias(f"{prefix}year"),
        F.month(d).cast("bigint").alias(f"{prefix}month"),
        F.dayofmonth(d).cast("bigint").alias(f"{prefix}day"),
    ]


def epoch_parts(epoch, zone: str | None = None) -> list[Column]:
    return date_parts(epoch_to_date(epoch, zone))


def partition_path(year="year", month="month", day="day") -> Column:
    """Hive-style relative folder of a partition, without zero padding."""
    return F.format_string("year=%d/month=%d/day=%d", _c(year), _c(month), _c(day))


def date_key(year="year", month="month", day="day") -> Column:
    """One bigint per calendar day (yyyymmdd), used to match partitions with one ``IN``."""
    return _c(year) * 10000 + _c(month) * 100 + _c(day)


def now_epoch(now: _dt.datetime | None = None) -> Column:
    """Epoch seconds of an injected ``now`` (UTC), or of the current timestamp."""
    if now is None:
        return F.unix_timestamp(F.current_timestamp())
    if now.tzinfo is None:
        now = now.replace(tzinfo=_dt.timezone.utc)
    return F.lit(int(now.timestamp())).cast("bigint")


def days_before(run_date: _dt.date, n: int) -> _dt.date:
    """``run_date`` minus ``n`` days."""
    return run_date - _dt.timedelta(days=n)
