"""Calendar expressions used by the date dimension and the facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def purchase_date(ts: str | Column) -> Column:
    """Timestamp → calendar date (F1)."""
    return F.to_date(ts)


def date_key(d: str | Column) -> Column:
    """Date → ``yyyyMMdd`` integer key (F2).

    Same value as ``cast(date_format(d, 'yyyyMMdd') as int)`` but stays in
    integer arithmetic inside generated code instead of formatting a string
    per row.
    """
    d = F.col(d) if isinstance(d, str) else d
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_name(d: str | Column) -> Column:
    """Full English month name."""
    return F.date_format(d, "MMMM")


def year_month(ts: str | Column) -> Column:
    """``yyyy-MM`` period label."""
    return F.date_format(ts, "yyyy-MM")


def elapsed_seconds(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from ``start`` to ``end`` (F6); time-zone free for ``timestamp_ntz``."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def elapsed_days(start: str | Column, end: str | Column, scale: int | None = 2) -> Column:
    """Elapsed days as a double, rounded half-up to ``scale``.

    NULL when either end is NULL (F9, F10).
    """
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    days = elapsed_seconds(start, end) / float(SECONDS_PER_DAY)
    if scale is not None:
        days = F.round(days, scale)
    return F.when(end.isNotNull() & start.isNotNull(), days)
