"""Date helpers: month buckets, prunable month ranges, calendar parts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(value) -> _dt.date:
    """Parse ``YYYY-MM-DD`` (or pass a date through); anything else raises ValueError."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    try:
        return _dt.datetime.strptime(str(value), "%Y-%m-%d").date()
    except ValueError as e:
        raise ValueError(f"invalid date {value!r}: expected YYYY-MM-DD") from e


def month_bucket(d: Column | str) -> Column:
    """First day of the month as a DATE (``trunc(d, 'MM')``)."""
    return F.trunc(_c(d).cast("date"), "MM")


def in_month(d: Column | str, month) -> Column:
    """``d`` lies in the month starting at ``month``, as a plain date range.

    Unlike ``trunc(d,'MM') = month`` this range reaches the Parquet reader as
    pushed filters (row-group min/max skipping).
    """
    m = as_date(month).replace(day=1)
    nxt = (m.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    col = _c(d)
    return (col >= F.lit(m)) & (col < F.lit(nxt))


def in_range(d: Column | str, start, end) -> Column:
    """Inclusive date range predicate with literal bounds."""
    col = _c(d)
    return (col >= F.lit(as_date(start))) & (col <= F.lit(as_date(end)))


def day_of_week_sun0(d: Column | str) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(_c(d)) - F.lit(1)


def month_start(value) -> _dt.date:
    """First day of the month of ``value``."""
    return as_date(value).replace(day=1)


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal that does not depend on any time zone.

    A Python ``datetime`` handed to ``F.lit`` becomes a zone-aware timestamp
    converted through the Python process's local zone; going through its text
    keeps the wall-clock value exactly, whatever the session time zone.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")
