"""Calendar expressions on wall-clock timestamps and (year, month) pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_weekend(timestamp: Column) -> Column:
    """Saturday or Sunday; false for a missing timestamp."""
    return F.coalesce(F.weekday(F.to_date(timestamp)).isin(5, 6), F.lit(False))


def duration_minutes(start: Column, end: Column) -> Column:
    """Fractional wall-clock minutes from ``start`` to ``end``.

    Both sides are TIMESTAMP_NTZ, so their difference is an interval that never
    consults a time zone (``timestampdiff`` would, and loses an hour when the
    session zone changes its clocks).  Dividing by one microsecond keeps the
    arithmetic in primitive longs.
    """
    microseconds = F.call_function("div", end - start, F.expr("INTERVAL '0.000001' SECOND"))
    return microseconds.cast("double") / F.lit(1e6) / F.lit(60.0)


def month_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def days_in_month(year: Column, month: Column) -> Column:
    return F.day(F.last_day(month_start(year, month)))


def days_in_year(year: Column) -> Column:
    return F.dayofyear(F.make_date(year, F.lit(12), F.lit(31)))
