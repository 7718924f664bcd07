"""Readable renderings used by the reconciliation report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_with_trips(hour: Column, trips: Column) -> Column:
    return F.format_string("%02d:00 (%s trips)", hour, F.format_number(trips, 0))


def name_with_trips(name: Column, trips: Column) -> Column:
    return F.format_string("%s (%s trips)", name, F.format_number(trips, 0))
