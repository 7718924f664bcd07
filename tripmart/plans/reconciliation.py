"""Reconciliation of two stored result folders as a job.

Each folder holds tables as the report job writes them (a slice, or the tables of a
whole report).  A table with a period in it gives the rows of the wanted one only, and a
summary of another period is not compared; what a side lacks stays PENDING.

    spark-submit -m tripmart.plans.reconciliation --left DIR --right DIR \\
        --period 2024-01 --output DIR
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.reconcile import (
    ALIASES,
    TOLERANCE,
    Side,
    has_period,
    period_rows,
    reconcile,
)
from tripmart.sources.tables import read_table, write_table

# ---- fixed values: names of the stored tables, in order of preference -----------
TABLES = {
    "summary": ("common_metrics",),
    "monthly": ("quality_summary", "monthly_quality", "monthly_trip_demand"),
    "hourly": ("hourly_demand",),
    "zones": ("top_pickup_zones",),
    "bands": ("distance_fare_summary",),
}
SUMMARY_PERIOD = "source_period"
# ---------------------------------------------------------------------------------
_COUNTS = {
    name
    for logical, names in ALIASES.items()
    if logical.endswith(("_rows", "_trips", "hour"))
    for name in names
}


def _table(spark: SparkSession, folder: str, names: tuple[str, ...], fmt: str) -> DataFrame | None:
    for name in names:
        try:
            table = read_table(spark, f"{folder.rstrip('/')}/{name}", fmt=fmt, infer=False)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        # A count may be stored as 5.0, too.
        counts = {
            column: F.col(column).cast("string").try_cast("double").cast("bigint")
            for column in table.columns
            if column in _COUNTS
        }
        return table.withColumns(counts)
    return None


def read_side(
    spark: SparkSession, folder: str, year: int, month: int, fmt: str = "csv"
) -> Side:
    """A stored side's tables of one period.

    Detail tables without a period column are those of the folder's one period; they are
    taken only if the summary names no other.
    """
    found = {part: _table(spark, folder, names, fmt) for part, names in TABLES.items()}
    summary, wanted = found["summary"], "%d-%02d" % (year, month)
    foreign = False
    if summary is not None and SUMMARY_PERIOD in summary.columns:
        foreign = summary.filter(F.trim(SUMMARY_PERIOD) == wanted).isEmpty()
    kept = {}
    for part, table in found.items():
        if table is not None and part != "summary" and has_period(table):
            kept[part] = period_rows(table, year, month)
        elif not foreign:
            kept[part] = table
    return Side(**kept)


def write_reconciliation(
    spark: SparkSession,
    left: str,
    right: str,
    period: tuple[int, int],
    output: str,
    tolerance: float = TOLERANCE,
    fmt: str = "csv",
) -> None:
    sides = [read_side(spark, folder, *period, fmt) for folder in (left, right)]
    write_table(reconcile(*sides, *period, tolerance), output, fmt)


def _period(text: str) -> tuple[int, int]:
    year, month = text.split("-")
    return int(year), int(month)


def main() -> None:
    parser = argparse.ArgumentParser(description="Reconcile two stored results")
    parser.add_argument("--left", required=True, help="folder of result tables")
    parser.add_argument("--right", required=True, help="folder of result tables")
    parser.add_argument("--period", required=True, type=_period, help="YYYY-MM")
    parser.add_argument("--output", required=True, help="folder of the report")
    parser.add_argument("--tolerance", type=float, default=TOLERANCE)
    given = parser.parse_args()
    spark = SparkSession.builder.appName("tripmart reconciliation").getOrCreate()
    write_reconciliation(
        spark, given.left, given.right, given.period, given.output, given.tolerance
    )


if __name__ == "__main__":
    main()
