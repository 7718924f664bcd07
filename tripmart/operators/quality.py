"""Monthly data-quality profile over raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT, TripContract
from tripmart.functions.calendar import month_label
from tripmart.operators.cells import DEFECTS, merge_cells, quality_cells
from tripmart.operators.zones import attach_zones
from tripmart.sources.months import MONTH_KEYS


def location_cells(prepared: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """Raw-row cells keyed for :func:`location_rollup`.

    An invalid row has no location or day type of its own: it is counted in its
    source month only.
    """
    valid = F.col("structurally_valid")
    return quality_cells(prepared, contract.max_duration_minutes).withColumns(
        {
            "PULocationID": F.when(valid, F.col("PULocationID")),
            "is_weekend": F.when(valid, F.col("is_weekend")),
        }
    )


def monthly_quality(
    cells: DataFrame, zones: DataFrame, months: DataFrame | None = None
) -> DataFrame:
    """The quality table from location cells (rows or rollup).

    One aggregation at (month, location) serves both the raw-row counters and
    the count of valid trips whose location has no zone name; the second merge
    sees a few hundred rows per month.  ``months`` (a spine) adds months that
    hold no row at all.
    """
    by_location = merge_cells(cells, [*MONTH_KEYS, "PULocationID"])
    unnamed = F.when(F.col("pickup_Zone").isNull(), F.col("trip_count"))
    monthly = (
        attach_zones(by_location, zones)
        .groupBy(*MONTH_KEYS)
        .agg(
            *[F.sum(name).alias(name) for name in ["raw_rows", *DEFECTS, "trip_count"]],
            F.coalesce(F.sum(unnamed), F.lit(0)).alias("unmatched_pickup_lookup"),
        )
    )
    if months is not None:
        monthly = months.select(*MONTH_KEYS).join(monthly, MONTH_KEYS, "left").na.fill(0)
    return monthly.orderBy(*MONTH_KEYS).select(
        month_label(F.col("source_year"), F.col("source_month")).alias("month"),
        "raw_rows",
        *DEFECTS,
        F.col("trip_count").alias("structurally_valid_rows"),
        (F.col("raw_rows") - F.col("trip_count")).alias("structurally_removed_rows"),
        "unmatched_pickup_lookup",
    )


def period_totals(quality: DataFrame) -> DataFrame:
    """Months, raw rows and valid rows of a quality table."""
    return quality.agg(
        F.count("*").alias("months_processed"),
        F.sum("raw_rows").alias("raw_rows"),
        F.sum("structurally_valid_rows").alias("valid_rows"),
    )
