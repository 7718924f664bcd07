"""Report series: result tables shaped for plotting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT, TripContract
from tripmart.functions.buckets import ordinal
from tripmart.operators.scale import SUCCESS


def band_fares(distance_summary: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """Real bands only, in band order."""
    labels = [label for _, label in contract.distance_bands]
    kept = distance_summary.filter(F.col("distance_band").isin(labels))
    return kept.orderBy(ordinal(F.col("distance_band"), labels))


def passenger_distribution(summary: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    return summary.orderBy(ordinal(F.col("passenger_category"), contract.passenger_labels))


def daytype_hourly(hourly: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """Average trips per day by hour, one column per day type."""
    pivoted = hourly.groupBy("pickup_hour").pivot("day_type", list(contract.day_types))
    return pivoted.agg(F.first("avg_daily_trips")).orderBy("pickup_hour")


def month_by_year(monthly: DataFrame, value: str, years: list[int] | None = None) -> DataFrame:
    """One monthly value as a line per year: rows are months, columns years.

    Without given years a job finds those of the monthly table.
    """
    pivoted = monthly.groupBy("pickup_month").pivot("pickup_year", years)
    return pivoted.agg(F.first(value)).orderBy("pickup_month")


def cbd_share(monthly: DataFrame) -> DataFrame:
    """Share of charged trips where the fee exists."""
    known = monthly.filter(F.col("cbd_fee_charged_share_pct").isNotNull())
    return known.select("pickup_year", "pickup_month", "cbd_fee_charged_share_pct").orderBy(
        "pickup_year", "pickup_month"
    )


def successful_scales(sweep: DataFrame) -> DataFrame:
    """Completed scales, data columns only."""
    done = sweep.filter(F.col("status") == SUCCESS)
    return done.drop("status", "result_or_error").orderBy("months")
