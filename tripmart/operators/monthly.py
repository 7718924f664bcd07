"""Month and year comparison tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.calendar import days_in_month, days_in_year
from tripmart.operators.cells import mean, merge_cells
from tripmart.sources.months import MONTH_KEYS


def monthly_comparison(cells: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """One row per source month.

    ``cells`` come from *prepared* trips (or a rollup of them), so a month whose
    rows are all invalid still has its row.  ``months`` adds further months of a
    spine.
    """
    monthly = merge_cells(cells, MONTH_KEYS)
    if months is not None:
        monthly = months.select(*MONTH_KEYS).join(monthly, MONTH_KEYS, "left")
    counts = {name: F.coalesce(name, F.lit(0)) for name in ("trip_count", "cbd_reported", "cbd_charged")}
    available = F.col("cbd_reported") > 0
    # A trip without a fee value counts as not charged, but only in months
    # where the fee exists at all.
    share = F.when(available, F.try_divide("cbd_charged", "trip_count") * 100)
    return (
        monthly.withColumns(counts)
        .orderBy(*MONTH_KEYS)
        .select(
            F.col("source_year").alias("pickup_year"),
            F.col("source_month").alias("pickup_month"),
            "trip_count",
            mean("fare").alias("avg_valid_fare_amount"),
            mean("total").alias("avg_total_amount_for_valid_fare"),
            mean("distance").alias("avg_valid_trip_distance"),
            mean("duration").alias("avg_trip_duration_min"),
            mean("surcharge").alias("avg_congestion_surcharge"),
            available.alias("cbd_fee_available"),
            F.col("cbd_charged").alias("cbd_fee_charged_trips"),
            share.alias("cbd_fee_charged_share_pct"),
        )
    )


def monthly_demand(monthly: DataFrame) -> DataFrame:
    return monthly.select("pickup_year", "pickup_month", "trip_count")


def monthly_cbd_fee(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "pickup_year",
        "pickup_month",
        "cbd_fee_available",
        "cbd_fee_charged_trips",
        "cbd_fee_charged_share_pct",
    )


def with_daily_average(monthly: DataFrame) -> DataFrame:
    """The monthly table plus days_in_month and avg_daily_trips."""
    days = days_in_month(F.col("pickup_year"), F.col("pickup_month"))
    return monthly.withColumn("days_in_month", days).withColumn(
        "avg_daily_trips", F.col("trip_count") / F.col("days_in_month")
    )


def weighted_mean(value: str, weight: str, null_as_zero: bool = False) -> Column:
    """sum(value x weight) / sum(weight).

    One null value makes the result null, unless nulls are read as zero: plain
    ``sum`` would drop them from the numerator only.
    """
    taken = F.coalesce(value, F.lit(0.0)) if null_as_zero else F.col(value)
    average = F.try_divide(F.sum(taken * F.col(weight)), F.sum(weight))
    return average if null_as_zero else F.when(F.count(value) == F.count("*"), average)


def year_summary(monthly: DataFrame) -> DataFrame:
    """Yearly totals; yearly averages weight the monthly means by trips."""
    # Largest count first, then the smallest month.
    peak = F.min(F.struct((-F.col("trip_count")).alias("order"), F.col("pickup_month")))
    yearly = monthly.groupBy("pickup_year").agg(
        F.sum("trip_count").alias("total_valid_trips"),
        peak.alias("peak"),
        weighted_mean("avg_valid_fare_amount", "trip_count").alias("avg_monthly_valid_fare_amount"),
        weighted_mean("avg_total_amount_for_valid_fare", "trip_count").alias(
            "avg_monthly_total_amount"
        ),
        weighted_mean("avg_congestion_surcharge", "trip_count", null_as_zero=True).alias(
            "avg_congestion_surcharge"
        ),
        F.sum("cbd_fee_charged_trips").alias("cbd_fee_charged_trips"),
    )
    return yearly.orderBy("pickup_year").select(
        "pickup_year",
        "total_valid_trips",
        (F.col("total_valid_trips") / days_in_year(F.col("pickup_year"))).alias("avg_daily_trips"),
        F.col("peak.pickup_month").alias("peak_month"),
        (-F.col("peak.order")).alias("peak_monthly_trips"),
        "avg_monthly_valid_fare_amount",
        "avg_monthly_total_amount",
        "avg_congestion_surcharge",
        "cbd_fee_charged_trips",
    )
