"""Hourly demand and the one-row common metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.calendar import month_label
from tripmart.operators.cells import merge_cells, occupied
from tripmart.operators.ranking import top_k
from tripmart.operators.zones import ZONE_KEYS, attach_zones, zone_order
from tripmart.sources.months import MONTH_KEYS


def hourly_counts(cells: DataFrame) -> DataFrame:
    return occupied(merge_cells(cells, ["pickup_hour"], ["trip_count"]))


def hourly_demand(cells: DataFrame) -> DataFrame:
    return hourly_counts(cells).orderBy("pickup_hour")


def hour_order() -> list:
    return [F.desc("trip_count"), F.asc("pickup_hour")]


def busiest_hour(cells: DataFrame) -> DataFrame:
    """Most trips; the smallest hour wins a tie."""
    return top_k(hourly_counts(cells), hour_order(), 1)


def metric_cells(prepared: DataFrame) -> DataFrame:
    """Raw rows reduced to (month, hour, location) counts.

    Invalid rows keep only their month.  At most 24 x locations rows per month
    survive the map side, whatever the number of trips.
    """
    valid = F.col("structurally_valid")
    return (
        prepared.select(
            *MONTH_KEYS,
            F.when(valid, F.col("pickup_hour")).alias("pickup_hour"),
            F.when(valid, F.col("PULocationID")).alias("PULocationID"),
            F.when(valid, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("trip_count"),
            F.lit(1).cast("bigint").alias("raw_rows"),
        )
        .groupBy(*MONTH_KEYS, "pickup_hour", "PULocationID")
        .agg(F.sum("trip_count").alias("trip_count"), F.sum("raw_rows").alias("raw_rows"))
    )


def common_metrics(cells: DataFrame, zones: DataFrame) -> DataFrame:
    """Totals, busiest hour and top zone in one row.

    ``cells`` is :func:`metric_cells` or a rollup with its columns.  The three
    grains (month, hour, zone) come from one grouping-sets aggregate over those
    few cells, so the trips are scanned once and no one-row tables are crossed.
    """
    grains = (
        attach_zones(cells, zones)
        .groupingSets(
            [tuple(MONTH_KEYS), ("pickup_hour",), tuple(ZONE_KEYS)],
            *MONTH_KEYS,
            "pickup_hour",
            *ZONE_KEYS,
        )
        .agg(
            F.sum("trip_count").alias("trip_count"),
            F.sum("raw_rows").alias("raw_rows"),
            (F.grouping("source_year") == 0).alias("is_month"),
            (F.grouping("pickup_hour") == 0).alias("is_hour"),
            (F.grouping("pickup_Zone") == 0).alias("is_zone"),
        )
    )
    month = month_label(F.col("source_year"), F.col("source_month"))
    trips = F.col("trip_count")
    named = F.col("is_zone") & F.col("pickup_Borough").isNotNull() & F.col("pickup_Zone").isNotNull()
    hour_rank = F.when(
        F.col("is_hour") & F.col("pickup_hour").isNotNull(),
        F.struct((-trips).alias("order"), F.col("pickup_hour")),
    )
    zone_rank = F.when(named, F.struct((-trips).alias("order"), *ZONE_KEYS))
    summary = grains.agg(
        F.min(F.when(F.col("is_month"), month)).alias("first_month"),
        F.max(F.when(F.col("is_month"), month)).alias("last_month"),
        F.count_if("is_month").alias("months_processed"),
        F.sum(F.when(F.col("is_month"), F.col("raw_rows"))).alias("raw_rows"),
        F.sum(F.when(F.col("is_month"), trips)).alias("valid_rows"),
        F.min(hour_rank).alias("hour"),
        F.min(zone_rank).alias("zone"),
    )
    one_month = F.col("first_month") == F.col("last_month")
    return summary.select(
        F.when(one_month, F.col("first_month"))
        .otherwise(F.concat_ws("_to_", "first_month", "last_month"))
        .alias("source_period"),
        "months_processed",
        "raw_rows",
        "valid_rows",
        F.col("hour.pickup_hour").alias("busiest_pickup_hour"),
        (-F.col("hour.order")).alias("busiest_pickup_hour_trips"),
        F.col("zone.pickup_Borough").alias("top_pickup_borough"),
        F.col("zone.pickup_Zone").alias("top_pickup_zone"),
        (-F.col("zone.order")).alias("top_pickup_zone_trips"),
    )


def period_common_metrics(cells: DataFrame, zones: DataFrame) -> DataFrame:
    """Common metrics of cells restricted to one period."""
    return common_metrics(cells, zones).drop("months_processed")


def common_metrics_of_tables(
    quality: DataFrame, hour_counts: DataFrame, zone_counts: DataFrame
) -> DataFrame:
    """Common metrics from finished tables (a stored report's rollups).

    Each part is one row; they are stacked and folded into one, column by column.
    """
    from_table = quality.agg(
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        F.count("*").alias("months_processed"),
        F.sum("raw_rows").alias("raw_rows"),
        F.sum("structurally_valid_rows").alias("valid_rows"),
    )
    span = F.concat_ws("_to_", F.array_distinct(F.array("first_month", "last_month")))
    totals = from_table.select(
        span.alias("source_period"), "months_processed", "raw_rows", "valid_rows"
    )
    hour = top_k(hour_counts, hour_order(), 1).select(
        F.col("pickup_hour").alias("busiest_pickup_hour"),
        F.col("trip_count").alias("busiest_pickup_hour_trips"),
    )
    zone = top_k(zone_counts, zone_order(), 1).select(
        F.col("pickup_Borough").alias("top_pickup_borough"),
        F.col("pickup_Zone").alias("top_pickup_zone"),
        F.col("trip_count").alias("top_pickup_zone_trips"),
    )
    stacked = totals.unionByName(hour, True).unionByName(zone, True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])
