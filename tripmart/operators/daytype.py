"""Weekday / weekend demand, peaks and means."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.contract import DEFAULT, TripContract
from tripmart.functions.buckets import day_type
from tripmart.operators.cells import mean, merge_cells, occupied
from tripmart.operators.demand import hour_order
from tripmart.operators.ranking import top_k
from tripmart.operators.spine import with_domain
from tripmart.operators.zones import ZONE_KEYS, attach_zones

_STATES = [
    "trip_count",
    *[f"{metric}_{part}" for metric in ("fare", "distance", "duration") for part in ("sum", "count")],
]
_GRAINS = ["pickup_date", "pickup_hour", "PULocationID"]


def daily_demand(cells: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """Trips per calendar date; a date has exactly one day type."""
    daily = occupied(merge_cells(cells, ["is_weekend", "pickup_date"], ["trip_count"]))
    return daily.orderBy("pickup_date").select(
        day_type(F.col("is_weekend"), contract).alias("day_type"),
        F.date_format("pickup_date", "yyyy-MM-dd").alias("pickup_date"),
        "trip_count",
    )


def peak_hour_by_daytype(cells: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    hourly = occupied(merge_cells(cells, ["is_weekend", "pickup_hour"], ["trip_count"]))
    peak = top_k(hourly, hour_order(), 1, ["is_weekend"])
    return peak.select(
        day_type(F.col("is_weekend"), contract).alias("day_type"),
        F.col("pickup_hour").alias("peak_hour"),
        F.col("trip_count").alias("peak_hour_total_trips"),
    )


def weekday_weekend_hourly(cells: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """Hour totals per day type, spread over the days that had trips.

    Day counts and hour totals come from one aggregate at two grains.  The
    window then sees one row per date and hour of a day type, a size set by the
    calendar and not by the trips.
    """
    grains = cells.groupingSets(
        [("is_weekend", "pickup_date"), ("is_weekend", "pickup_hour")],
        "is_weekend",
        "pickup_date",
        "pickup_hour",
    ).agg(
        F.sum("trip_count").alias("trip_count"),
        (F.grouping("pickup_date") == 0).alias("is_date"),
    )
    days = F.count_if("is_date").over(Window.partitionBy("is_weekend"))
    return (
        occupied(grains)
        .withColumn("number_of_days", days)
        .filter(~F.col("is_date"))
        .orderBy("is_weekend", "pickup_hour")
        .select(
            day_type(F.col("is_weekend"), contract).alias("day_type"),
            "pickup_hour",
            F.col("trip_count").alias("total_trips"),
            "number_of_days",
            F.try_divide("trip_count", "number_of_days").alias("avg_daily_trips"),
        )
    )


def weekday_weekend_metrics(cells: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    states = merge_cells(cells, ["is_weekend"], _STATES)
    named = states.withColumn("day_type", day_type(F.col("is_weekend"), contract))
    filled = with_domain(named, "day_type", contract.day_types, ["trip_count"])
    return filled.orderBy("ord").select("day_type", "trip_count", *_mean_columns())


def _mean_columns() -> list:
    return [
        mean("fare").alias("avg_valid_fare_amount"),
        mean("distance").alias("avg_valid_trip_distance"),
        mean("duration").alias("avg_trip_duration_min"),
    ]


def daytype_grains(cells: DataFrame) -> DataFrame:
    """(day type, date), (day type, hour) and (day type, location) cells at once.

    ``grain`` names the key a row is counted by.
    """
    grains = cells.groupingSets(
        [("is_weekend", key) for key in _GRAINS], "is_weekend", *_GRAINS
    ).agg(
        *[F.sum(name).alias(name) for name in _STATES],
        F.coalesce(
            *[F.when(F.grouping(key) == 0, F.lit(key)) for key in _GRAINS]
        ).alias("grain"),
    )
    return occupied(grains)


def daytype_grains_from_rollups(day_cells: DataFrame, location_cells: DataFrame) -> DataFrame:
    """The same layout from a rollup by time and one by location."""
    sources = {"PULocationID": location_cells}
    parts = []
    for key in _GRAINS:
        part = merge_cells(sources.get(key, day_cells), ["is_weekend", key], _STATES)
        parts.append(occupied(part).withColumn("grain", F.lit(key)))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def weekday_weekend_summary(
    grains: DataFrame, zones: DataFrame, contract: TripContract = DEFAULT
) -> DataFrame:
    """Day-type totals, peak hour, top zone and means from ``daytype_grains``.

    Everything below the grains works on calendar- and dimension-sized rows.
    """
    trips = F.col("trip_count")
    by_date = F.col("grain") == "pickup_date"
    by_hour = F.col("grain") == "pickup_hour"
    by_zone = F.col("grain") == "PULocationID"
    named = attach_zones(grains, zones).groupBy("is_weekend", "grain", *_GRAINS[:2], *ZONE_KEYS)
    merged = named.agg(*[F.sum(name).alias(name) for name in _STATES])
    has_name = F.col("pickup_Zone").isNotNull() & F.col("pickup_Borough").isNotNull()
    hour_rank = F.when(by_hour, F.struct((-trips).alias("order"), "pickup_hour"))
    zone_rank = F.when(by_zone & has_name, F.struct((-trips).alias("order"), *ZONE_KEYS))
    per_type = merged.groupBy("is_weekend").agg(
        *[F.sum(F.when(by_date, F.col(name))).alias(name) for name in _STATES],
        F.count_if(by_date).alias("number_of_days"),
        F.min(hour_rank).alias("peak"),
        F.min(zone_rank).alias("zone"),
    )
    labelled = per_type.withColumn("day_type", day_type(F.col("is_weekend"), contract))
    filled = with_domain(
        labelled, "day_type", contract.day_types, ["trip_count", "number_of_days"]
    )
    peak_trips = -F.col("peak.order")
    return filled.orderBy("ord").select(
        "day_type",
        "trip_count",
        "number_of_days",
        F.try_divide("trip_count", "number_of_days").alias("avg_daily_trips"),
        F.col("peak.pickup_hour").alias("peak_hour"),
        peak_trips.alias("peak_hour_total_trips"),
        F.try_divide(peak_trips, F.col("number_of_days")).alias("peak_hour_avg_daily_trips"),
        F.col("zone.pickup_Borough").alias("top_pickup_borough"),
        F.col("zone.pickup_Zone").alias("top_pickup_zone"),
        (-F.col("zone.order")).alias("top_pickup_zone_trips"),
        *_mean_columns(),
    )
