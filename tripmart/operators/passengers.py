"""Passenger-count patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.contract import DEFAULT, TripContract
from tripmart.functions.buckets import passenger_group
from tripmart.operators.cells import mean, merge_cells
from tripmart.operators.spine import with_domain

_MEANS = {
    "fare": "avg_valid_fare_amount",
    "distance": "avg_valid_trip_distance",
    "duration": "avg_trip_duration_min",
}


def share_of_total(count: str) -> Column:
    """Percentage of the column total; null when the total is zero.

    Used on category tables only, whose row number is the length of a domain.
    """
    total = F.sum(count).over(Window.partitionBy())
    return F.try_divide(F.col(count), total) * 100


def passenger_summary(cells: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    categories = merge_cells(cells, ["passenger_category"])
    filled = with_domain(
        categories, "passenger_category", contract.passenger_labels, ["trip_count"]
    )
    return filled.withColumn("share_pct", share_of_total("trip_count")).orderBy("ord").select(
        "passenger_category",
        "trip_count",
        "share_pct",
        *[mean(metric).alias(name) for metric, name in _MEANS.items()],
    )


def single_vs_multiple(cells: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """One passenger against several; other categories drop out when the groups
    are joined to their domain.

    Category states are merged as sums, so each mean stays the mean of its own
    trips.
    """
    group = passenger_group(F.col("passenger_category"), contract)
    groups = merge_cells(cells.withColumn("passenger_group", group), ["passenger_group"])
    filled = with_domain(
        groups, "passenger_group", contract.passenger_group_labels, ["trip_count"]
    )
    share = share_of_total("trip_count")
    return filled.withColumn("share_of_valid_1_to_6_pct", share).orderBy("ord").select(
        "passenger_group",
        "trip_count",
        "share_of_valid_1_to_6_pct",
        *[mean(metric).alias(name) for metric, name in _MEANS.items()],
    )
