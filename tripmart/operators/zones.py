"""Zone names on trips and on location counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.cells import merge_cells, occupied
from tripmart.operators.ranking import top_k

ZONE_KEYS = ["pickup_Borough", "pickup_Zone"]


def attach_zones(table: DataFrame, zones: DataFrame) -> DataFrame:
    """Left many-to-one join on the pickup location.

    No hint: Spark broadcasts the dimension while its size statistics stay under
    ``spark.sql.autoBroadcastJoinThreshold`` and sorts otherwise.  Reports call
    this on location counts rather than on trips, so either way only one row
    per location (and coarse key) is joined.
    """
    return table.join(zones, "PULocationID", "left")


def named_zone_cells(cells: DataFrame, zones: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Trip counts per (keys, borough, zone).

    Locations are counted first and named after; locations sharing a name merge
    here.  Locations with no zone or no borough drop out.
    """
    keys = keys or []
    by_location = merge_cells(cells, [*keys, "PULocationID"], ["trip_count"])
    named = attach_zones(occupied(by_location), zones).filter(
        F.col("pickup_Zone").isNotNull() & F.col("pickup_Borough").isNotNull()
    )
    return merge_cells(named, [*keys, *ZONE_KEYS], ["trip_count"])


def zone_order() -> list:
    return [F.desc("trip_count"), F.asc("pickup_Borough"), F.asc("pickup_Zone")]


def zone_demand(cells: DataFrame, zones: DataFrame) -> DataFrame:
    return named_zone_cells(cells, zones)


def top_zones(cells: DataFrame, zones: DataFrame, k: int) -> DataFrame:
    return top_k(zone_demand(cells, zones), zone_order(), k)


def top_zone_by_daytype(cells: DataFrame, zones: DataFrame) -> DataFrame:
    ranked = named_zone_cells(cells, zones, ["is_weekend"])
    return top_k(ranked, zone_order(), 1, ["is_weekend"])


def zone_demand_by_id(cells: DataFrame, zones: DataFrame) -> DataFrame:
    """Trip counts per location ID with its names.

    Unlike :func:`zone_demand`, same-named locations stay apart and a location
    with a zone but no borough stays in; only a missing zone drops a row.
    """
    by_location = merge_cells(cells, ["PULocationID"], ["trip_count"])
    named = attach_zones(occupied(by_location), zones)
    return named.filter(F.col("pickup_Zone").isNotNull())


def location_order() -> list:
    return [
        F.desc("trip_count"),
        F.asc_nulls_last("pickup_Borough"),
        F.asc("pickup_Zone"),
        F.asc("PULocationID"),
    ]


def top_zone_by_id(cells: DataFrame, zones: DataFrame, k: int = 1) -> DataFrame:
    return top_k(zone_demand_by_id(cells, zones), location_order(), k)
