"""Stored monthly rollups: the partial states every report can be merged from.

Three rollups cover all reports, so a full run scans the trips three times with
three different column sets instead of once per table, and a new month is
appended without touching earlier ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT, TripContract
from tripmart.operators.cells import DEFECTS, STATES, merge_cells
from tripmart.operators.fares import fare_histogram
from tripmart.operators.quality import location_cells
from tripmart.sources.months import MONTH_KEYS

DAY_GRAIN, CATEGORY_GRAIN = "day", "category"
DAY_KEYS = [*MONTH_KEYS, "is_weekend", "pickup_date", "pickup_hour"]
CATEGORY_KEYS = [*MONTH_KEYS, "distance_band", "passenger_category"]
LOCATION_KEYS = [*MONTH_KEYS, "is_weekend", "PULocationID"]
FARE_KEYS = [*MONTH_KEYS, "distance_band"]


def trip_rollup(cells: DataFrame) -> DataFrame:
    """All trip states at two grains of a month, told apart by ``grain``.

    By date and hour (at most 744 rows a month) and by band and passenger
    category (54 rows).  Both come from one scan; keeping the grains apart
    instead of crossing them keeps each task's partial result at their sum.

    Empty cells lose their date, so that stray dates make no groups; they leave
    a source month present that has no valid trip.
    """
    date = F.when(F.col("structurally_valid"), F.col("pickup_date"))
    return (
        cells.withColumn("pickup_date", date)
        .groupingSets(
            [tuple(DAY_KEYS), tuple(CATEGORY_KEYS)], *DAY_KEYS, *CATEGORY_KEYS[len(MONTH_KEYS) :]
        )
        .agg(
            *[F.sum(name).alias(name) for name in STATES],
            F.when(F.grouping("pickup_date") == 0, DAY_GRAIN)
            .otherwise(CATEGORY_GRAIN)
            .alias("grain"),
        )
    )


def day_cells(rollup: DataFrame) -> DataFrame:
    return rollup.filter(F.col("grain") == DAY_GRAIN)


def category_cells(rollup: DataFrame) -> DataFrame:
    return rollup.filter(F.col("grain") == CATEGORY_GRAIN)


def location_rollup(prepared: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """Raw-row quality counters and trip counts by day type and location."""
    cells = location_cells(prepared, contract)
    return merge_cells(cells, LOCATION_KEYS, ["raw_rows", *DEFECTS, "trip_count"])


def fare_rollup(cells: DataFrame) -> DataFrame:
    """Positive fares by band as value counts, the mergeable state of a median."""
    return fare_histogram(cells, FARE_KEYS)


def merge_rollups(rollup: DataFrame, keys: list[str]) -> DataFrame:
    """Merge stored cells to the given keys."""
    return merge_cells(rollup, keys)
