"""Derived trip columns and the structural-validity rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT, TripContract
from tripmart.functions.buckets import distance_band, passenger_category
from tripmart.functions.calendar import duration_minutes, is_weekend, month_start
from tripmart.sources.trips import typed_trips


def prepare(trips: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """All rows with derived columns; nothing is filtered.

    ``trips`` carries the contract columns in any usable type plus
    source_year / source_month.  The result is a pure projection: whatever a
    report does not use is pruned down to the scan.
    """
    typed = typed_trips(trips, contract).withColumnsRenamed(
        {contract.pickup: "pickup_ts", contract.dropoff: "dropoff_ts"}
    )
    pickup, dropoff = F.col("pickup_ts"), F.col("dropoff_ts")
    derived = typed.withColumns(
        {
            "pickup_year": F.year(pickup),
            "pickup_month": F.month(pickup),
            "pickup_date": F.to_date(pickup),
            "pickup_hour": F.hour(pickup),
            "is_weekend": is_weekend(pickup),
            "trip_duration_minutes": duration_minutes(pickup, dropoff),
            "valid_distance": F.coalesce(F.col("trip_distance") > 0, F.lit(False)),
            "valid_fare": F.coalesce(F.col("fare_amount") > 0, F.lit(False)),
            "distance_band": distance_band(F.col("trip_distance"), contract),
            "passenger_category": passenger_category(F.col("passenger_count"), contract),
        }
    )
    same_month = F.last_day("pickup_date") == F.last_day(
        month_start(F.col("source_year"), F.col("source_month"))
    )
    flagged = derived.withColumn("source_month_match", F.coalesce(same_month, F.lit(False)))
    return flagged.withColumn("structurally_valid", structurally_valid(contract))


def structurally_valid(contract: TripContract = DEFAULT) -> Column:
    """Complete, forward in time, inside its source month and not too long.

    A dropoff after the pickup is the same as a positive duration.  Non-positive
    fares and distances stay valid here; reports exclude them metric by metric.
    Never null: every operand is guarded by a null test.
    """
    return (
        F.col("pickup_ts").isNotNull()
        & F.col("dropoff_ts").isNotNull()
        & F.col("PULocationID").isNotNull()
        & F.col("DOLocationID").isNotNull()
        & (F.col("dropoff_ts") > F.col("pickup_ts"))
        & F.col("source_month_match")
        & (F.col("trip_duration_minutes") <= F.lit(contract.max_duration_minutes))
    )


def valid_trips(prepared: DataFrame) -> DataFrame:
    """Structurally valid rows; the null tests reach the Parquet scan.

    For row-level output.  Reports do not filter: they let an invalid trip be
    an empty cell (see ``trip_cells``), which evaluates the rule once per row
    next to the columns that share its inputs.
    """
    return prepared.filter("structurally_valid")


def in_period(prepared: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one source period."""
    return prepared.filter(
        (F.col("source_year") == F.lit(year)) & (F.col("source_month") == F.lit(month))
    )


def picked_up_in(prepared: DataFrame, year: int, month: int) -> DataFrame:
    """One source period, limited to pickups inside it.

    A valid trip is picked up inside its period, so for reports on valid trips
    the range removes nothing but gives the scan something to skip by.
    """
    start = month_start(F.lit(year), F.lit(month)).cast("timestamp_ntz")
    end = F.add_months(month_start(F.lit(year), F.lit(month)), 1).cast("timestamp_ntz")
    pickup = F.col("pickup_ts")
    return in_period(prepared, year, month).filter((pickup >= start) & (pickup < end))
