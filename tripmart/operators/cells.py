"""Additive trip states.

A cell is a set of counts and sums.  A valid trip is a cell of one trip; a
stored monthly rollup row is a cell of many.  Cells merge by summation, never
by averaging averages, so any grain can be built from any finer one and reports
do not care which they get.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.clean import finite_ratio

#: metric -> (value, condition) over valid trips; null values never count.
_METRICS = {
    "fare": ("fare_amount", "valid_fare"),
    "total": ("total_amount", "valid_fare"),
    "distance": ("trip_distance", "valid_distance"),
    "duration": ("trip_duration_minutes", None),
    "surcharge": ("congestion_surcharge", None),
}
MEAN_STATES = [*_METRICS, "per_mile"]
STATES = (
    ["trip_count"]
    + [f"{metric}_{part}" for metric in MEAN_STATES for part in ("sum", "count")]
    + ["cbd_reported", "cbd_charged"]
)

#: Independent defect counters over raw rows; they overlap and do not add up.
#: These are the columns of the quality table.
DEFECTS = [
    "null_pickup_timestamp",
    "null_dropoff_timestamp",
    "dropoff_not_after_pickup",
    "duration_nonpositive",
    "duration_over_240",
    "source_month_mismatch",
    "null_PULocationID",
    "null_DOLocationID",
    "nonpositive_distance",
    "nonpositive_fare",
    "missing_passenger_count",
]
ADDITIVE = [*STATES, "raw_rows", *DEFECTS]


def _one_if(condition: Column) -> Column:
    return F.when(condition, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def trip_cells(prepared: DataFrame) -> DataFrame:
    """Add the states of one trip to every prepared row.

    A row that is not structurally valid becomes an empty cell: zero counts and
    null sums.  That replaces a filter on a rule with many terms, which the
    optimizer would expand into the scan filter and evaluate term by term
    again; and it keeps months without any valid trip in monthly tables.
    """
    included = F.col("structurally_valid")
    states = {"trip_count": _one_if(included)}
    values = {}
    for metric, (value, condition) in _METRICS.items():
        counted = included if condition is None else included & F.col(condition)
        values[metric] = F.when(counted, F.col(value))
    both = included & F.col("valid_fare") & F.col("valid_distance")
    per_mile = finite_ratio(F.col("fare_amount"), F.col("trip_distance"))
    values["per_mile"] = F.when(both, per_mile)
    for metric, value in values.items():
        states[f"{metric}_sum"] = value
        states[f"{metric}_count"] = _one_if(value.isNotNull())
    fee = F.col("cbd_congestion_fee")
    states["cbd_reported"] = _one_if(included & fee.isNotNull())
    states["cbd_charged"] = _one_if(included & (fee > 0))
    return prepared.withColumns(states)


def quality_cells(prepared: DataFrame, max_duration_minutes: float) -> DataFrame:
    """Add raw-row and defect counters to every prepared row, valid or not."""
    pickup, dropoff = F.col("pickup_ts"), F.col("dropoff_ts")
    duration = F.col("trip_duration_minutes")
    distance, fare = F.col("trip_distance"), F.col("fare_amount")
    defects = {
        "null_pickup_timestamp": pickup.isNull(),
        "null_dropoff_timestamp": dropoff.isNull(),
        "dropoff_not_after_pickup": dropoff <= pickup,
        "duration_nonpositive": duration <= 0,
        "duration_over_240": duration > F.lit(max_duration_minutes),
        "source_month_mismatch": pickup.isNotNull() & ~F.col("source_month_match"),
        "null_PULocationID": F.col("PULocationID").isNull(),
        "null_DOLocationID": F.col("DOLocationID").isNull(),
        "nonpositive_distance": distance.isNull() | (distance <= 0),
        "nonpositive_fare": fare.isNull() | (fare <= 0),
        "missing_passenger_count": F.col("passenger_count").isNull(),
    }
    return prepared.withColumns(
        {
            "trip_count": _one_if(F.col("structurally_valid")),
            "raw_rows": F.lit(1).cast("bigint"),
            **{name: _one_if(defects[name]) for name in DEFECTS},
        }
    )


def merge_cells(cells: DataFrame, keys: list[str], states: list[str] | None = None) -> DataFrame:
    """Re-aggregate cells to a coarser grain.

    Partial aggregation runs before the shuffle, so at most one row per key and
    task travels: a key holding a third of all trips costs no more than a rare
    one.
    """
    wanted = ADDITIVE if states is None else states
    present = [name for name in wanted if name in cells.columns]
    return cells.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in present])


def occupied(cells: DataFrame) -> DataFrame:
    """Cells that hold at least one trip."""
    return cells.filter(F.col("trip_count") > 0)


def mean(metric: str) -> Column:
    """Mean of a metric from its merged states; null when nothing counted."""
    return F.try_divide(F.col(f"{metric}_sum"), F.col(f"{metric}_count"))
