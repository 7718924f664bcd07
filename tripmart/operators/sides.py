"""Reconciliation of two sides of the same trips, from one scan.

Each side is a condition that says which trips are valid there.  Periods, hours, locations
and bands are keys of one aggregate that carries both sides' states; the report's lines are
unpivoted from one row.  ``reconcile`` compares stored tables; this compares trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT, TripContract
from tripmart.functions.calendar import month_label
from tripmart.operators.reconcile import (
    HOUR_METRIC,
    REPORT_COLUMNS,
    ROWS_METRIC,
    TOLERANCE,
    ZONE_METRIC,
    band_line,
    count_line,
    hour_line,
    pending_bands_line,
    zone_line,
)
from tripmart.operators.zones import ZONE_KEYS, attach_zones

SIDES = ("left", "right")
Periods = list[tuple[int, int]]


def period_name(period: tuple[int, int]) -> str:
    return "%d-%02d" % period


def side_cells(prepared: DataFrame, left: Column, right: Column) -> DataFrame:
    """Trips, fares and their sum per period, hour, location and band, on each side.

    ``left`` and ``right`` say which rows are valid there and are never null.  A row that is
    valid nowhere keeps only its period.
    """
    valid = dict(zip(SIDES, (left, right), strict=True))
    either = left | right
    keys = {
        "period": month_label(F.col("source_year"), F.col("source_month")),
        **{name: F.when(either, F.col(name)) for name in ("pickup_hour", "PULocationID")},
        "distance_band": F.when(either, F.col("distance_band")),
    }
    fare = F.col("fare_amount")
    return prepared.groupBy(*[column.alias(name) for name, column in keys.items()]).agg(
        *[F.count_if(rule).alias(f"{side}_trips") for side, rule in valid.items()],
        *[
            F.count_if(rule & F.col("valid_fare")).alias(f"{side}_fares")
            for side, rule in valid.items()
        ],
        *[
            F.sum(F.when(rule & F.col("valid_fare"), fare)).alias(f"{side}_fare_sum")
            for side, rule in valid.items()
        ],
    )


def side_facts(cells: DataFrame, zones: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """One row per period: on each side valid rows, busiest hour, top zone, fares by band."""
    states = [f"{side}_{part}" for side in SIDES for part in ("trips", "fares", "fare_sum")]
    keys = ["pickup_hour", *ZONE_KEYS, "distance_band"]
    grains = (
        attach_zones(cells, zones)
        .groupingSets(
            [("period", "pickup_hour"), ("period", *ZONE_KEYS), ("period", "distance_band")],
            "period",
            *keys,
        )
        .agg(
            *[F.sum(name).alias(name) for name in states],
            (F.grouping("pickup_hour") == 0).alias("is_hour"),
            (F.grouping("pickup_Zone") == 0).alias("is_zone"),
            (F.grouping("distance_band") == 0).alias("is_band"),
        )
    )
    named = F.col("is_zone") & F.col("pickup_Borough").isNotNull() & F.col("pickup_Zone").isNotNull()
    found = []
    for side in SIDES:
        trips = F.col(f"{side}_trips")
        order = (-trips).alias("order")
        hour = F.when(F.col("is_hour") & (trips > 0), F.struct(order, "pickup_hour"))
        zone = F.when(named & (trips > 0), F.struct(order, *ZONE_KEYS))
        found += [
            # Every trip has an hour or none, so the hours hold all of them.
            F.sum(F.when(F.col("is_hour"), trips)).alias(f"{side}_rows"),
            F.min(hour).alias(f"{side}_hour"),
            F.min(zone).alias(f"{side}_zone"),
        ]
        mean = F.try_divide(F.col(f"{side}_fare_sum"), F.col(f"{side}_fares"))
        for place, label in enumerate(contract.band_labels):
            here = F.col("is_band") & (F.col("distance_band") == label)
            found.append(F.max(F.when(here, mean)).alias(f"{side}_band_{place}"))
    return grains.groupBy("period").agg(*found)


def on_one_row(facts: DataFrame, periods: Periods) -> DataFrame:
    """The facts of given periods as one struct column each; null without any row."""
    whole = F.struct(*[name for name in facts.columns if name != "period"])
    return facts.agg(
        *[
            F.max(F.when(F.col("period") == period_name(period), whole)).alias(period_name(period))
            for period in periods
        ]
    )


def _part(period: tuple[int, int], name: str) -> Column:
    return F.col(f"`{period_name(period)}`.{name}")


def rows_line(left: tuple[int, int], right: tuple[int, int]) -> Column:
    return count_line(F.lit(ROWS_METRIC), _part(left, "left_rows"), _part(right, "right_rows"))


def busiest_line(left: tuple[int, int], right: tuple[int, int]) -> Column:
    return hour_line(
        F.lit(HOUR_METRIC),
        (_part(left, "left_hour.pickup_hour"), -_part(left, "left_hour.order")),
        (_part(right, "right_hour.pickup_hour"), -_part(right, "right_hour.order")),
    )


def top_line(left: tuple[int, int], right: tuple[int, int]) -> Column:
    return zone_line(
        F.lit(ZONE_METRIC),
        (_part(left, "left_zone.pickup_Zone"), -_part(left, "left_zone.order")),
        (_part(right, "right_zone.pickup_Zone"), -_part(right, "right_zone.order")),
    )


def band_lines(
    period: tuple[int, int], tolerance: float = TOLERANCE, contract: TripContract = DEFAULT
) -> Column:
    """A line per band, or one pending line for a period without trips."""
    lines = [
        band_line(
            F.lit(label),
            _part(period, f"left_band_{place}"),
            _part(period, f"right_band_{place}"),
            tolerance,
        )
        for place, label in enumerate(contract.band_labels)
    ]
    known = F.col(f"`{period_name(period)}`").isNotNull()
    return F.when(known, F.array(*lines)).otherwise(F.array(pending_bands_line(tolerance)))


def lines_of(row: DataFrame, *lines: Column) -> DataFrame:
    """Lines of the report as rows."""
    return row.select(F.inline(F.array(*lines))).select(*REPORT_COLUMNS)


def reconcile_trips(
    prepared: DataFrame,
    zones: DataFrame,
    left: Column,
    right: Column,
    periods: Periods,
    tolerance: float = TOLERANCE,
    contract: TripContract = DEFAULT,
) -> DataFrame:
    """The full report of several periods, in one scan of the trips."""
    row = on_one_row(side_facts(side_cells(prepared, left, right), zones, contract), periods)

    def of_period(period: tuple[int, int]) -> Column:
        own = F.array(rows_line(period, period), busiest_line(period, period), top_line(period, period))
        lines = F.flatten(F.array(own, band_lines(period, tolerance, contract)))
        return F.struct(F.lit(period_name(period)).alias("period"), lines.alias("lines"))

    each = row.select(F.inline(F.array(*[of_period(period) for period in periods])))
    return each.select("period", F.inline("lines"))
