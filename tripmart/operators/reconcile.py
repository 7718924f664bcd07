"""Reconciliation of two independently produced result sets.

A *side* is a set of small result tables.  Values are first brought to one row
per metric on each side, then the sides are paired; a metric that one
side cannot supply stays PENDING and is never compared with another period.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.text import hour_with_trips, name_with_trips
from tripmart.operators.demand import hour_order
from tripmart.operators.ranking import top_k
from tripmart.sources.trips import ContractError

# ---- fixed values: accepted spellings, in order of preference ----------------
ALIASES = {
    "valid_rows": ("valid_rows", "structurally_valid_rows", "trip_count"),
    "monthly_valid_rows": ("structurally_valid_rows", "valid_rows"),
    "busiest_hour": ("busiest_pickup_hour",),
    "busiest_hour_trips": ("busiest_pickup_hour_trips", "busiest_hour_trips"),
    "hour": ("pickup_hour", "hour"),
    "hour_trips": ("trip_count", "trips", "total_trips"),
    "top_zone": ("top_pickup_zone", "pickup_Zone", "pickup_zone"),
    # A one-row summary's trip_count means all trips, so it is no alias here.
    "top_zone_trips": ("top_pickup_zone_trips", "trips"),
    "zone": ("pickup_Zone", "pickup_zone", "Zone"),
    "zone_trips": ("trip_count", "trips"),
    "distance_band": ("distance_band", "band"),
    "avg_fare": ("avg_valid_fare_amount", "avg_fare", "average_fare"),
}
TOLERANCE = 0.01
PASS, FAIL, REVIEW, PENDING = "PASS", "FAIL", "REVIEW", "PENDING"
NOT_AVAILABLE = "N/A"
ROWS_METRIC = "Structurally valid rows"
HOUR_METRIC = "Busiest pickup hour"
ZONE_METRIC = "Top pickup zone"
BAND_METRIC = "Average fare - "
ALL_BANDS_METRIC = "Average fare by distance band"
ROWS_RULE = "Exact"
HOUR_RULE = "Same hour and count"
ZONE_RULE = "Same zone and count, except documented ties"
BAND_RULE = "Absolute difference <= %.2f"
# ------------------------------------------------------------------------------

REPORT_COLUMNS = [
    "metric",
    "left_result",
    "right_result",
    "difference",
    "rule",
    "status",
    "explanation",
]


@dataclass(frozen=True)
class Side:
    """Result tables of one side; any of them may be absent.

    ``summary`` is one row of common metrics, ``monthly`` a table with a period
    and valid rows per month, the others are the detail tables of the period.
    """

    summary: DataFrame | None = None
    monthly: DataFrame | None = None
    hourly: DataFrame | None = None
    zones: DataFrame | None = None
    bands: DataFrame | None = None


def find_column(table: DataFrame, logical: str) -> str | None:
    """The first accepted spelling the table has, exact case."""
    return next((name for name in ALIASES[logical] if name in table.columns), None)


def resolve(table: DataFrame, *logicals: str) -> DataFrame | None:
    """Logical columns under their logical names; None if one is absent."""
    found = {logical: find_column(table, logical) for logical in logicals}
    if None in found.values():
        return None
    return table.select(*[F.col(name).alias(logical) for logical, name in found.items()])


def resolve_required(table: DataFrame, *logicals: str) -> DataFrame:
    resolved = resolve(table, *logicals)
    if resolved is None:
        wanted = ", ".join("/".join(ALIASES[logical]) for logical in logicals)
        raise ContractError(f"table has columns {table.columns}, expected {wanted}")
    return resolved


def period_predicate(columns: dict[str, Column], year: int, month: int) -> Column:
    """Rows of one period in any of the three period layouts, else no rows.

    ``year`` + ``month`` numbers, ``pickup_year`` + ``pickup_month`` numbers, or
    a ``month`` text such as 2024-01.
    """
    for year_name, month_name in (("year", "month"), ("pickup_year", "pickup_month")):
        if year_name in columns and month_name in columns:
            same_year = columns[year_name].cast("string").try_cast("double") == F.lit(float(year))
            same_month = columns[month_name].cast("string").try_cast("double") == F.lit(float(month))
            return F.coalesce(same_year & same_month, F.lit(False))
    if "month" in columns:
        text = F.trim(columns["month"].cast("string"))
        return F.coalesce(text == F.lit("%d-%02d" % (year, month)), F.lit(False))
    return F.lit(False)


def has_period(table: DataFrame) -> bool:
    layouts = ({"month"}, {"pickup_year", "pickup_month"})
    return any(layout <= set(table.columns) for layout in layouts)


def period_rows(table: DataFrame, year: int, month: int) -> DataFrame:
    columns = {name: F.col(name) for name in table.columns}
    return table.filter(period_predicate(columns, year, month))


# ---- one row per metric and side ---------------------------------------------


def side_valid_rows(side: Side, year: int, month: int) -> DataFrame | None:
    """Valid rows from the summary, else from the period's monthly row."""
    found = None
    if side.summary is not None:
        found = resolve(side.summary, "valid_rows")
    if found is None and side.monthly is not None:
        monthly = resolve(period_rows(side.monthly, year, month), "monthly_valid_rows")
        found = monthly and monthly.withColumnRenamed("monthly_valid_rows", "valid_rows")
    return found and found.select(F.lit(ROWS_METRIC).alias("metric"), "valid_rows")


def side_busiest_hour(side: Side) -> DataFrame | None:
    """Hour and trips from the summary, else ranked from the hourly table."""
    found = None
    if side.summary is not None:
        found = resolve(side.summary, "busiest_hour", "busiest_hour_trips")
    if found is None and side.hourly is not None:
        hourly = resolve(side.hourly, "hour", "hour_trips")
        found = hourly and top_k(
            hourly.toDF("pickup_hour", "trip_count"), hour_order(), 1
        )
    return found and found.toDF("name", "trips").withColumn("metric", F.lit(HOUR_METRIC))


def side_top_zone(side: Side) -> DataFrame | None:
    """Zone and trips from the summary, else ranked from the zone table."""
    found = None
    if side.summary is not None:
        found = resolve(side.summary, "top_zone", "top_zone_trips")
    if found is None and side.zones is not None:
        zones = resolve(side.zones, "zone", "zone_trips")
        found = zones and top_k(zones, [F.desc("zone_trips"), F.asc("zone")], 1)
    return found and found.toDF("name", "trips").withColumn("metric", F.lit(ZONE_METRIC))


# ---- comparators -------------------------------------------------------------


def _pair(
    left: DataFrame | None, right: DataFrame | None, values: list[str]
) -> DataFrame | None:
    """Both sides' values per metric; an absent side or metric gives nulls.

    A side holds at most one row per metric; more raise an error.  Stacking and grouping does what a
    full outer join would, also where the metric is a constant, which would make
    that join a nested loop.
    """
    stacked = [
        side.select("metric", *[F.col(name).alias(f"{prefix}_{name}") for name in values])
        for prefix, side in (("left", left), ("right", right))
        if side is not None
    ]
    if not stacked:
        return None
    both = stacked[0] if len(stacked) == 1 else stacked[0].unionByName(stacked[1], True)
    known = [f"{prefix}_{name}" for prefix in ("left", "right") for name in values]
    return both.groupBy("metric").agg(
        *[
            (_only_value(name) if name in both.columns else F.lit(None)).alias(name)
            for name in known
        ]
    )


def _only_value(name: str) -> Column:
    repeated = F.raise_error(F.lit(f"more than one {name} for a metric"))
    return F.when(F.count(name) > 1, repeated).otherwise(F.max(name))


def _line(
    metric: Column,
    left: Column,
    right: Column,
    difference: Column,
    rule: str,
    status: Column,
    hints: dict[str, str],
) -> Column:
    """One line of the report as a struct."""
    hint = F.when(status == PASS, "")
    for name, text in hints.items():
        hint = hint.when(status == name, text)
    return F.struct(
        metric.alias("metric"),
        F.coalesce(left, F.lit(NOT_AVAILABLE)).alias("left_result"),
        F.coalesce(right, F.lit(NOT_AVAILABLE)).alias("right_result"),
        F.coalesce(difference, F.lit("")).alias("difference"),
        F.lit(rule).alias("rule"),
        status.alias("status"),
        hint.otherwise("").alias("explanation"),
    )


def _report(table: DataFrame, line: Column) -> DataFrame:
    return table.select(line.alias("line")).select("line.*")


def count_line(metric: Column, left: Column, right: Column) -> Column:
    """Two counts, exactly: PASS, FAIL or PENDING."""
    a, b = left.cast("bigint"), right.cast("bigint")
    status = F.when(a.isNull() | b.isNull(), PENDING).when(a == b, PASS).otherwise(FAIL)
    hints = {
        PENDING: "One side has no valid-row count for this period.",
        FAIL: "Look at structural filtering and the source-month rule.",
    }
    return _line(
        metric, a.cast("string"), b.cast("string"), (b - a).cast("string"), ROWS_RULE, status, hints
    )


def _ranked_line(
    metric: Column,
    left: tuple[Column, Column],
    right: tuple[Column, Column],
    render,
    rule: str,
    mismatch: str,
    hints: dict[str, str],
) -> Column:
    """Two (name, trips) pairs; both parts must agree."""
    missing = reduce(lambda x, y: x | y, [part.isNull() for part in (*left, *right)])
    same = (left[0] == right[0]) & (left[1] == right[1])

    def text(name: Column, trips: Column) -> Column:
        return F.when(name.isNotNull() & trips.isNotNull(), render(name, trips))

    status = F.when(missing, PENDING).when(same, PASS).otherwise(mismatch)
    no_difference = F.lit(None).cast("string")
    return _line(metric, text(*left), text(*right), no_difference, rule, status, hints)


def hour_line(metric: Column, left: tuple[Column, Column], right: tuple[Column, Column]) -> Column:
    """Hour and trips must both agree: PASS, FAIL or PENDING."""
    return _ranked_line(
        metric,
        left,
        right,
        lambda hour, trips: hour_with_trips(hour.cast("int"), trips),
        HOUR_RULE,
        FAIL,
        {PENDING: "One side has no hourly result for this period."},
    )


def zone_line(metric: Column, left: tuple[Column, Column], right: tuple[Column, Column]) -> Column:
    """Zone and trips must both agree; a mismatch may be a tie, so REVIEW."""
    return _ranked_line(
        metric,
        left,
        right,
        name_with_trips,
        ZONE_RULE,
        REVIEW,
        {
            PENDING: "One side has no zone result for this period.",
            REVIEW: "Look at zone naming and tied zones.",
        },
    )


def band_line(band: Column, left: Column, right: Column, tolerance: float = TOLERANCE) -> Column:
    """Two mean fares within an absolute tolerance: PASS, FAIL or REVIEW."""
    a, b = left.cast("double"), right.cast("double")
    gap = F.abs(a - b)
    status = F.when(gap.isNull(), REVIEW).when(gap <= F.lit(tolerance), PASS).otherwise(FAIL)

    def text(value: Column) -> Column:
        return F.when(value.isNotNull(), F.format_string("%.6f", value))

    metric = F.concat(F.lit(BAND_METRIC), band)
    return _line(metric, text(a), text(b), text(gap), band_rule(tolerance), status, {})


def pending_bands_line(tolerance: float = TOLERANCE) -> Column:
    """The line for a band table that a side does not have."""
    nothing = F.lit(None).cast("string")
    hints = {PENDING: "One side has no distance-band result for this period."}
    return _line(
        F.lit(ALL_BANDS_METRIC), nothing, nothing, nothing, band_rule(tolerance), F.lit(PENDING), hints
    )


def compare_counts(left: DataFrame | None, right: DataFrame | None) -> DataFrame | None:
    """Exact comparison of counts keyed by metric: PASS, FAIL or PENDING."""
    both = _pair(left, right, ["valid_rows"])
    return both and counts_report(both)


def counts_report(both: DataFrame) -> DataFrame:
    """The same for counts already side by side: metric, left_valid_rows, right_valid_rows."""
    return _report(
        both, count_line(F.col("metric"), F.col("left_valid_rows"), F.col("right_valid_rows"))
    )


def _compare_ranked(left: DataFrame | None, right: DataFrame | None, line) -> DataFrame | None:
    both = _pair(left, right, ["name", "trips"])
    if both is None:
        return None
    sides = [(F.col(f"{side}_name"), F.col(f"{side}_trips")) for side in ("left", "right")]
    return _report(both, line(F.col("metric"), *sides))


def compare_hours(left: DataFrame | None, right: DataFrame | None) -> DataFrame | None:
    return _compare_ranked(left, right, hour_line)


def compare_zones(left: DataFrame | None, right: DataFrame | None) -> DataFrame | None:
    return _compare_ranked(left, right, zone_line)


def band_fares(bands: DataFrame) -> DataFrame:
    return resolve_required(bands, "distance_band", "avg_fare")


def compare_band_fares(
    left: DataFrame, right: DataFrame, tolerance: float = TOLERANCE
) -> DataFrame:
    """Mean fare per band within an absolute tolerance: PASS, FAIL or REVIEW."""
    sides = [
        band_fares(side).withColumnRenamed("avg_fare", f"{prefix}_avg_fare")
        for prefix, side in (("left", left), ("right", right))
    ]
    both = sides[0].join(sides[1], "distance_band", "full_outer")
    return _report(
        both, band_line(F.col("distance_band"), F.col("left_avg_fare"), F.col("right_avg_fare"), tolerance)
    )


def band_rule(tolerance: float = TOLERANCE) -> str:
    return BAND_RULE % tolerance


def pending_bands(known: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One PENDING line for the band table a side does not have."""
    return _report(known.sparkSession.range(0, 1, 1, 1), pending_bands_line(tolerance))


def reconcile(
    left: Side, right: Side, year: int, month: int, tolerance: float = TOLERANCE
) -> DataFrame:
    """The full report of one period, all values as text."""
    if left.bands is not None and right.bands is not None:
        bands = compare_band_fares(left.bands, right.bands, tolerance)
    else:
        known = next(
            table
            for side in (left, right)
            for table in (side.summary, side.monthly, side.hourly, side.zones, side.bands)
            if table is not None
        )
        bands = pending_bands(known, tolerance)
    parts = [
        compare_counts(side_valid_rows(left, year, month), side_valid_rows(right, year, month)),
        compare_hours(side_busiest_hour(left), side_busiest_hour(right)),
        compare_zones(side_top_zone(left), side_top_zone(right)),
        bands,
    ]
    present = [part for part in parts if part is not None]
    return reduce(DataFrame.unionByName, present).select(*REPORT_COLUMNS)
