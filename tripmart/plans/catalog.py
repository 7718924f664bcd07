"""Every operator as a query over the order-line trip view.

Each entry takes (spark, folder of Parquet tables) and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT
from tripmart.operators import (
    daytype,
    demand,
    fares,
    monthly,
    passengers,
    quality,
    reconcile,
    rollup,
    scale,
    series,
    sides,
    zones as zone_ops,
)
from tripmart.operators.cells import occupied, trip_cells
from tripmart.operators.prepare import in_period, picked_up_in, prepare, valid_trips
from tripmart.plans.trip_view import nation_zones, order_line_trips, zone_rows
from tripmart.sources import months
from tripmart.sources.trips import period_columns, typed_trips
from tripmart.sources.zones import dim_key_violations, zone_dimension

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = (1998, 1)
NO_PERIOD = (2010, 1)
#: The drop-off location that the other side of a reconciliation does not know.
UNKNOWN_ON_OTHER_SIDE = 24
#: Amounts have up to seven decimals, so sums rounded there are never near a tie.
SUM_DIGITS = 7


def rounded(table: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison with another engine's summation order."""
    return table.select(
        *[
            F.round(name, digits).alias(name) if dtype == "double" else F.col(name)
            for name, dtype in table.dtypes
        ]
    )


def _prepared(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(order_line_trips(spark, folder))


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    return trip_cells(_prepared(spark, folder))


def _by_year(value: str, table_of=lambda table: table) -> Query:
    """A monthly value with a column per year.

    The columns of a table are known before it runs, so a job finds the years first; it
    reads the ship dates alone, not the report.
    """

    def query(spark: SparkSession, folder: str) -> DataFrame:
        years = _observed_months(spark, folder).select("source_year").distinct().collect()
        table = table_of(_monthly(spark, folder))
        return rounded(series.month_by_year(table, value, sorted(row[0] for row in years)))

    return query


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    return monthly.monthly_comparison(trip_cells(_prepared(spark, folder)))


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    cells = quality.location_cells(_prepared(spark, folder))
    return quality.monthly_quality(cells, nation_zones(spark, folder))


def _of_period(spark: SparkSession, folder: str, period: tuple[int, int]) -> DataFrame:
    """Prepared trips of one period; only its ship dates are read."""
    return in_period(_of_periods(spark, folder, [period]), *period)


def _of_periods(
    spark: SparkSession, folder: str, periods: list[tuple[int, int]]
) -> DataFrame:
    """Prepared trips of some periods; only their ship dates are read."""
    spans = [
        (f"{year}-{month:02d}-01", f"{year + month // 12}-{month % 12 + 1:02d}-01")
        for year, month in periods
    ]
    return prepare(order_line_trips(spark, folder, spans))


# ---- sources and preparation -------------------------------------------------


def scan_trips(spark: SparkSession, folder: str) -> DataFrame:
    trips = typed_trips(order_line_trips(spark, folder))
    sums = [name for name in (*DEFAULT.measures, "cbd_congestion_fee")]
    return trips.groupBy("source_year", "source_month").agg(
        F.count("*").alias("raw_rows"),
        F.count("tpep_pickup_datetime").alias("pickups"),
        F.count("tpep_dropoff_datetime").alias("dropoffs"),
        *[F.sum(name).alias(name) for name in DEFAULT.ids],
        *[F.round(F.sum(name), SUM_DIGITS).alias(name) for name in sums],
        F.count("airport_fee").alias("airport_fee"),
    )


def source_period(spark: SparkSession, folder: str) -> DataFrame:
    trips = order_line_trips(spark, folder, located=False)
    names = trips.select(
        F.format_string(DEFAULT.period_file_name, "source_year", "source_month").alias("file_name")
    )
    # As the readers do: the period is parsed once a file, not once a row.
    files = names.groupBy("file_name").agg(F.count("*").alias("raw_rows"))
    year, month = period_columns(F.col("file_name"))
    periods = files.select(year.alias("source_year"), month.alias("source_month"), "raw_rows")
    return periods.groupBy("source_year", "source_month").agg(F.sum("raw_rows").alias("raw_rows"))


def _observed_months(spark: SparkSession, folder: str) -> DataFrame:
    trips = order_line_trips(spark, folder, located=False)
    return trips.select(*months.MONTH_KEYS).distinct()


def month_spine(spark: SparkSession, folder: str) -> DataFrame:
    return months.spine_between(months.calendar_year_bounds(_observed_months(spark, folder)))


def _never_null(table: DataFrame) -> DataFrame:
    """The table with month keys that the optimizer knows to be never null."""
    return table.withColumns({name: F.coalesce(name, F.lit(0)) for name in months.MONTH_KEYS})


def missing_months(spark: SparkSession, folder: str) -> DataFrame:
    """Spine and anti join read one exchange of months, so one scan.

    Months are never null; told so, the join adds no null test that would part the plans.
    """
    trips = order_line_trips(spark, folder, located=False)
    counted = trips.groupBy(*months.MONTH_KEYS).agg(F.count("*").alias("raw_rows"))
    # Every month passes; without its count the grouping would be dropped as needless.
    observed = _never_null(counted.filter("raw_rows > 0"))
    spine = months.spine_between(months.calendar_year_bounds(observed))
    return months.missing_months(spine, observed).select(spine.columns)


def zone_dim(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of each location among rows with planted repeats."""
    return zone_dimension(zone_rows(spark, folder, repeats=True), "row_order")


def zone_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated keys of the same rows before they are deduplicated."""
    return dim_key_violations(zone_dimension(zone_rows(spark, folder, repeats=True)))


def prepared_trips(spark: SparkSession, folder: str) -> DataFrame:
    shown = _prepared(spark, folder).select(
        "source_year",
        "source_month",
        "pickup_year",
        "pickup_month",
        F.date_format("pickup_date", "yyyy-MM-dd").alias("pickup_date"),
        "pickup_hour",
        "is_weekend",
        "trip_duration_minutes",
        "source_month_match",
        "valid_distance",
        "valid_fare",
        "structurally_valid",
    )
    return rounded(shown)


def _label_counts(value: str, label: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        trips = prepare(order_line_trips(spark, folder, located=False))
        counts = trips.groupBy(value, label)
        return counts.agg(F.count("*").alias("raw_rows"))

    return query


def structurally_valid(spark: SparkSession, folder: str) -> DataFrame:
    valid = valid_trips(_prepared(spark, folder))
    return valid.groupBy(
        "source_year",
        "source_month",
        F.date_format("pickup_date", "yyyy-MM-dd").alias("pickup_date"),
    ).agg(
        F.count("*").alias("trip_count"), *[F.sum(name).alias(name) for name in DEFAULT.ids]
    )


def zone_join(spark: SparkSession, folder: str) -> DataFrame:
    named = zone_ops.attach_zones(valid_trips(_prepared(spark, folder)), nation_zones(spark, folder))
    return named.select(
        "PULocationID",
        "pickup_Borough",
        "pickup_Zone",
        "pickup_service_zone",
        "DOLocationID",
        "pickup_hour",
    )


# ---- reports -----------------------------------------------------------------


def _on_cells(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(report(_cells(spark, folder)))


def _on_zones(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(
        report(_cells(spark, folder), nation_zones(spark, folder))
    )


def _on_monthly(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(report(_monthly(spark, folder)))


def common_metrics(spark: SparkSession, folder: str) -> DataFrame:
    cells = demand.metric_cells(_prepared(spark, folder))
    return demand.common_metrics(cells, nation_zones(spark, folder))


def period_common_metrics(spark: SparkSession, folder: str) -> DataFrame:
    cells = demand.metric_cells(_of_period(spark, folder, PERIOD))
    return demand.period_common_metrics(cells, nation_zones(spark, folder))


def period_distance_summary(spark: SparkSession, folder: str) -> DataFrame:
    trips = picked_up_in(_of_period(spark, folder, PERIOD), *PERIOD)
    return rounded(fares.period_distance_summary(trip_cells(trips)))


def _distance_summary(spark: SparkSession, folder: str) -> DataFrame:
    return fares.distance_fares_in_one_scan(_cells(spark, folder))


def band_median_fare(spark: SparkSession, folder: str) -> DataFrame:
    histogram = fares.fare_histogram(_cells(spark, folder), ["distance_band"])
    return rounded(fares.band_median_fare(histogram))


def band_median_fare_hist(spark: SparkSession, folder: str) -> DataFrame:
    """The median from monthly histograms merged afterwards."""
    by_month = rollup.fare_rollup(_cells(spark, folder))
    return rounded(fares.band_median_fare(fares.merge_histograms(by_month, ["distance_band"])))


def weekday_weekend_summary(spark: SparkSession, folder: str) -> DataFrame:
    grains = daytype.daytype_grains(_cells(spark, folder))
    return rounded(daytype.weekday_weekend_summary(grains, nation_zones(spark, folder)))


def top_zone_by_daytype(spark: SparkSession, folder: str) -> DataFrame:
    tops = zone_ops.top_zone_by_daytype(_cells(spark, folder), nation_zones(spark, folder))
    return tops.select(
        F.when(F.col("is_weekend"), DEFAULT.weekend_label)
        .otherwise(DEFAULT.weekday_label)
        .alias("day_type"),
        F.col("pickup_Borough").alias("top_pickup_borough"),
        F.col("pickup_Zone").alias("top_pickup_zone"),
        F.col("trip_count").alias("top_pickup_zone_trips"),
    )


def rollup_merge(spark: SparkSession, folder: str) -> DataFrame:
    by_month = rollup.category_cells(rollup.trip_rollup(_cells(spark, folder)))
    merged = occupied(rollup.merge_rollups(by_month, ["distance_band", "passenger_category"]))
    # Sums of quotients have no last decimal to be exact in.
    quotients = {name: F.round(name, 6) for name in ("per_mile_sum", "duration_sum")}
    return rounded(merged.withColumns(quotients), SUM_DIGITS)


def scale_sweep(spark: SparkSession, folder: str) -> DataFrame:
    cells = _never_null(scale.scale_cells(_prepared(spark, folder)))
    return scale.scale_sweep(
        cells,
        nation_zones(spark, folder),
        # From the cells' own months, by a test that all cells pass: it keeps their counts in
        # the plan of the spine, so that both read one exchange.
        months.spine_between(months.calendar_year_bounds(cells.filter("trip_count >= 0"))),
        label_format="%d-%02d",
        whole_span=True,
    )


# ---- reconciliation ----------------------------------------------------------


def _known_on_other_side() -> Column:
    return F.coalesce("DOLocationID", F.lit(-1)) != UNKNOWN_ON_OTHER_SIDE


def _two_sides(prepared: DataFrame) -> DataFrame:
    """All trips, and a side that does not know one drop-off location.

    A trip without a drop-off location is not valid.
    """
    valid = F.col("structurally_valid")
    return sides.side_cells(prepared, valid, valid & _known_on_other_side())


def period_select(spark: SparkSession, folder: str) -> DataFrame:
    """One period picked from a table in each of the three period layouts, in one scan."""
    numbers = F.split("month", "-")
    layouts = {
        "month text": {"month": F.col("month")},
        "pickup_year, pickup_month": {
            "pickup_year": numbers[0].cast("int"),
            "pickup_month": numbers[1].cast("int"),
        },
        "year, month": {"year": numbers[0], "month": numbers[1]},
    }
    picks = [
        F.when(reconcile.period_predicate(columns, *PERIOD), F.lit(name))
        for name, columns in layouts.items()
    ]
    return _quality(spark, folder).select(
        F.explode(F.array_compact(F.array(*picks))).alias("layout"),
        F.col("structurally_valid_rows").alias("valid_rows"),
    )


def resolve_columns(spark: SparkSession, folder: str) -> DataFrame:
    cells = _cells(spark, folder)
    hourly = demand.hourly_counts(cells).toDF("hour", "trips")
    zones = zone_ops.zone_demand(cells, nation_zones(spark, folder))
    parts = [
        ("hour", reconcile.resolve_required(hourly, "hour", "hour_trips")),
        ("zone", reconcile.resolve_required(zones, "zone", "zone_trips")),
    ]
    named = [
        table.toDF("name", "trips").select(
            F.lit(source).alias("source"), F.col("name").cast("string").alias("name"), "trips"
        )
        for source, table in parts
    ]
    return named[0].unionByName(named[1])


def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Valid rows of every month on both sides, counted in one scan."""
    valid = F.col("structurally_valid")
    metric = F.format_string("%d-%02d", "source_year", "source_month").alias("metric")
    both = prepare(order_line_trips(spark, folder)).groupBy(metric).agg(
        F.count_if(valid).alias("left_valid_rows"),
        F.count_if(valid & _known_on_other_side()).alias("right_valid_rows"),
    )
    return reconcile.counts_report(both)


def _both_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides' facts of a period with trips and of one without, on one row."""
    prepared = _of_periods(spark, folder, [PERIOD, NO_PERIOD])
    facts = sides.side_facts(_two_sides(prepared), nation_zones(spark, folder))
    return sides.on_one_row(facts, [PERIOD, NO_PERIOD])


def _against_both(line) -> Query:
    """Left against right, and left against a period the right does not have."""
    return lambda spark, folder: sides.lines_of(
        _both_periods(spark, folder), line(PERIOD, PERIOD), line(PERIOD, NO_PERIOD)
    )


def reconcile_band_fares(spark: SparkSession, folder: str) -> DataFrame:
    row = _both_periods(spark, folder)
    return row.select(F.inline(sides.band_lines(PERIOD)))


def reconcile_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """A summary against detail tables; both sides come from one exchange of cells."""
    cells = _two_sides(_of_periods(spark, folder, [PERIOD]))
    zones = nation_zones(spark, folder)
    summary = sides.side_facts(cells, zones).select(
        F.col("left_rows").alias("valid_rows"),
        F.col("left_hour.pickup_hour").alias("busiest_pickup_hour"),
        (-F.col("left_hour.order")).alias("busiest_pickup_hour_trips"),
        F.col("left_zone.pickup_Zone").alias("top_pickup_zone"),
        (-F.col("left_zone.order")).alias("top_pickup_zone_trips"),
    )
    own = cells.withColumnRenamed("right_trips", "trip_count")
    numbers = F.split("period", "-")
    monthly_rows = own.groupBy(
        numbers[0].cast("int").alias("pickup_year"), numbers[1].cast("int").alias("pickup_month")
    ).agg(F.sum("trip_count").alias("valid_rows"))
    details = reconcile.Side(
        monthly=monthly_rows,
        hourly=demand.hourly_counts(own).toDF("hour", "trips"),
        zones=zone_ops.zone_demand(own, zones).toDF("pickup_Borough", "Zone", "trips"),
    )
    return reconcile.reconcile(reconcile.Side(summary=summary), details, *PERIOD).filter(
        ~F.col("metric").startswith("Average fare")
    )


def reconcile_report(spark: SparkSession, folder: str) -> DataFrame:
    """The whole report for a period both sides have and one neither has, in one scan."""
    prepared = _of_periods(spark, folder, [PERIOD, NO_PERIOD])
    valid = F.col("structurally_valid")
    return sides.reconcile_trips(
        prepared,
        nation_zones(spark, folder),
        valid,
        valid & _known_on_other_side(),
        [PERIOD, NO_PERIOD],
    )


QUERIES: dict[str, Query] = {
    "scan_trips": scan_trips,
    "source_period": source_period,
    "month_spine": month_spine,
    "missing_months": missing_months,
    "zone_dim": zone_dim,
    "dim_key_violations": zone_violations,
    "prepared_trips": prepared_trips,
    "distance_band": _label_counts("trip_distance", "distance_band"),
    "passenger_category": _label_counts("passenger_count", "passenger_category"),
    "structurally_valid": structurally_valid,
    "zone_join": zone_join,
    "monthly_quality": _quality,
    "period_totals": lambda spark, folder: quality.period_totals(_quality(spark, folder)),
    "hourly_demand": _on_cells(demand.hourly_demand),
    "busiest_hour": _on_cells(demand.busiest_hour),
    "zone_demand": _on_zones(zone_ops.zone_demand),
    "top_zones": _on_zones(
        lambda cells, zones: zone_ops.top_zones(cells, zones, DEFAULT.top_zone_rows)
    ),
    "top_zone": _on_zones(lambda cells, zones: zone_ops.top_zones(cells, zones, 1)),
    "zone_demand_by_id": _on_zones(zone_ops.zone_demand_by_id),
    "top_zone_by_id": _on_zones(zone_ops.top_zone_by_id),
    "common_metrics": common_metrics,
    "period_common_metrics": period_common_metrics,
    "period_distance_summary": period_distance_summary,
    "distance_fare_summary": lambda spark, folder: rounded(_distance_summary(spark, folder)),
    "band_median_fare": band_median_fare,
    "band_median_fare_hist": band_median_fare_hist,
    "passenger_summary": _on_cells(
        lambda cells: series.passenger_distribution(passengers.passenger_summary(cells))
    ),
    "single_vs_multiple": _on_cells(passengers.single_vs_multiple),
    "daily_demand": _on_cells(daytype.daily_demand),
    "weekday_weekend_hourly": _on_cells(daytype.weekday_weekend_hourly),
    "weekday_weekend_metrics": _on_cells(daytype.weekday_weekend_metrics),
    "weekday_weekend_summary": weekday_weekend_summary,
    "peak_hour_by_daytype": _on_cells(daytype.peak_hour_by_daytype),
    "top_zone_by_daytype": top_zone_by_daytype,
    "monthly_demand": _on_monthly(monthly.monthly_demand),
    "monthly_comparison": _on_monthly(lambda table: table),
    "monthly_cbd_fee": _on_monthly(monthly.monthly_cbd_fee),
    "monthly_avg_daily": _on_monthly(monthly.with_daily_average),
    "year_summary": _on_monthly(monthly.year_summary),
    "rollup_merge": rollup_merge,
    "scale_sweep": scale_sweep,
    "period_select": period_select,
    "resolve_columns": resolve_columns,
    "reconcile_counts": reconcile_counts,
    "reconcile_hour": _against_both(sides.busiest_line),
    "reconcile_zone": _against_both(sides.top_line),
    "reconcile_band_fares": reconcile_band_fares,
    "reconcile_fallback": reconcile_fallback,
    "reconcile_report": reconcile_report,
    "series_band_fares": lambda spark, folder: rounded(
        series.band_fares(_distance_summary(spark, folder))
    ),
    "series_daytype_hourly": _on_cells(
        lambda cells: series.daytype_hourly(daytype.weekday_weekend_hourly(cells))
    ),
    "series_month_volume": _by_year("trip_count"),
    "series_month_avg_daily": _by_year("avg_daily_trips", monthly.with_daily_average),
    "series_month_fare": _by_year("avg_valid_fare_amount"),
    "series_cbd_share": _on_monthly(series.cbd_share),
    "series_scale": lambda spark, folder: series.successful_scales(scale_sweep(spark, folder)),
}
