import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tests.rows import column, rows_of, trips, zones
from tripmart.contract import DEFAULT
from tripmart.operators import daytype, demand, fares, passengers, quality, series
from tripmart.operators import zones as zone_ops
from tripmart.operators.cells import trip_cells
from tripmart.operators.prepare import prepare
from tripmart.sources.months import month_spine

NAMES = [(1, "Queens", "Corona"), (2, "Queens", "Corona"), (3, "Bronx", "Norwood"),
         (264, "Unknown", None), (265, None, "Outside")]


def cells_of(spark, *changes):
    return trip_cells(prepare(trips(spark, *changes)))


def hour(h, **more):
    return {
        "tpep_pickup_datetime": f"2024-01-08 {h:02d}:00:00",
        "tpep_dropoff_datetime": f"2024-01-08 {h:02d}:10:00",
        **more,
    }


def test_quality_counters(spark):
    table = trips(
        spark,
        {"tpep_pickup_datetime": None},
        {"tpep_dropoff_datetime": "2024-01-08 10:00:00"},
        {"tpep_dropoff_datetime": "2024-01-08 15:00:00"},
        {"trip_distance": None, "fare_amount": None, "passenger_count": None},
        {"PULocationID": None},
        {"DOLocationID": None},
        {"PULocationID": 264},
        {"PULocationID": 265},
        {"PULocationID": 999},
        {"tpep_pickup_datetime": "2024-02-08 10:00:00", "tpep_dropoff_datetime": None},
        {"source_month": 2},
    )
    cells = quality.location_cells(prepare(table))
    months = month_spine(spark, (2024, 1), (2024, 3))
    january, february, march = rows_of(
        quality.monthly_quality(cells, zones(spark, *NAMES), months)
    )
    assert january == {
        "month": "2024-01",
        "raw_rows": 10,
        "null_pickup_timestamp": 1,
        "null_dropoff_timestamp": 1,
        "dropoff_not_after_pickup": 1,
        "duration_nonpositive": 1,
        "duration_over_240": 1,
        "source_month_mismatch": 1,
        "null_PULocationID": 1,
        "null_DOLocationID": 1,
        "nonpositive_distance": 1,
        "nonpositive_fare": 1,
        "missing_passenger_count": 1,
        "structurally_valid_rows": 4,
        "structurally_removed_rows": 6,
        "unmatched_pickup_lookup": 2,
    }
    # A month of invalid rows only, and a month without any row.
    assert (february["raw_rows"], february["structurally_valid_rows"]) == (1, 0)
    assert (march["month"], march["raw_rows"]) == ("2024-03", 0)
    totals = quality.period_totals(quality.monthly_quality(cells, zones(spark, *NAMES)))
    assert rows_of(totals) == [{"months_processed": 2, "raw_rows": 11, "valid_rows": 4}]


def test_zone_names_merge_and_nameless_zones_drop(spark):
    ids = [1, 2, 3, 264, 265, 265, 265, 999]
    cells = cells_of(spark, *[{"PULocationID": i} for i in ids])
    table = zones(spark, *NAMES)
    top = zone_ops.top_zones(cells, table, 20)
    assert [tuple(row) for row in top.collect()] == [("Queens", "Corona", 2), ("Bronx", "Norwood", 1)]
    # By location: no merging, and a zone without a borough competes.
    by_id = {row["PULocationID"]: row["trip_count"] for row in
             rows_of(zone_ops.zone_demand_by_id(cells, table))}
    assert by_id == {1: 1, 2: 1, 3: 1, 265: 3}
    assert column(zone_ops.top_zone_by_id(cells, table), "PULocationID") == [265]


def test_ties(spark):
    cells = cells_of(spark, hour(9, PULocationID=1), hour(7, PULocationID=3))
    assert [tuple(r) for r in demand.busiest_hour(cells).collect()] == [(7, 1)]
    table = zones(spark, (1, "B", "a"), (3, "A", "z"))
    assert column(zone_ops.top_zones(cells, table, 1), "pickup_Zone") == ["z"]
    peak = daytype.peak_hour_by_daytype(cells)
    assert [tuple(r) for r in peak.collect()] == [("Weekday", 7, 1)]
    # On equal trips a zone without borough comes last by location.
    unnamed = zones(spark, (1, None, "a"), (3, "A", "z"))
    assert column(zone_ops.top_zone_by_id(cells, unnamed), "PULocationID") == [3]


def test_common_metrics(spark):
    prepared = prepare(
        trips(spark, hour(9), hour(9), hour(7), {"source_month": 2}, hour(5, PULocationID=None))
    )
    cells = demand.metric_cells(prepared)
    result = rows_of(demand.common_metrics(cells, zones(spark, *NAMES)))
    assert result == [
        {
            "source_period": "2024-01_to_2024-02",
            "months_processed": 2,
            "raw_rows": 5,
            "valid_rows": 3,
            "busiest_pickup_hour": 9,
            "busiest_pickup_hour_trips": 2,
            "top_pickup_borough": "Queens",
            "top_pickup_zone": "Corona",
            "top_pickup_zone_trips": 3,
        }
    ]
    nothing = demand.period_common_metrics(
        demand.metric_cells(prepared.limit(0)), zones(spark, *NAMES)
    )
    assert set(rows_of(nothing)[0].values()) <= {None, ""}


def test_every_category_is_reported(spark):
    cells = cells_of(spark, {"passenger_count": 2.0})
    bands = rows_of(fares.distance_fare_summary(cells, fares.fare_histogram(cells, ["distance_band"])))
    assert [row["distance_band"] for row in bands] == list(DEFAULT.band_labels)
    assert [row["trip_count"] for row in bands] == [0, 1, 0, 0, 0, 0]
    assert bands[0]["avg_valid_fare_amount"] is None
    assert bands[1]["avg_fare_per_mile"] == 4.0
    categories = rows_of(passengers.passenger_summary(cells))
    assert [row["passenger_category"] for row in categories] == list(DEFAULT.passenger_labels)
    assert [row["share_pct"] for row in categories] == [0, 0, 0, 100, 0, 0, 0, 0, 0]
    groups = rows_of(passengers.single_vs_multiple(cells))
    assert [(row["trip_count"], row["share_of_valid_1_to_6_pct"]) for row in groups] == [
        (0, 0.0), (1, 100.0),
    ]
    weekday, weekend = rows_of(daytype.weekday_weekend_metrics(cells))
    assert (weekday["trip_count"], weekend["trip_count"]) == (1, 0)
    real = series.band_fares(fares.period_distance_summary(cells))
    assert column(real, "distance_band") == ["0-<2", "2-<5", "5-<10", "10-<20", "20+"]


def test_nothing_valid(spark):
    cells = cells_of(spark, {"source_month": 2})
    table = zones(spark, *NAMES)
    assert column(passengers.passenger_summary(cells), "share_pct") == [None] * 9
    assert demand.hourly_demand(cells).count() == 0
    assert zone_ops.top_zones(cells, table, 5).count() == 0
    summary = rows_of(daytype.weekday_weekend_summary(daytype.daytype_grains(cells), table))
    assert [(row["day_type"], row["trip_count"], row["number_of_days"], row["peak_hour"])
            for row in summary] == [("Weekday", 0, 0, None), ("Weekend", 0, 0, None)]


def test_group_means_merge_sums(spark):
    """Two categories with different counts: not the mean of their means."""
    cells = cells_of(
        spark,
        {"passenger_count": 2.0, "fare_amount": 10.0},
        {"passenger_count": 2.0, "fare_amount": 10.0},
        {"passenger_count": 3.0, "fare_amount": 40.0},
        {"passenger_count": 3.0, "fare_amount": -1.0},
    )
    many = rows_of(passengers.single_vs_multiple(cells))[1]
    assert (many["trip_count"], many["avg_valid_fare_amount"]) == (4, 20.0)


def test_fare_per_mile_skips_non_finite(spark):
    inf = float("inf")
    cells = cells_of(
        spark,
        {"fare_amount": inf},
        {"fare_amount": 6.0},
        {"fare_amount": 5.0, "trip_distance": 5e-324},
        {"fare_amount": 6.0, "trip_distance": 0.0},
    )
    rows = rows_of(fares.distance_fare_summary(cells, fares.fare_histogram(cells, ["distance_band"])))
    by_band = {row["distance_band"]: row for row in rows}
    assert by_band["2-<5"]["avg_fare_per_mile"] == 2.0
    assert by_band["2-<5"]["avg_valid_fare_amount"] == inf
    assert by_band["0-<2"]["avg_fare_per_mile"] is None
    assert by_band["Invalid/Non-positive"]["avg_fare_per_mile"] is None


def test_day_type_tables(spark):
    day = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    stamps = ["2024-01-08 10", "2024-01-08 11", "2024-01-08 11", "2024-01-09 10", "2024-01-09 11",
              "2024-01-06 23"]
    cells = cells_of(
        spark, *[dict(zip(day, (f"{s}:00:00", f"{s}:20:00"), strict=True)) for s in stamps]
    )
    hourly = [tuple(row) for row in daytype.weekday_weekend_hourly(cells).collect()]
    assert hourly == [
        ("Weekday", 10, 2, 2, 1.0), ("Weekday", 11, 3, 2, 1.5), ("Weekend", 23, 1, 1, 1.0),
    ]
    daily = [tuple(row) for row in daytype.daily_demand(cells).collect()]
    assert daily == [
        ("Weekend", "2024-01-06", 1), ("Weekday", "2024-01-08", 3), ("Weekday", "2024-01-09", 2),
    ]
    summary = rows_of(
        daytype.weekday_weekend_summary(daytype.daytype_grains(cells), zones(spark, *NAMES))
    )
    weekday = summary[0]
    assert weekday["trip_count"] == 5 and weekday["number_of_days"] == 2
    assert weekday["avg_daily_trips"] == 2.5
    assert (weekday["peak_hour"], weekday["peak_hour_total_trips"]) == (11, 3)
    assert weekday["peak_hour_avg_daily_trips"] == 1.5
    assert (weekday["top_pickup_zone"], weekday["top_pickup_zone_trips"]) == ("Corona", 5)
    wide = rows_of(series.daytype_hourly(daytype.weekday_weekend_hourly(cells)))
    assert wide[-1] == {"pickup_hour": 23, "Weekday": None, "Weekend": 1.0}


def test_median_of_even_and_odd_counts(spark):
    table = spark.createDataFrame(
        [("odd", v, 1) for v in (1.0, 7.0, 2.0)] + [("even", v, 1) for v in (1.0, 2.0, 4.0, 100.0)]
        + [("hot", 5.0, 1000), ("hot", 0.01, 3), ("hot", 900.0, 2)],
        "k string, v double, n bigint",
    )
    medians = {r["k"]: r["median"] for r in rows_of(fares.weighted_median(table, "k", "v", "n"))}
    assert medians == {"odd": 2.0, "even": 3.0, "hot": 5.0}


@settings(max_examples=12, deadline=None)
@given(
    values=st.lists(
        st.one_of(
            st.floats(min_value=1e-3, max_value=1e6),
            st.integers(1, 9).map(float),
            st.floats(min_value=9.99, max_value=10.01),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_median_equals_brute_force(spark, values):
    rows = [("k", value) for value in values]
    histogram = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").count()
    result = fares.weighted_median(histogram, "k", "v", "count").collect()
    assert result[0]["median"] == pytest.approx(statistics.median(values), rel=1e-15)


def test_median_of_values_close_together(spark):
    """A million distinct values between two powers of two, apart in their last bits only."""
    ids = spark.range(1_000_001).select(
        F.lit("near").alias("k"), (F.lit(8.0) + F.col("id") * F.lit(2.0**-48)).alias("v"), F.lit(1).alias("n")
    )
    plan = fares.weighted_median(ids, "k", "v", "n")
    assert plan.collect()[0]["median"] == 8.0 + 500_000 * 2.0**-48
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "percentile" not in text


def test_median_of_extreme_values(spark):
    values = [5e-324, 2.2250738585072014e-308, 0.1, 1.0, 2.0 - 2**-52, 2.0, 1e300, 1.7976931348623157e308]
    for kept in (values, values[1:], values[:5], [*values, float("inf")]):
        table = spark.createDataFrame([("k", v, 1) for v in kept], "k string, v double, n int")
        assert fares.weighted_median(table, "k", "v", "n").collect()[0]["median"] == statistics.median(kept)


def test_summary_from_one_aggregate_equals_that_from_two(spark):
    table = trips(
        spark, {}, {"fare_amount": -2.0}, {"fare_amount": 3.5, "trip_distance": 1.0},
        {"trip_distance": None, "fare_amount": None}, {"trip_distance": 30.0, "fare_amount": None},
        {"DOLocationID": None}, {"fare_amount": 12.0, "total_amount": None},
    )
    cells = trip_cells(prepare(table))
    one = rows_of(fares.distance_fares_in_one_scan(cells))
    assert one == rows_of(fares.distance_fare_summary(cells, fares.fare_histogram(cells, ["distance_band"])))
    assert [(r["trip_count"], r["median_valid_fare_amount"]) for r in one] == [
        (1, 3.5), (3, 12.0), (0, None), (0, None), (1, None), (1, None),
    ]
