"""Merged monthly rollups equal direct aggregation, whatever the row layout."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.rows import rows_of, trips
from tripmart.operators import rollup
from tripmart.operators.cells import STATES, merge_cells, occupied, trip_cells
from tripmart.operators.prepare import prepare
from tripmart.plans import catalog, report
from tripmart.plans.trip_view import nation_zones, order_line_trips
from tripmart.sources.months import month_spine
from tripmart.sources.tables import read_table

FOLDER = "/root/testdata/sf0.001"


def same(left, right, keys):
    def keyed(table):
        return {tuple(row[key] for key in keys): row for row in rows_of(table)}

    a, b = keyed(left), keyed(right)
    assert a.keys() == b.keys()
    for key, row in a.items():
        for name, value in row.items():
            if isinstance(value, float):
                assert value == pytest.approx(b[key][name], rel=1e-9), (key, name)
            else:
                assert value == b[key][name], (key, name)


change = st.fixed_dictionaries(
    {
        "source_month": st.sampled_from([1, 1, 2]),
        "PULocationID": st.sampled_from([1, 2, None]),
        "passenger_count": st.sampled_from([None, 1.0, 2.0, 8.0]),
        "trip_distance": st.sampled_from([None, -1.0, 0.5, 3.0, 30.0]),
        "fare_amount": st.sampled_from([None, float("nan"), -3.0, 4.5, 60.0]),
    }
)


@settings(max_examples=8, deadline=None)
@given(changes=st.lists(change, min_size=1, max_size=25), seed=st.integers(0, 99))
def test_rollups_merge_to_direct_results(spark, changes, seed):
    cells = trip_cells(prepare(trips(spark, *changes)))
    shuffled = list(changes)
    random.Random(seed).shuffle(shuffled)
    other = trip_cells(prepare(trips(spark, *shuffled).repartition(3)))
    rolled = rollup.trip_rollup(other)
    for part, keys in (
        (rollup.category_cells(rolled), ["distance_band"]),
        (rollup.category_cells(rolled), ["passenger_category"]),
        (rollup.day_cells(rolled), ["is_weekend", "pickup_hour"]),
    ):
        same(
            occupied(merge_cells(cells, keys, STATES)),
            occupied(rollup.merge_rollups(part, keys)),
            keys,
        )


def test_report_from_rollups_equals_direct_queries(spark, tmp_path):
    zones = nation_zones(spark, FOLDER)
    months = month_spine(spark, (1995, 1), (2001, 11))
    report.build_report(
        spark, order_line_trips(spark, FOLDER), zones, str(tmp_path), months, catalog.PERIOD
    )
    pairs = {
        "common_metrics": ("common_metrics", ["source_period"]),
        "monthly_quality": ("monthly_quality", ["month"]),
        "monthly_trip_demand": ("monthly_demand", ["pickup_year", "pickup_month"]),
        "hourly_demand": ("hourly_demand", ["pickup_hour"]),
        "top_pickup_zones": ("top_zones", ["pickup_Borough", "pickup_Zone"]),
        "distance_fare_summary": ("distance_fare_summary", ["distance_band"]),
        "passenger_count_summary": ("passenger_summary", ["passenger_category"]),
        "passenger_single_multiple_summary": ("single_vs_multiple", ["passenger_group"]),
        "weekday_weekend_summary": ("weekday_weekend_summary", ["day_type"]),
        "weekday_weekend_hourly": ("weekday_weekend_hourly", ["day_type", "pickup_hour"]),
        "monthly_year_comparison": ("monthly_comparison", ["pickup_year", "pickup_month"]),
        "year_comparison_summary": ("year_summary", ["pickup_year"]),
    }
    for table, (query, keys) in pairs.items():
        direct = catalog.QUERIES[query](spark, FOLDER)
        written = read_table(spark, f"{tmp_path}/tables/{table}", direct.schema)
        same(direct, catalog.rounded(written), keys)
    for table, query in (
        ("common_metrics", "period_common_metrics"),
        ("distance_fare_summary", "period_distance_summary"),
    ):
        direct = catalog.QUERIES[query](spark, FOLDER)
        written = read_table(spark, f"{tmp_path}/slice-1998-01/{table}", direct.schema)
        same(direct, catalog.rounded(written), direct.columns[:1])


def test_rewriting_one_month_keeps_the_others(spark, tmp_path):
    path = f"{tmp_path}/rollups"
    january = trips(spark, {}, {})
    february = trips(spark, {"source_month": 2})
    report.write_rollups([january, february], path)
    report.write_rollups(trips(spark, {}, {}, {}), path)
    location = report.read_rollups(spark, path)["location"]
    counts = {
        row["source_month"]: row["raw_rows"]
        for row in rows_of(merge_cells(location, ["source_month"], ["raw_rows"]))
    }
    assert counts == {1: 3, 2: 1}


def test_periods_between():
    assert report.periods_between((2024, 11), (2025, 2)) == [
        (2024, 11), (2024, 12), (2025, 1), (2025, 2),
    ]
    assert report.periods_between((2024, 12), (2024, 12)) == [(2024, 12)]
