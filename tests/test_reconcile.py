import pytest

from tests.rows import column, rows_of
from tripmart.operators.reconcile import (
    Side,
    compare_band_fares,
    compare_counts,
    compare_hours,
    compare_zones,
    find_column,
    period_rows,
    reconcile,
    resolve,
    resolve_required,
    side_busiest_hour,
    side_top_zone,
    side_valid_rows,
)
from tripmart.sources.trips import ContractError

SUMMARY = (
    "valid_rows bigint, busiest_pickup_hour int, busiest_pickup_hour_trips bigint,"
    " top_pickup_zone string, top_pickup_zone_trips bigint"
)


@pytest.fixture
def summary(spark):
    return spark.createDataFrame([(1234567, 8, 1200, "Corona", 1000)], SUMMARY)


@pytest.fixture
def bands(spark):
    return spark.createDataFrame(
        [("0-<2", 10.0), ("2-<5", 20.0), ("5-<10", None)], "distance_band string, avg_fare double"
    )


def statuses(table):
    return {row["metric"]: row["status"] for row in rows_of(table)}


def test_a_result_set_agrees_with_itself(spark, summary, bands):
    side = Side(summary=summary, bands=bands.na.drop())
    report = reconcile(side, side, 2024, 1)
    assert set(column(report, "status")) == {"PASS"}
    shown = {row["metric"]: row for row in rows_of(report)}
    assert shown["Busiest pickup hour"]["left_result"] == "08:00 (1,200 trips)"
    assert shown["Top pickup zone"]["right_result"] == "Corona (1,000 trips)"
    assert shown["Structurally valid rows"]["difference"] == "0"
    assert shown["Average fare - 0-<2"]["left_result"] == "10.000000"


def test_differences(spark, summary):
    other = spark.createDataFrame([(1234560, 8, 1199, "Norwood", 1000)], SUMMARY)
    left, right = Side(summary=summary), Side(summary=other)
    report = reconcile(left, right, 2024, 1)
    assert statuses(report) == {
        "Structurally valid rows": "FAIL",
        "Busiest pickup hour": "FAIL",
        "Top pickup zone": "REVIEW",
        "Average fare by distance band": "PENDING",
    }
    count = next(r for r in rows_of(report) if r["metric"] == "Structurally valid rows")
    assert (count["difference"], count["explanation"] != "") == ("-7", True)


def test_a_missing_side_is_pending(spark, summary):
    known = Side(summary=summary)
    report = reconcile(Side(), known, 2024, 1)
    assert set(column(report, "status")) == {"PENDING"}
    assert set(column(report, "left_result")) == {"N/A"}
    empty = Side(summary=summary.limit(0))
    assert set(column(reconcile(known, empty, 2024, 1), "status")) == {"PENDING"}
    assert compare_counts(None, None) is None


def test_band_tolerance(spark, bands):
    other = spark.createDataFrame(
        [("0-<2", 10.01), ("2-<5", 20.02), ("5-<10", 30.0), ("20+", 50.0)],
        "band string, average_fare double",
    )
    result = statuses(compare_band_fares(bands, other))
    assert result["Average fare - 2-<5"] == "FAIL"
    assert result["Average fare - 5-<10"] == "REVIEW"
    assert result["Average fare - 20+"] == "REVIEW"
    # 10.01 - 10.0 is a hair below 0.01 in binary.
    assert result["Average fare - 0-<2"] == "PASS"
    with pytest.raises(ContractError):
        compare_band_fares(bands, bands.drop("avg_fare"))


def test_fallback_to_detail_tables(spark):
    side = Side(
        monthly=spark.createDataFrame([("2024-01", 5), ("2024-02", 9)],
                                      "month string, structurally_valid_rows bigint"),
        hourly=spark.createDataFrame([(9, 4), (7, 4), (8, 1)], "hour int, trips bigint"),
        zones=spark.createDataFrame([("b", 4), ("a", 4), ("c", 1)], "Zone string, trips bigint"),
    )
    assert column(side_valid_rows(side, 2024, 2), "valid_rows") == [9]
    assert [tuple(r) for r in side_busiest_hour(side).select("name", "trips").collect()] == [(7, 4)]
    assert [tuple(r) for r in side_top_zone(side).select("name", "trips").collect()] == [("a", 4)]
    assert side_valid_rows(side, 2023, 2).count() == 0
    # A partial summary falls back as a whole.
    partial = Side(
        summary=spark.createDataFrame([(3,)], "busiest_pickup_hour int"), hourly=side.hourly
    )
    assert column(side_busiest_hour(partial), "name") == [7]
    hours = side_busiest_hour(side)
    assert statuses(compare_hours(hours, hours)) == {"Busiest pickup hour": "PASS"}
    zones = side_top_zone(side)
    assert statuses(compare_zones(zones, zones)) == {"Top pickup zone": "PASS"}


def test_summary_trip_count_is_not_a_zone_count(spark):
    table = spark.createDataFrame([("Corona", 7)], "top_pickup_zone string, trip_count bigint")
    assert side_top_zone(Side(summary=table)) is None


def test_column_aliases(spark):
    table = spark.createDataFrame([(1, 2, 3)], "hour int, trips int, total_trips int")
    assert find_column(table, "hour_trips") == "trips"
    assert resolve(table, "hour", "zone") is None
    assert resolve_required(table, "hour", "hour_trips").columns == ["hour", "hour_trips"]
    with pytest.raises(ContractError, match="pickup_Zone/pickup_zone/Zone"):
        resolve_required(table, "zone")


def test_period_layouts(spark):
    text = spark.createDataFrame([(" 2024-01 ", 1), ("2024-10", 2)], "month string, n int")
    pair = spark.createDataFrame([("2024", "1", 3), ("x", "1", 4)],
                                 "pickup_year string, pickup_month string, n int")
    plain = spark.createDataFrame([(2024, 1, 5), (2024, 2, 6)], "year int, month int, n int")
    none = spark.createDataFrame([(7,)], "n int")
    picked = [column(period_rows(t, 2024, 1), "n") for t in (text, pair, plain, none)]
    assert picked == [[1], [3], [5], []]
