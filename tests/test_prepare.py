import pytest
from pyspark.sql import functions as F

from tests.rows import column, rows_of, trips
from tripmart.functions.buckets import distance_band, passenger_category
from tripmart.operators.cells import mean, merge_cells, trip_cells
from tripmart.operators.prepare import in_period, picked_up_in, prepare, valid_trips
from tripmart.sources.trips import ContractError


def test_unparseable_text_becomes_null(spark):
    types = {
        "tpep_pickup_datetime": "string",
        "trip_distance": "string",
        "PULocationID": "string",
    }
    table = trips(
        spark,
        {"tpep_pickup_datetime": "bad", "trip_distance": "x", "PULocationID": "y"},
        {"trip_distance": " 2.5 ", "PULocationID": "12.7"},
        types=types,
    )
    bad, good = rows_of(prepare(table).select("pickup_ts", "trip_distance", "PULocationID"))
    assert bad == {"pickup_ts": None, "trip_distance": None, "PULocationID": None}
    assert (good["trip_distance"], good["PULocationID"]) == (2.5, 12)


def test_nan_is_missing(spark):
    nan = float("nan")
    table = trips(spark, {"trip_distance": nan, "fare_amount": nan}, {"fare_amount": 8.0})
    prepared = prepare(table)
    first = rows_of(prepared)[0]
    assert first["distance_band"] == "Invalid/Non-positive"
    assert first["valid_fare"] is False and first["valid_distance"] is False
    total = merge_cells(trip_cells(prepared), ["source_year"]).select(mean("fare").alias("fare"))
    assert column(total, "fare") == [8.0]


def test_distance_band_edges(spark):
    edges = [-1.0, 0.0, 0.01, 1.99, 2.0, 4.99, 5.0, 9.99, 10.0, 19.99, 20.0, None]
    table = spark.createDataFrame([(edge,) for edge in edges], "d double")
    none, a, b, c, d = "Invalid/Non-positive", "0-<2", "2-<5", "5-<10", "10-<20"
    expected = [none, none, a, a, b, b, c, c, d, d, "20+", none]
    assert column(table.select(distance_band(F.col("d")).alias("b")), "b") == expected


def test_passenger_categories(spark):
    counts = [None, -1.0, 0.0, 1.0, 1.5, 6.0, 7.0, 9.0]
    table = spark.createDataFrame([(count,) for count in counts], "p double")
    expected = ["Missing", "7+", "0", "1", "7+", "6", "7+", "7+"]
    assert column(table.select(passenger_category(F.col("p")).alias("c")), "c") == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_duration_is_wall_clock_and_inclusive(spark, zone):
    start = "2024-01-08 10:00:00"
    ends = [start, "2024-01-08 10:00:01", "2024-01-08 14:00:00", "2024-01-08 14:00:01",
            "2024-01-08 09:59:59", "2024-01-08 10:00:00.5"]
    over_clock_change = {
        "source_month": 3,
        "tpep_pickup_datetime": "2024-03-10 01:30:00",
        "tpep_dropoff_datetime": "2024-03-10 03:30:00",
    }
    table = trips(spark, *[{"tpep_dropoff_datetime": end} for end in ends], over_clock_change)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        prepared = prepare(table)
        assert column(prepared, "structurally_valid") == [
            False, True, True, False, False, True, True,
        ]
        minutes = column(prepared, "trip_duration_minutes")
        assert minutes[1] == pytest.approx(1 / 60)
        assert minutes[2] == 240.0
        assert minutes[5] == pytest.approx(0.5 / 60)
        assert minutes[6] == 120.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_weekend_days(spark):
    days = ["2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08"]
    table = trips(spark, *[{"tpep_pickup_datetime": f"{day} 10:00:00"} for day in days])
    assert column(prepare(table), "is_weekend") == [False, True, True, False]


def test_rows_outside_their_file_month_are_removed(spark):
    late = {
        "tpep_pickup_datetime": "2024-02-01 00:00:00",
        "tpep_dropoff_datetime": "2024-02-01 00:10:00",
    }
    other_year = {
        "tpep_pickup_datetime": "2023-01-08 10:00:00",
        "tpep_dropoff_datetime": "2023-01-08 10:10:00",
    }
    prepared = prepare(trips(spark, late, other_year, {}))
    assert column(prepared, "source_month_match") == [False, False, True]
    assert valid_trips(prepared).count() == 1


def test_missing_parts_are_invalid_and_never_null(spark):
    table = trips(
        spark,
        {"tpep_pickup_datetime": None},
        {"tpep_dropoff_datetime": None},
        {"PULocationID": None},
        {"DOLocationID": None},
        {"fare_amount": -5.0, "trip_distance": 0.0},
    )
    assert column(prepare(table), "structurally_valid") == [False, False, False, False, True]


def test_period_filters(spark):
    prepared = prepare(trips(spark, {}, {"source_month": 2}))
    assert in_period(prepared, 2024, 1).count() == 1
    assert picked_up_in(prepared, 2024, 2).count() == 0
    assert picked_up_in(prepared, 2024, 1).count() == 1


def test_required_column_must_exist(spark):
    with pytest.raises(ContractError, match="fare_amount"):
        prepare(trips(spark, {}).drop("fare_amount"))
    assert prepare(trips(spark, {}).drop("airport_fee")).count() == 1
