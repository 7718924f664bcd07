"""Month ranges, empty months, instants under other zones, and repeated values."""

from datetime import datetime

import pytest

from tests.rows import rows_of, trips, zones
from tripmart.functions.clean import as_wall_clock
from tripmart.operators import fares, reconcile, scale, series
from tripmart.operators.cells import merge_cells, trip_cells
from tripmart.operators.prepare import prepare
from tripmart.plans import report
from tripmart.plans.trip_view import order_line_trips
from tripmart.sources.ledger import MonthRead
from tripmart.sources.months import month_spine
from tripmart.sources.tables import read_table

FOLDER = "/root/testdata/sf0.001"


def in_month(month, **more):
    start = f"2024-{month:02d}-08"
    return {
        "source_month": month,
        "tpep_pickup_datetime": f"{start} 10:00:00",
        "tpep_dropoff_datetime": f"{start} 10:30:00",
        **more,
    }


def totals(spark, path):
    read = lambda name, schema: read_table(spark, f"{path}/tables/{name}", schema)
    common = rows_of(read("common_metrics", None))[0]
    hours = sum(int(row["trip_count"]) for row in rows_of(read("hourly_demand", None)))
    months = {
        int(row["pickup_month"]): int(row["trip_count"])
        for row in rows_of(read("monthly_trip_demand", None))
    }
    return common, hours, months


def test_a_shorter_range_reports_its_months_only(spark, tmp_path):
    names = zones(spark, (1, "B", "Z"))
    parts = [trips(spark, *[in_month(k)] * k) for k in (1, 2, 3)]
    report.build_report(spark, parts, names, str(tmp_path), month_spine(spark, (2024, 1), (2024, 3)))
    report.build_report(spark, parts[:2], names, str(tmp_path), month_spine(spark, (2024, 1), (2024, 2)))
    common, hours, months = totals(spark, tmp_path)
    assert int(common["valid_rows"]) == 3 == hours == sum(months.values())
    assert int(common["busiest_pickup_hour_trips"]) == int(common["top_pickup_zone_trips"]) == 3


def test_an_empty_month_gives_zero_rows_and_replaces_the_stored_one(spark, tmp_path):
    names, spine = zones(spark, (1, "B", "Z")), month_spine(spark, (2024, 1), (2024, 2))
    january, february = trips(spark, in_month(1)), trips(spark, in_month(2), in_month(2))
    read = [MonthRead(2024, 1), MonthRead(2024, 2)]
    report.build_report(spark, [january, february], names, str(tmp_path), spine, read=read)
    empty = february.limit(0)
    report.build_report(spark, [january, empty], names, str(tmp_path), spine, read=read)
    common, hours, months = totals(spark, tmp_path)
    assert months == {1: 1, 2: 0} and hours == 1 and int(common["valid_rows"]) == 1


def test_a_span_of_any_length_is_a_scale(spark):
    periods = [(1990 + k // 12, k % 12 + 1) for k in range(100)]
    rows = [
        {
            "source_year": y,
            "source_month": m,
            "tpep_pickup_datetime": f"{y}-{m:02d}-08 10:00:00",
            "tpep_dropoff_datetime": f"{y}-{m:02d}-08 10:30:00",
        }
        for y, m in periods
    ]
    prepared = prepare(trips(spark, *rows))
    spine = month_spine(spark, periods[0], periods[-1])
    sweep = scale.scale_sweep(
        scale.scale_cells(prepared), zones(spark, (1, "B", "Z")), spine, whole_span=True
    )
    last = rows_of(sweep)[-1]
    assert (last["months"], last["valid_rows"], last["period"]) == (100, 100, "1990-01 to 1998-04")


def test_every_year_is_a_column(spark):
    monthly = spark.createDataFrame([(1987, 1, 5), (2003, 2, 7)], "pickup_year int, pickup_month int, n long")
    assert series.month_by_year(monthly, "n").columns == ["pickup_month", "1987", "2003"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_instants_do_not_depend_on_the_session(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    path = str(tmp_path / "instants")
    texts = ["2024-07-01 01:00:00", "2024-03-10 02:30:00.123456", "1969-12-31 23:59:59.5"]
    table = spark.createDataFrame([(text,) for text in texts], "t string")
    table.selectExpr("cast(concat(t, 'Z') AS timestamp) AS t").write.parquet(path)
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        read = spark.read.schema("t timestamp").parquet(path)
        got = {row.t for row in read.select(as_wall_clock(read, "t").alias("t")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {datetime.fromisoformat(text) for text in texts}


def test_repeated_metric_is_an_error(spark):
    left = spark.createDataFrame([("m", 1), ("m", 5)], "metric string, valid_rows long")
    with pytest.raises(Exception, match="more than one"):
        reconcile.compare_counts(left, left.limit(1)).collect()


def test_histogram_of_merged_fares_is_an_error(spark):
    cells = merge_cells(trip_cells(prepare(trips(spark, {}, {}))), ["distance_band"])
    with pytest.raises(Exception, match="single trips"):
        fares.fare_histogram(cells, ["distance_band"]).collect()


def test_queries_without_locations_join_nothing(spark):
    counts = prepare(order_line_trips(spark, FOLDER, located=False)).groupBy("distance_band").count()
    assert "Join" not in counts._jdf.queryExecution().executedPlan().toString()
