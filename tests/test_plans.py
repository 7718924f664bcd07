"""Properties of physical plans that matter at scale."""

from tripmart.operators import fares, zones
from tripmart.operators.cells import trip_cells
from tripmart.operators.prepare import prepare, valid_trips
from tripmart.operators.scale import scale_cells
from tripmart.plans import catalog
from tripmart.plans.trip_view import order_line_trips
from tripmart.sources.trips import contract_schema

FOLDER = "/root/testdata/sf0.001"


def plan_of(table):
    return table._jdf.queryExecution().executedPlan().toString()


def month_files(spark, tmp_path):
    path = f"{tmp_path}/trips"
    spark.createDataFrame([], contract_schema()).write.parquet(path)
    scan = spark.read.schema(contract_schema()).parquet(path)
    return prepare(scan.selectExpr("*", "2024 AS source_year", "1 AS source_month"))


def test_scan_reads_only_used_columns(spark, tmp_path):
    plan = plan_of(scale_cells(month_files(spark, tmp_path)))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert [part.split(":")[0] for part in schema.split(",")] == [
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "PULocationID",
        "DOLocationID",
    ]


def test_null_tests_reach_the_scan(spark, tmp_path):
    plan = plan_of(valid_trips(month_files(spark, tmp_path)))
    for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"):
        assert f"IsNotNull({name})" in plan


def test_ship_dates_reach_the_scan(spark):
    plan = plan_of(order_line_trips(spark, FOLDER, [("1998-01-01", "1998-02-01")]))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_aggregation_precedes_every_shuffle_of_trips(spark, tmp_path):
    cells = trip_cells(month_files(spark, tmp_path))
    names = catalog.nation_zones(spark, FOLDER)
    plan = plan_of(zones.top_zones(cells, names, 20))
    assert "TakeOrderedAndProject" in plan and "partial_sum" in plan
    below_shuffle = plan.split("Exchange hashpartitioning(PULocationID")[1]
    assert below_shuffle.index("partial_sum") < below_shuffle.index("Scan parquet")


def test_means_and_medians_scan_once(spark):
    cells = trip_cells(prepare(order_line_trips(spark, FOLDER)))
    tables = (
        fares.band_median_fare(fares.fare_histogram(cells, ["distance_band"])),
        fares.distance_fares_in_one_scan(cells),
    )
    for table in tables:
        table.collect()
        final = plan_of(table).split("Initial Plan")[0]
        assert final.count("lineitem.parquet") == 1
        assert "ReusedExchange" in final


def line_scans(table):
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines())


def test_reconciliation_scans_once(spark):
    for name in ("reconcile_report", "reconcile_hour", "reconcile_zone", "reconcile_band_fares"):
        assert line_scans(catalog.QUERIES[name](spark, FOLDER)) == 1, name


def test_months_and_their_spine_scan_once(spark):
    for name in ("scale_sweep", "series_scale", "missing_months"):
        table = catalog.QUERIES[name](spark, FOLDER)
        table.collect()
        final = plan_of(table).split("Initial Plan")[0]
        assert final.count("lineitem.parquet") == 1, name


def test_no_month_is_copied_to_the_scales(spark):
    plan = plan_of(catalog.QUERIES["scale_sweep"](spark, FOLDER))
    assert "Window" not in plan and "explode(array" not in plan.lower()
