"""The reconciliation job on stored folders, per-file contracts, and the report's series."""

import pytest

from tests.rows import rows_of, trips, zones
from tripmart.contract import DEFAULT
from tripmart.plans import catalog, reconciliation, report
from tripmart.sources.months import month_spine
from tripmart.sources.tables import read_table
from tripmart.sources.trips import ContractError, contract_schema, read_trips

FOLDER = "/root/testdata/sf0.001"
JANUARY = {"tpep_pickup_datetime": "2024-01-08 10:00:00", "tpep_dropoff_datetime": "2024-01-08 10:30:00"}


def stored(spark, path, *rows):
    report.build_report(
        spark,
        trips(spark, *[{**JANUARY, **row} for row in rows]),
        zones(spark, (1, "B", "Z")),
        str(path),
        month_spine(spark, (2024, 1), (2024, 1)),
        slice_period=(2024, 1),
    )
    return f"{path}/slice-2024-01"


def statuses(spark, left, right, period, path):
    reconciliation.write_reconciliation(spark, left, right, period, str(path))
    return {row["metric"]: row["status"] for row in rows_of(read_table(spark, str(path)))}


def test_stored_results_are_reconciled(spark, tmp_path):
    left = stored(spark, tmp_path / "a", {}, {})
    right = stored(spark, tmp_path / "b", {}, {"DOLocationID": None})
    same = statuses(spark, left, left, (2024, 1), tmp_path / "same")
    assert same["Structurally valid rows"] == same["Busiest pickup hour"] == "PASS"
    assert same["Top pickup zone"] == "PASS"
    other = statuses(spark, left, right, (2024, 1), tmp_path / "other")
    assert other["Structurally valid rows"] == other["Busiest pickup hour"] == "FAIL"
    assert other["Top pickup zone"] == "REVIEW"


def test_a_side_without_its_summary_is_read_from_details(spark, tmp_path):
    folder = stored(spark, tmp_path / "a", {}, {})
    details = tmp_path / "details"
    for name in ("quality_summary", "hourly_demand", "top_pickup_zones"):
        report.write_tables({name: read_table(spark, f"{folder}/{name}", infer=False)}, str(details))
    got = statuses(spark, folder, str(details), (2024, 1), tmp_path / "report")
    assert got["Structurally valid rows"] == got["Top pickup zone"] == "PASS"
    assert got["Average fare by distance band"] == "PENDING"


def test_another_period_is_never_compared(spark, tmp_path):
    folder = stored(spark, tmp_path / "a", {})
    report_ = statuses(spark, folder, folder, (2024, 2), tmp_path / "report")
    assert "PASS" not in report_.values()


def test_series_are_stored(spark, tmp_path):
    stored(spark, tmp_path / "a", {})
    volume = read_table(spark, f"{tmp_path}/a/series/series_month_volume")
    assert volume.columns == ["pickup_month", "2024"] and volume.collect() == [(1, 1)]


def test_every_file_of_a_month_is_checked(spark, tmp_path):
    path = str(tmp_path / (DEFAULT.period_file_name % (2024, 1)))
    whole = spark.createDataFrame([(None,) * len(contract_schema())], contract_schema())
    whole.write.parquet(path)
    whole.write.mode("append").parquet(path)
    assert read_trips(spark, [path]).count() == 2
    whole.drop("total_amount").write.mode("append").parquet(path)
    with pytest.raises(ContractError, match="total_amount"):
        read_trips(spark, [path])


def test_a_month_whose_files_differ_in_type_is_read_whole(spark, tmp_path):
    path = str(tmp_path / (DEFAULT.period_file_name % (2024, 1)))
    whole = spark.createDataFrame([(None,) * len(contract_schema())], contract_schema())
    whole.write.parquet(path)
    texts = whole.withColumn("PULocationID", whole["PULocationID"].cast("string"))
    texts.write.mode("append").parquet(path)
    assert read_trips(spark, [path]).count() == 2


@pytest.mark.parametrize("name", ["reconcile_counts", "period_select"])
def test_one_scan(spark, name):
    plan = catalog.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("lineitem.parquet") == 1
