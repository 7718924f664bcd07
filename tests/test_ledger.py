"""Months read and not read, unchanged files, and writes that fail."""

import os

import pytest

from tests.rows import rows_of, trips, zones
from tests.test_review import in_month
from tests.test_sources import write_month
from tripmart.operators.cells import merge_cells
from tripmart.plans import report
from tripmart.sources.ledger import month_files, months_of, read_ledger
from tripmart.sources.months import month_spine
from tripmart.sources.tables import read_table
from tripmart.sources.trips import ContractError

PERIODS = ((2024, 1), (2024, 3))


def table(spark, path, name):
    return rows_of(read_table(spark, f"{path}/tables/{name}"))


def counts(spark, path):
    location = report.read_rollups(spark, f"{path}/rollups")["location"]
    merged = merge_cells(location, ["source_month"], ["raw_rows"])
    return {row["source_month"]: row["raw_rows"] for row in rows_of(merged)}


def test_a_month_that_was_not_read_is_missing(spark, tmp_path):
    names, spine = zones(spark, (1, "B", "Z")), month_spine(spark, (2024, 1), (2024, 3))
    parts = [trips(spark, in_month(1)), trips(spark, in_month(3))]
    report.build_report(spark, parts, names, str(tmp_path), spine)
    sweep = {row["months"]: row for row in table(spark, tmp_path, "scale_sweep")}
    assert sweep[1]["status"] == "SUCCESS" and sweep[3]["status"] == "SKIPPED"
    assert sweep[3]["result_or_error"] == "Missing file: yellow_tripdata_2024-02.parquet"
    months = table(spark, tmp_path, "monthly_trip_demand")
    assert [row["pickup_month"] for row in months] == [1, 3]
    assert len(table(spark, tmp_path, "monthly_quality")) == 2


def test_a_failed_write_leaves_the_state_before(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/rollups"
    report.write_rollups([trips(spark, in_month(1)), trips(spark, in_month(2))], path)
    real = report._write_rollup

    def failing(rollup, to, name, version):
        if name == "fare":
            raise OSError("no space")
        real(rollup, to, name, version)

    monkeypatch.setattr(report, "_write_rollup", failing)
    changed = trips(spark, *[in_month(1)] * 5)
    with pytest.raises(OSError):
        report.write_rollups(changed, path)
    assert counts(spark, tmp_path) == {1: 1, 2: 1}
    assert {row.data_version for row in read_ledger(spark, path).collect()} == {1}
    monkeypatch.undo()
    report.write_rollups(changed, path)
    assert counts(spark, tmp_path) == {1: 5, 2: 1}
    ledger = {row.source_month: row for row in read_ledger(spark, path).collect()}
    assert {k: (row.data_version, row.raw_rows) for k, row in ledger.items()} == {1: (2, 5), 2: (1, 1)}


def test_only_changed_months_are_read_again(spark, tmp_path, monkeypatch):
    folder, output = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    names = zones(spark, (7, "B", "Z"))
    for month in ("2024-01", "2024-02", "2024-03"):
        write_month(folder, month)
    update = lambda **more: report.update_report(
        spark, str(folder), names, output, *PERIODS, **more
    )
    assert update() == [(2024, 1), (2024, 2), (2024, 3)]
    with monkeypatch.context() as patched:
        patched.setattr(report, "read_months", lambda *_: pytest.fail("a trip file was read"))
        assert update() == []
    path = write_month(folder, "2024-02")
    os.utime(path, (10**9, 10**9))
    assert update() == [(2024, 2)]
    ledger = read_ledger(spark, f"{output}/rollups").collect()
    assert {r.source_month: r.files for r in ledger} == {1: 1, 2: 1, 3: 1}
    os.rename(path, tmp_path / "away.parquet")
    with pytest.raises(ContractError, match="2024-02"):
        update()
    assert update(allow_missing=True) == []
    assert [row["pickup_month"] for row in table(spark, output, "monthly_trip_demand")] == [1, 3]
    assert table(spark, output, "scale_sweep")[1]["status"] == "SKIPPED"


def test_file_table(spark, tmp_path):
    assert months_of(month_files(spark, str(tmp_path))) == {}
    write_month(tmp_path, "2024-01")
    directory = tmp_path / "yellow_tripdata_2024-02.parquet"
    trips(spark, {}, {}).repartition(2).write.parquet(str(directory))
    (tmp_path / "notes.parquet").write_text("no month")
    found = months_of(month_files(spark, str(tmp_path)))
    assert {period: month.files for period, month in found.items()} == {(2024, 1): 1, (2024, 2): 2}
    assert found[2024, 1].bytes == (tmp_path / "yellow_tripdata_2024-01.parquet").stat().st_size
