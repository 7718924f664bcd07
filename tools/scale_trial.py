"""Throughput trial on monthly trip files of a chosen size.

    python tools/scale_trial.py make  FOLDER [copies] [months]
    python tools/scale_trial.py sweep FOLDER     # clean + top zone at each scale
    python tools/scale_trial.py full  FOLDER OUT # rollups and every report table

``make`` replicates the order-line trip view into monthly files named by period
(prices in cents).  Its rows are copies, so it measures throughput and nothing
else.
"""

from __future__ import annotations

import sys
import time
from dataclasses import replace
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tools.session import local_session  # noqa: E402
from tripmart.contract import DEFAULT  # noqa: E402
from tripmart.operators import scale  # noqa: E402
from tripmart.operators.prepare import prepare  # noqa: E402
from tripmart.plans import report  # noqa: E402
from tripmart.plans.trip_view import nation_zones, order_line_trips  # noqa: E402
from tripmart.sources.months import month_spine  # noqa: E402
from tripmart.sources.trips import monthly_paths, read_months  # noqa: E402

SOURCE = "/root/testdata/sf0.1"
MONEY = ("fare_amount", "total_amount", "tip_amount")


def periods(months: int) -> list[tuple[int, int]]:
    return [(2024 + i // 12, i % 12 + 1) for i in range(months)]


def make(spark, folder: str, copies: int, months: int) -> None:
    trips = order_line_trips(spark, SOURCE)
    own_month = F.make_date("source_year", "source_month", F.lit(1)).cast("timestamp_ntz")
    base = trips.select(
        *[
            F.round(name, 2).alias(name) if name in MONEY else F.col(name)
            for name in DEFAULT.columns
            if name not in DEFAULT.timestamps
        ],
        (F.col(DEFAULT.pickup) - own_month).alias("pickup_offset"),
        (F.col(DEFAULT.dropoff) - own_month).alias("dropoff_offset"),
    )
    base.repartition(8).write.mode("overwrite").parquet(f"{folder}/base")
    base = spark.read.parquet(f"{folder}/base")
    for period, path in zip(periods(months), monthly_paths(folder, periods(months)), strict=True):
        start = F.lit("%d-%02d-01" % period).cast("timestamp_ntz")
        copy = base.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        copy.select(
            (start + F.col("pickup_offset")).alias(DEFAULT.pickup),
            (start + F.col("dropoff_offset")).alias(DEFAULT.dropoff),
            *[name for name in DEFAULT.columns if name not in DEFAULT.timestamps],
        ).coalesce(4).write.mode("overwrite").parquet(path)


def sweep(spark, folder: str, months: int) -> None:
    zones = nation_zones(spark, SOURCE)
    for size in [size for size in DEFAULT.scales if size <= months]:
        started = time.perf_counter()
        wanted = periods(size)
        parts = read_months(spark, monthly_paths(folder, wanted))
        cells = reduce(DataFrame.unionByName, [scale.scale_cells(prepare(part)) for part in parts])
        spine = month_spine(spark, wanted[0], wanted[-1])
        one = replace(DEFAULT, scales=(size,))
        row = scale.scale_sweep(cells, zones, spine, one).collect()[0]
        seconds = time.perf_counter() - started
        print(f"{size} months: {seconds:.2f}s, {row.valid_rows} valid rows,"
              f" {row.valid_rows / seconds / 1e6:.2f} M/s, {row.top_pickup_zone}", flush=True)


def full(spark, folder: str, output: str, months: int) -> None:
    wanted = periods(months)
    started = time.perf_counter()
    trips = read_months(spark, monthly_paths(folder, wanted))
    spine = month_spine(spark, wanted[0], wanted[-1])
    report.build_report(spark, trips, nation_zones(spark, SOURCE), output, spine, wanted[0])
    print(f"full report, {months} months: {time.perf_counter() - started:.2f}s", flush=True)


def main() -> None:
    action, folder, *more = sys.argv[1:]
    spark = local_session()
    if action == "make":
        numbers = [int(text) for text in more] + [6, 24][len(more) :]
        make(spark, folder, *numbers)
        return
    months = len(list(Path(folder).glob("yellow_tripdata_*")))
    if action == "sweep":
        sweep(spark, folder, months)
        sweep(spark, folder, months)
    else:
        full(spark, folder, more[0], months)


if __name__ == "__main__":
    main()
