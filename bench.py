"""Benchmark: headline queries and the full report on the driver tables.

Prints one JSON line.  ``BENCH_SF_DIR`` is the folder of Parquet tables and
``BENCH_CPUS`` the number of local cores.  Seconds are wall clock from building
the query to its last row, best of two runs after one shared warm-up query;
compare directly: this folder holds 600,000 trips in one Parquet row group, so
its scan is a single task.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripmart.plans import catalog, report  # noqa: E402
from tripmart.plans.trip_view import nation_zones, order_line_trips  # noqa: E402
from tripmart.sources.months import spine_between  # noqa: E402

HEADLINE = [
    "common_metrics",
    "monthly_quality",
    "hourly_demand",
    "top_zones",
    "distance_fare_summary",
    "passenger_summary",
    "single_vs_multiple",
    "weekday_weekend_summary",
    "weekday_weekend_hourly",
    "monthly_comparison",
    "year_summary",
    "top_zone_by_id",
    "scale_sweep",
    "reconcile_report",
]
RUNS = 2


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripmart bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(job) -> float:
    started = time.perf_counter()
    job()
    return time.perf_counter() - started


def run_report(spark: SparkSession, folder: str) -> None:
    """The whole report job, written to the shared folder if one is configured."""
    parent = spark.conf.get("spark.checkpoint.dir", None)
    output = f"{parent}/bench-{time.time_ns()}" if parent else tempfile.mkdtemp(prefix="run-")
    trips = order_line_trips(spark, folder)
    month = F.make_date("source_year", "source_month", F.lit(1))
    bounds = order_line_trips(spark, folder, located=False).agg(
        F.min(month).alias("first_month"), F.max(month).alias("last_month")
    )
    spine = spine_between(bounds)
    report.build_report(spark, trips, nation_zones(spark, folder), output, spine, (1998, 1))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    catalog.QUERIES["common_metrics"](spark, folder).collect()
    timings = {}
    for name in HEADLINE:
        query = catalog.QUERIES[name]
        timings[name] = min(
            seconds(lambda query=query: query(spark, folder).collect()) for _ in range(RUNS)
        )
    timings["full_report"] = seconds(lambda: run_report(spark, folder))
    total = sum(timings.values())
    print(
        json.dumps(
            {
                "metric": "headline queries plus full report",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in timings.items()},
                "sf": Path(folder).name.removeprefix("sf"),
                "trips": rows,
                "trips_per_sec": {
                    name: round(rows / value) for name, value in timings.items()
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
