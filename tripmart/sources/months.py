"""Expected months: spine and completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.calendar import month_label, month_start
from tripmart.sources.trips import ContractError

MONTH_KEYS = ["source_year", "source_month"]


def spine_between(bounds: DataFrame) -> DataFrame:
    """One row per month from ``first_month`` to ``last_month`` (one-row input).

    ``month_index`` counts from 1 in chronological order.
    """
    months = F.sequence("first_month", "last_month", F.expr("INTERVAL 1 MONTH"))
    spine = bounds.select(F.posexplode(months).alias("position", "month_date"))
    year, month = F.year("month_date"), F.month("month_date")
    return spine.select(
        (F.col("position") + 1).cast("int").alias("month_index"),
        year.alias("source_year"),
        month.alias("source_month"),
        month_label(year, month).alias("month"),
    )


def month_spine(spark: SparkSession, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Spine between two given (year, month) periods, both included."""
    bounds = spark.range(0, 1, 1, 1).select(
        month_start(F.lit(first[0]), F.lit(first[1])).alias("first_month"),
        month_start(F.lit(last[0]), F.lit(last[1])).alias("last_month"),
    )
    return spine_between(bounds)


def calendar_year_bounds(trips: DataFrame) -> DataFrame:
    """From the first observed month to December of the last observed year."""
    start = month_start(F.col("source_year"), F.col("source_month"))
    return trips.agg(
        F.min(start).alias("first_month"),
        F.make_date(F.max("source_year"), F.lit(12), F.lit(1)).alias("last_month"),
    )


def missing_months(spine: DataFrame, observed: DataFrame) -> DataFrame:
    """Spine months without any row in ``observed``.

    ``observed`` shrinks to its distinct months before the anti join, so the
    join sees months, not trips.
    """
    return spine.join(observed.select(*MONTH_KEYS).distinct(), MONTH_KEYS, "left_anti")


def require_months(spine: DataFrame, observed: DataFrame) -> None:
    """Raise for the first expected month that is absent."""
    absent = missing_months(spine, observed).orderBy("month_index").select("month").take(1)
    if absent:
        raise ContractError(f"expected month is missing: {absent[0]['month']}")
