"""Clean-and-rank workload over growing prefixes of the month sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT, TripContract
from tripmart.operators.cells import merge_cells
from tripmart.operators.zones import attach_zones
from tripmart.sources.months import MONTH_KEYS

# ---- fixed values: texts of the sweep table -----------------------------------
SUCCESS, SKIPPED = "SUCCESS", "SKIPPED"
COMPLETE_PREFIX = "first %d month(s) from %s"
SKIPPED_PREFIX = "first %d month(s)"
WHOLE_SPAN = " to "
MISSING_FILE = "Missing file: "
# -------------------------------------------------------------------------------


def scale_cells(prepared: DataFrame) -> DataFrame:
    """Per (month, location) counts; invalid rows only mark their month as read."""
    valid = F.col("structurally_valid")
    rows = prepared.select(
        *MONTH_KEYS,
        F.when(valid, F.col("PULocationID")).alias("PULocationID"),
        F.when(valid, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("trip_count"),
    )
    return merge_cells(rows, [*MONTH_KEYS, "PULocationID"], ["trip_count"])


def scale_sweep(
    cells: DataFrame,
    zones: DataFrame,
    spine: DataFrame,
    contract: TripContract = DEFAULT,
    label_format: str | None = None,
    whole_span: bool = False,
) -> DataFrame:
    """For each scale N: valid rows and top zone of the first N spine months.

    Each month is aggregated once, and no month is copied: a location's trips are summed up
    to every scale side by side, then one row holds what the months and locations say of
    each scale, and the scales are unpivoted from it.
    A scale that is missing a month is SKIPPED and names the first absent one.
    With ``whole_span`` all months of the spine are one more scale, however many
    they are.  Same-named locations compete separately, as in ``zone_demand_by_id``.
    """
    # None stands for the whole span.
    scales = [*contract.scales, *([None] if whole_span else [])]
    index = F.col("month_index")

    def within(scale: int | None, number: str = "month_index") -> Column:
        return F.lit(True) if scale is None else F.col(number) <= F.lit(scale)

    file_name = F.format_string(
        label_format or contract.period_file_name, "source_year", "source_month"
    )
    by_location = merge_cells(cells, [*MONTH_KEYS, "PULocationID"], ["trip_count"])
    wanted = spine if whole_span else spine.filter(within(max(contract.scales)))
    # The spine comes first so that absent months stay visible.
    # A copy of the month's number, which grouping sets leave as it is.
    wanted = wanted.withColumn("number", index)
    months = wanted.join(by_location.withColumn("observed", F.lit(True)), MONTH_KEYS, "left")
    month_keys = ["month_index", "month", "file"]
    grains = (
        months.withColumn("file", file_name)
        .groupingSets([tuple(month_keys), ("PULocationID",)], *month_keys, "PULocationID")
        .agg(
            F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trip_count"),
            F.max("observed").alias("observed"),
            (F.grouping("month_index") == 0).alias("is_month"),
            *[
                F.sum(F.when(within(scale, "number"), F.col("trip_count"))).alias(f"reach_{place}")
                for place, scale in enumerate(scales)
            ],
        )
    )
    is_month, observed = F.col("is_month"), F.col("observed").isNotNull()
    month_row = F.struct(*month_keys)
    found = [F.max(F.when(is_month, index)).alias("span")]
    for place, scale in enumerate(scales):
        trips = F.col(f"reach_{place}")
        here = is_month & within(scale)
        # Named zones only; a missing borough sorts last.
        rank = F.struct(
            (-trips).alias("order"),
            F.col("pickup_Borough").isNull().alias("no_borough"),
            "pickup_Borough",
            "pickup_Zone",
        )
        facts = {
            "valid_rows": F.sum(F.when(here, F.col("trip_count"))),
            "files_read": F.count_if(here & observed),
            "first_month": F.min(F.when(here, month_row)),
            "last_month": F.max(F.when(here, month_row)),
            "absent": F.min(F.when(here & ~observed, month_row)),
            "zone": F.min(F.when(~is_month & F.col("pickup_Zone").isNotNull() & (trips > 0), rank)),
        }
        found.append(
            F.struct(*[fact.alias(name) for name, fact in facts.items()]).alias(f"scale_{place}")
        )
    row = attach_zones(grains, zones).agg(*found)
    span = F.col("span") if whole_span else F.lit(max(contract.scales))

    def line(place: int, scale: int | None) -> Column:
        months_ = span if scale is None else F.lit(scale)
        return F.struct(
            months_.cast("int").alias("months"),
            (months_ == span).alias("is_whole"),
            F.col(f"scale_{place}").alias("of"),
        )

    lines = F.array(*[line(place, scale) for place, scale in enumerate(scales)])
    # A span that is one of the scales is one line.
    per_scale = row.select(F.inline(lines)).dropDuplicates(["months"])
    per_scale = per_scale.filter(F.col("months").isNotNull()).select("months", "is_whole", "of.*")
    complete = F.col("files_read") == F.col("months")
    whole = F.col("is_whole")
    period = F.concat_ws(WHOLE_SPAN, "first_month.month", "last_month.month")
    prefix = F.when(
        complete,
        F.format_string(COMPLETE_PREFIX, "months", F.col("first_month.month")),
    ).otherwise(F.format_string(SKIPPED_PREFIX, "months"))

    def if_complete(value):
        return F.when(complete, value)

    return per_scale.orderBy("months").select(
        "months",
        F.when(whole, period).otherwise(prefix).alias("period"),
        F.when(complete, SUCCESS).otherwise(SKIPPED).alias("status"),
        if_complete(F.col("valid_rows")).alias("valid_rows"),
        if_complete(F.col("files_read")).alias("files_read"),
        if_complete(F.col("first_month.file")).alias("first_file"),
        if_complete(F.col("last_month.file")).alias("last_file"),
        if_complete(F.col("zone.pickup_Zone")).alias("top_pickup_zone"),
        if_complete(-F.col("zone.order")).alias("top_pickup_zone_trips"),
        F.when(complete, "")
        .otherwise(F.concat(F.lit(MISSING_FILE), F.coalesce("absent.file", F.lit("not in the spine"))))
        .alias("result_or_error"),
    )
