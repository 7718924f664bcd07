"""Coercion of raw columns.  Unparseable text and NaN both become null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def actual_names(columns) -> dict[str, str]:
    """Lower-cased name -> name as the table spells it."""
    return {name.lower(): name for name in columns}


def as_double(df: DataFrame, name: str) -> Column:
    """DOUBLE with NaN mapped to null, so ``x > 0`` and ``avg`` skip it.

    Spark orders NaN above every number and lets it poison an average; null has
    the wanted behaviour in both places.
    """
    column = F.col(name)
    if not isinstance(df.schema[name].dataType, T.DoubleType):
        column = column.try_cast("double")
    return F.when(~F.isnan(column), column)


def as_bigint(df: DataFrame, name: str) -> Column:
    """BIGINT; fractions truncate, text and overflow become null."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.LongType):
        return F.col(name)
    if isinstance(dtype, _INTEGRAL):
        return F.col(name).cast("bigint")
    return as_double(df, name).try_cast("bigint")


def as_wall_clock(df: DataFrame, name: str) -> Column:
    """TIMESTAMP_NTZ: trips carry local wall-clock time, never an instant.

    A column stored as instants holds the wall clock in UTC; the session's zone
    takes no part.
    """
    column = F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return column
    if isinstance(dtype, T.TimestampType):
        seconds = F.unix_micros(column).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
        since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
        return F.lit("1970-01-01").cast("timestamp_ntz") + since
    return column.try_cast("timestamp_ntz")


def text_or_null(column: Column, na_texts) -> Column:
    return F.when(~column.isin(list(na_texts)), column)


def finite_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, null where the result would not be finite."""
    ratio = F.try_divide(numerator, denominator)
    return F.when(F.abs(ratio) < F.lit(float("inf")), ratio)
