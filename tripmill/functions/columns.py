"""Rounding, time and null helpers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names by number.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_NAMES = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)

INFINITY = float("inf")


def round_even(value: Column, digits: int = 2) -> Column:
    """Scale, round half to even, scale back: the rounding of array libraries.

    Adding zero turns a negative zero into a positive one.
    """
    factor = F.lit(float(10**digits))
    return F.rint(value * factor) / factor + F.lit(0.0)


def round_half_up(value: Column, digits: int = 2) -> Column:
    """SQL rounding on decimals, half away from zero, given back as double."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Zone-less timestamp; text that cannot be parsed becomes null.

    A column that already has the type is returned untouched, so filters on it reach the scan.
    """
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return column
    return column.try_cast("timestamp_ntz")


def as_number(df: DataFrame, name: str) -> Column:
    """Numeric column; text that is no number becomes null."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.NumericType):
        return column
    return column.try_cast("double")


def ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_micros(moment: Column) -> Column:
    """Microseconds of a zone-less timestamp as a plain number.

    Given a timestamp instead of text, ``to_timestamp_ltz`` with a format takes the value as it is, without
    zone or calendar. A cast, ``timestampdiff`` or a subtraction builds calendar objects for every row,
    which made them the slowest part of a scan.
    """
    return F.unix_micros(F.to_timestamp_ltz(moment, F.lit("yyyy")))


def seconds_between(start: Column, end: Column) -> Column:
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(1e6)


def hour_number(moment: Column) -> Column:
    """Whole hours since the epoch: a cheap grouping and join key."""
    micros = epoch_micros(moment)
    return F.call_function("div", micros - F.pmod(micros, F.lit(3_600_000_000)), F.lit(3_600_000_000))


def hour_start(number: Column) -> Column:
    """Start of a numbered hour, without a zone, so that it is the same in every session."""
    return F.timestamp_add("HOUR", number.cast("int"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def hour_floor(moment: Column) -> Column:
    return hour_start(hour_number(moment))


def day_of_week(moment: Column) -> Column:
    """0 is Sunday."""
    return (F.dayofweek(moment) - F.lit(1)).cast("int")


def day_name(number: Column) -> Column:
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    return F.get(names, number)


def is_weekend(number: Column) -> Column:
    return number.isin(0, 6)


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .otherwise("Fall")
    )


def finite_or_zero(value: Column) -> Column:
    """Null, NaN and infinities become 0. NaN sorts above infinity, so one comparison covers both."""
    return F.coalesce(F.when(F.abs(value) < F.lit(INFINITY), value), F.lit(0.0))


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Files written from array libraries carry NaN for missing; SQL aggregates expect null."""
    floats = floating_columns(df)
    return df.withColumns({c: F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")) for c in floats}) if floats else df
