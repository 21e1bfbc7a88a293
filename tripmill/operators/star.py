"""Star schema: hour dimension, fare dimension and trip fact."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from typing import Protocol

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.config import DROPOFF, MONEY_COLUMNS, PICKUP
from tripmill.functions.columns import (
    as_timestamp,
    day_of_week,
    finite_or_zero,
    hour_number,
    hour_start,
    nan_to_null,
    round_even,
    season,
    seconds_between,
)
from tripmill.operators.keys import BROADCAST_BYTES, HOT_SHARE, dense_key, fits_broadcast, hot_split_join
from tripmill.session import Stage

HOUR_COLUMNS = ("datetime_id", "full_datetime")
# Where a row stands in its files, if the reader was asked for it. Not part of the fact.
POSITION = ("source_file", "source_row")


class Store(Protocol):
    """Writes a frame under a name and reads it back."""

    def save(self, df: DataFrame, name: str) -> DataFrame: ...


@dataclass(frozen=True)
class Star:
    """Stored star tables. The sizes of the dimensions, read from file footers when first needed, decide how
    they are joined.

    ``hot_fares`` holds the few fare combinations with a large share of the trips; it is bounded by
    ``1 / HOT_SHARE`` rows whatever the data.
    """

    dim_datetime: DataFrame
    dim_fare: DataFrame
    fact_trips: DataFrame
    hot_fares: DataFrame | None = None
    dim_weather: DataFrame | None = None
    # Dimensions of more bytes are not broadcast.
    broadcast_bytes: int = BROADCAST_BYTES

    @cached_property
    def hour_rows(self) -> int:
        return self.dim_datetime.count()

    @cached_property
    def fare_rows(self) -> int:
        return self.dim_fare.count()

    @property
    def hours_are_small(self) -> bool:
        return fits_broadcast(self.hour_rows, self.dim_datetime.columns, self.broadcast_bytes)

    @property
    def fares_are_small(self) -> bool:
        return fits_broadcast(self.fare_rows, self.dim_fare.columns, self.broadcast_bytes)

    def with_hours(self, df: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
        """Add hour attributes to a frame that has ``datetime_id``.

        ``day_of_week`` is computed on the dimension, once per hour and not once per trip.
        """
        hours = self.dim_datetime.withColumn("day_of_week", day_of_week(F.col("full_datetime")))
        hours = hours.select("datetime_id", *columns)
        return df.join(F.broadcast(hours) if self.hours_are_small else hours, "datetime_id", how)

    def with_fares(self, facts: DataFrame, *columns: str) -> DataFrame:
        """Add money columns to facts that have ``fare_id``."""
        keep = ("fare_id", *columns)
        hot = None if self.hot_fares is None else self.hot_fares.select(*keep)
        return hot_split_join(facts, self.dim_fare.select(*keep), ["fare_id"], hot, self.fares_are_small)


# -- trip columns ------------------------------------------------------------------------------------


def require_timestamps(df: DataFrame) -> None:
    missing = [c for c in (PICKUP, DROPOFF) if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def add_metrics(trips: DataFrame) -> DataFrame:
    """Trip duration in minutes and tip as a percentage of the fare, two decimals each."""
    require_timestamps(trips)
    df = nan_to_null(trips)
    df = df.withColumns({PICKUP: as_timestamp(df, PICKUP), DROPOFF: as_timestamp(df, DROPOFF)})
    minutes = seconds_between(F.col(PICKUP), F.col(DROPOFF)) / F.lit(60.0)
    if {"tip_amount", "fare_amount"} <= set(df.columns):
        percentage = F.try_divide(F.col("tip_amount"), F.col("fare_amount")) * F.lit(100.0)
        tip = round_even(finite_or_zero(percentage))
    else:
        tip = F.lit(None).cast("double")
    return df.withColumns({"trip_duration_min": round_even(minutes), "tip_percentage": tip})


# -- hour dimension ----------------------------------------------------------------------------------


def distinct_hours(trips: DataFrame) -> DataFrame:
    pickup = as_timestamp(trips, PICKUP)
    hours = trips.filter(pickup.isNotNull()).select(hour_number(pickup).alias("number")).distinct()
    return hours.select(hour_start(F.col("number")).alias("full_datetime"))


def calendar(hours: DataFrame) -> DataFrame:
    moment = F.col("full_datetime")
    return hours.withColumns(
        {
            "date": F.to_date(moment),
            "day": F.dayofmonth(moment),
            "month": F.month(moment),
            "quarter": F.quarter(moment),
            "year": F.year(moment),
            "week": F.weekofyear(moment),
            "hour": F.hour(moment),
            "season": season(F.month(moment)),
        }
    )


def number_hours(hours: DataFrame) -> DataFrame:
    """``datetime_id`` = 1-based position in hour order.

    Positions are taken inside each year, at most 8,784 rows, and shifted by the hours of earlier years,
    so no window sees more than a year.
    """
    by_year = hours.withColumn("_year", F.year("full_datetime"))
    earlier = Window.orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        by_year.groupBy("_year").count().select("_year", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_shift"))
    )
    inside = F.row_number().over(Window.partitionBy("_year").orderBy("full_datetime"))
    numbered = by_year.withColumn("_row", inside).join(F.broadcast(shifts), "_year")
    return numbered.select((F.col("_shift") + F.col("_row")).cast("bigint").alias("datetime_id"), *hours.columns)


def build_dim_datetime(trips: DataFrame, stage: Stage) -> DataFrame:
    """The distinct hours are stored before they are numbered: numbering reads them twice, the trips once."""
    return calendar(number_hours(stage.save(distinct_hours(trips), "hours")))


def attach_datetime_id(trips: DataFrame, dim_datetime: DataFrame, small: bool) -> DataFrame:
    """Left join on the pickup hour; a trip without pickup time keeps a null id."""
    hours = dim_datetime.select("datetime_id", hour_number(F.col("full_datetime")).alias("_hour"))
    hours = F.broadcast(hours) if small else hours
    return trips.join(hours, hour_number(as_timestamp(trips, PICKUP)) == F.col("_hour"), "left").drop("_hour")


# -- fare dimension ----------------------------------------------------------------------------------


def money_columns(df: DataFrame) -> list[str]:
    return [c for c in MONEY_COLUMNS if c in df.columns]


def fare_combinations(trips: DataFrame, position: Sequence[str] = ()) -> DataFrame:
    """Distinct combinations of the money columns with their trip counts; nulls equal each other.

    With the columns of a ``position``, which tell rows apart, ``first_seen`` is the first row of a combination.
    The last column, a number, is reduced on its own first, so that only the rest is compared as a struct.
    """
    money = money_columns(trips)
    if not position:
        return trips.groupBy(*money).agg(F.count(F.lit(1)).alias("trips"))
    *files, row = position
    first = trips.groupBy(*files, *money).agg(F.min(row).alias(row), F.count(F.lit(1)).alias("trips"))
    if not files:
        return first.withColumnRenamed(row, "first_seen")
    return first.groupBy(*money).agg(F.min(F.struct(*position)).alias("first_seen"), F.sum("trips").alias("trips"))


def number_fares(combinations: DataFrame, stage: Stage) -> DataFrame:
    """``fare_id`` in the order of the first rows if those are known, else of the money columns."""
    known = "first_seen" in combinations.columns
    return dense_key(combinations, ["first_seen"] if known else money_columns(combinations), "fare_id", stage)


def hot_fares(numbered: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """The combinations that hold more than ``share`` of all trips, fewer than ``1 / share`` rows."""
    trips = numbered.agg(F.sum("trips")).first()[0] or 0
    return numbered.filter(F.col("trips") > F.lit(trips * share)).drop("trips")


def attach_fare_id(trips: DataFrame, dim_fare: DataFrame, hot: DataFrame | None, small: bool) -> DataFrame:
    """Replace the money columns by ``fare_id``; the number of rows does not change."""
    money = money_columns(trips)
    joined = hot_split_join(trips, dim_fare.select(*money, "fare_id"), money, hot, small, how="left", null_safe=True)
    return fact_order(joined.drop(*money))


def fact_order(fact: DataFrame) -> DataFrame:
    """``fare_id`` right after ``datetime_id``."""
    columns = [c for c in fact.columns if c != "fare_id"]
    if "datetime_id" in columns:
        columns.insert(columns.index("datetime_id") + 1, "fare_id")
    else:
        columns.append("fare_id")
    return fact.select(*columns)


# -- whole transform ---------------------------------------------------------------------------------


def build_star(
    trips: DataFrame,
    stage: Stage,
    tables: Store | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    position: Sequence[str] = (),
) -> Star:
    """Dimensions are stored first, so their sizes are known when the fact is joined to them.

    ``tables`` stores the dimensions where they are to stay; by default that is the stage. The trips are
    read once per table with only the columns it needs, so pass trips that are stored, not a long
    computation. ``position`` names columns by which fares are numbered in order of first appearance.
    """
    tables = tables or stage
    derived = add_metrics(trips)
    dim_datetime = tables.save(build_dim_datetime(derived, stage), "dim_datetime")
    hours_are_small = fits_broadcast(dim_datetime.count(), HOUR_COLUMNS, broadcast_bytes)
    fact = attach_datetime_id(derived.drop(*POSITION), dim_datetime, hours_are_small)
    if not money_columns(derived):
        dim_fare = tables.save(trips.sparkSession.range(1, 2).select(F.col("id").alias("fare_id")), "dim_fare")
        fact = fact_order(fact.withColumn("fare_id", F.lit(1).cast("bigint")))
        return Star(dim_datetime, dim_fare, fact, broadcast_bytes=broadcast_bytes)
    numbered = number_fares(fare_combinations(derived, position), stage).select("fare_id", *money_columns(derived), "trips")
    dim_fare = tables.save(numbered.drop("trips"), "dim_fare")
    small = fits_broadcast(dim_fare.count(), dim_fare.columns, broadcast_bytes)
    # A dimension that is broadcast whole needs no list of hot combinations.
    hot = None if small else tables.save(hot_fares(numbered, hot_share), "hot_fares")
    fact = attach_fare_id(fact, dim_fare, hot, small)
    return Star(dim_datetime, dim_fare, fact, hot, broadcast_bytes=broadcast_bytes)
