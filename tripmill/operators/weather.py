"""Weather dimension: at most one observation per hour of the hour dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.config import WEATHER_ATTRIBUTES
from tripmill.functions.columns import as_timestamp

# Position of a row in its list of files, as the CSV source adds it.
ORDER_COLUMNS = ("source_order", "file", "block_start", "row_in_block")


def parse_time(weather: DataFrame) -> DataFrame:
    return weather.withColumn("full_datetime", as_timestamp(weather, "datetime"))


def match_hours(weather: DataFrame, dim_datetime: DataFrame, small: bool) -> DataFrame:
    hours = dim_datetime.select("datetime_id", "full_datetime")
    return weather.join(F.broadcast(hours) if small else hours, "full_datetime")


def attributes(df: DataFrame) -> list[str]:
    return [c for c in WEATHER_ATTRIBUTES if c in df.columns]


def keep_attributes(matched: DataFrame) -> DataFrame:
    return matched.select("datetime_id", *attributes(matched))


def first_per_hour(matched: DataFrame) -> DataFrame:
    """The first observation of an hour in file order wins.

    An aggregate and not a window: it combines on the map side, so an hour with very many copies is no
    heavier than any other. The attributes close the ordering to make it total.
    """
    kept = attributes(matched)
    order = [c for c in ORDER_COLUMNS if c in matched.columns]
    first = F.min_by(F.struct(*kept), F.struct(*order, *kept)).alias("first")
    return matched.groupBy("datetime_id").agg(first).select("datetime_id", *[F.col(f"first.{c}") for c in kept])


def build_dim_weather(weather: DataFrame, dim_datetime: DataFrame, small: bool) -> DataFrame:
    return first_per_hour(match_hours(parse_time(weather), dim_datetime, small))
