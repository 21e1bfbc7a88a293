"""The whole load: read, clean, build, check, store."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripmill.config import CleaningConfig, QualityConfig
from tripmill.operators.cleaning import TripCleaner
from tripmill.operators.quality import StarChecker
from tripmill.operators.star import POSITION, Star, build_star
from tripmill.operators.weather import build_dim_weather
from tripmill.session import Stage
from tripmill.sources.files import read_trips, read_weather
from tripmill.sources.warehouse import Warehouse

log = logging.getLogger(__name__)


def load_trips(
    trips: DataFrame,
    warehouse: Warehouse,
    cleaning: CleaningConfig = CleaningConfig(),
    quality: QualityConfig | None = None,
    stage: Stage | None = None,
    compact: bool = True,
    first_appearance: bool = False,
) -> Star:
    """Clean trips, build the star, check it and publish it. A failed check leaves the current star as it is.

    The cleaned trips are written to the stage once and every table reads the columns it needs from there.
    The star is written once as well, as tables of a new load; the checks read those tables, and publishing
    makes them the current ones in one step. ``compact`` fills fact files month by month at the price of a shuffle; switch it off for
    trips that already lie in order of months. A stage of its own is removed at the end. ``first_appearance``
    numbers fares in the order of files and rows; the trips must have been read with their positions.
    """
    if stage is None:
        with Stage(trips.sparkSession) as own:
            return load_trips(trips, warehouse, cleaning, quality, own, compact, first_appearance)
    cleaned = stage.save(TripCleaner(cleaning).clean(trips), "cleaned")
    warehouse.begin()
    star = build_star(cleaned, stage, warehouse, position=POSITION if first_appearance else ())
    warehouse.save_fact(star.fact_trips, warehouse.pending("fact_trips"), compact)
    pending = warehouse.load_star(pending=True)
    StarChecker(cleaned, pending, quality or QualityConfig(cleaning.start, cleaning.end)).raise_on_failure()
    return warehouse.publish()


def load_weather(weather: DataFrame | None, warehouse: Warehouse) -> Star:
    """Add the weather dimension to a stored star. Trouble with weather is reported and does not undo the load."""
    tables = warehouse.current()
    star = warehouse.load_star(tables=tables)
    if weather is None:
        log.warning("no weather files, weather dimension skipped")
        return star
    warehouse.new_load()
    try:
        warehouse.save(build_dim_weather(weather, star.dim_datetime, star.hours_are_small), "dim_weather")
        warehouse.add("dim_weather", tables)
    except Exception:
        log.exception("weather dimension not loaded")
    return warehouse.load_star()


def run(
    spark: SparkSession,
    trip_directory: str,
    weather_paths: Sequence[str] = (),
    warehouse: Warehouse | None = None,
    cleaning: CleaningConfig = CleaningConfig(),
    first_appearance: bool = False,
) -> Star:
    warehouse = warehouse or Warehouse(spark)
    trips = read_trips(spark, trip_directory, positions=first_appearance)
    load_trips(trips, warehouse, cleaning, first_appearance=first_appearance)
    return load_weather(read_weather(spark, weather_paths), warehouse)
