"""Thresholds, date ranges and column names, all overridable."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

# Column names of the trip, fare and weather records.
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
MONEY_COLUMNS = (
    "fare_amount",
    "tip_amount",
    "total_amount",
    "extra",
    "tolls_amount",
    "congestion_surcharge",
    "mta_tax",
)
CHARGE_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tolls_amount",
    "congestion_surcharge",
    "tip_amount",
)
NON_NEGATIVE_COLUMNS = (
    "fare_amount",
    "tip_amount",
    "total_amount",
    "trip_distance",
    "extra",
    "tolls_amount",
    "congestion_surcharge",
    "mta_tax",
    "passenger_count",
)
RATE_CODE_COLUMNS = ("RatecodeID", "rate_code")
LOCATION_COLUMNS = ("PULocationID", "DOLocationID", "pickup_location_id", "dropoff_location_id")
WEATHER_ATTRIBUTES = (
    "temp",
    "feelslike",
    "humidity",
    "precip",
    "precipprob",
    "snow",
    "windgust",
    "windspeed",
    "cloudcover",
    "uvindex",
    "visibility",
    "conditions",
)
CHECKED_COLUMNS = (
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "extra",
    "tolls_amount",
    "congestion_surcharge",
    "mta_tax",
    "trip_duration_min",
)


@dataclass(frozen=True)
class CleaningConfig:
    start: datetime = datetime(2025, 1, 1)
    end: datetime = datetime(2025, 3, 31, 23, 59, 59)
    max_passengers: int = 6
    min_distance: float = 0.01
    max_distance: float = 50.0
    max_hours: float = 4.0
    max_mph: float = 100.0
    charge_tolerance: float = 1.0
    payment_types: tuple[int, ...] = (1, 2, 3, 4, 5, 6)
    rate_codes: tuple[int, ...] = (1, 2, 3, 4, 5, 6)
    location_columns: tuple[str, ...] = LOCATION_COLUMNS
    max_location_id: int = 265


@dataclass(frozen=True)
class QualityConfig:
    start: datetime = datetime(2025, 1, 1)
    end: datetime = datetime(2025, 3, 31, 23, 59, 59)
    columns: tuple[str, ...] = CHECKED_COLUMNS


@dataclass(frozen=True)
class MartConfig:
    year: int = 2025
