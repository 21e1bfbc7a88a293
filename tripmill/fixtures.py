"""Trip, weather and zone inputs derived from the driver's tables by fixed arithmetic.

Every derivation is row-local or a plain aggregate, so its size follows the source tables. ``oracle.py``
states the same arithmetic in DuckDB SQL.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.config import CleaningConfig, MartConfig, QualityConfig
from tripmill.functions.columns import hour_floor

START, END = datetime(2024, 1, 2), datetime(2024, 3, 28, 23, 59, 59)
CLEANING = CleaningConfig(start=START, end=END)
QUALITY = QualityConfig(start=START, end=END)
MARTS = MartConfig(year=2024)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event, spread over three months, with every kind of defect the cleaner knows."""
    base = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CAST(1 + event_id % 2 AS INT) AS VendorID",
        "ts + make_dt_interval(CAST(event_id % 3 AS INT) * 30, 0, 0, 0) AS tpep_pickup_datetime",
        """ts + make_dt_interval(CAST(event_id % 3 AS INT) * 30, 0, 0,
             CASE WHEN event_id % 41 = 0 THEN 16200 WHEN event_id % 97 = 0 THEN 0
                  ELSE (event_id * 7919) % 5400 - 30 END) AS tpep_dropoff_datetime""",
        "CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(event_id % 8 AS DOUBLE) END AS passenger_count",
        "CASE WHEN event_id % 61 = 0 THEN 55.0D ELSE floor(value * 8) / 128D END AS trip_distance",
        "CASE WHEN event_id % 53 = 0 THEN 99D ELSE CAST(1 + event_id % 6 AS DOUBLE) END AS RatecodeID",
        "CASE WHEN event_id % 71 = 0 THEN 0 ELSE CAST(1 + user_id % 265 AS INT) END AS PULocationID",
        "CAST(1 + (event_id * 13) % 265 AS INT) AS DOLocationID",
        "CAST(event_id % 7 AS BIGINT) AS payment_type",
        """CASE WHEN event_id % 43 = 0 THEN -5D WHEN event_id % 47 = 0 THEN 0D
                ELSE CAST(floor(value / 5) AS DOUBLE) + 3D END AS fare_amount""",
        "CAST(event_id % 3 AS DOUBLE) * 0.5D AS extra",
        "0.5D AS mta_tax",
        "CAST(event_id % 5 AS DOUBLE) AS tip_amount",
        "CASE WHEN event_id % 10 = 0 THEN 6.5D ELSE 0D END AS tolls_amount",
        "2.5D AS congestion_surcharge",
    )
    charges = "fare_amount + extra + mta_tax + tip_amount + tolls_amount + congestion_surcharge"
    return base.withColumn("total_amount", F.expr(f"{charges} - CASE WHEN event_id % 59 = 0 THEN 5D ELSE 0D END"))


def weather(trips: DataFrame) -> DataFrame:
    """Hourly weather with missing hours, unreadable times and a second, later source."""
    pickup = trips.select(hour_floor(F.col("tpep_pickup_datetime")).alias("h")).distinct()
    hours = pickup.selectExpr(
        "dayofyear(h) * 24 + hour(h) AS eh", "date_format(h, \"yyyy-MM-dd'T'HH:mm:ss\") AS iso"
    ).filter("eh % 17 <> 0")
    first = hours.selectExpr(
        "0 AS source_order",
        "CASE WHEN eh % 101 = 0 THEN 'n/a' ELSE iso END AS datetime",
        "CASE WHEN eh % 29 = 0 THEN NULL ELSE CAST((eh * 7) % 45 - 10 AS DOUBLE) END AS temp",
        "CAST(eh % 11 AS DOUBLE) * 0.125D AS precip",
        "CAST(40 + eh % 50 AS DOUBLE) AS humidity",
        """CASE eh % 5 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Rain' WHEN 2 THEN 'Overcast' WHEN 3 THEN 'Snow'
                ELSE 'Partially cloudy' END AS conditions""",
    )
    second = hours.filter("eh % 50 = 0").selectExpr(
        "1 AS source_order", "iso AS datetime", "99D AS temp", "0D AS precip", "0D AS humidity", "'Duplicate' AS conditions"
    )
    return first.unionByName(second)


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone per supplier; the borough is its nation."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    zones = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return zones.selectExpr(
        "CAST(s_suppkey + 1 AS INT) AS LocationID",
        "n_name AS Borough",
        "s_name AS Zone",
        "CASE WHEN s_suppkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone",
    )


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices in feet, one per customer; a third of the features has a single ring."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_nationkey + 1 AS BIGINT) AS feature_id",
        "CASE WHEN (c_nationkey + 1) % 3 = 0 THEN 0 ELSE CAST(c_custkey % 2 AS INT) END AS part",
        "c_custkey AS seq",
        "CAST(913000 + (c_custkey * 37) % 150000 AS DOUBLE) AS x",
        "CAST(120000 + (c_custkey * 53) % 150000 AS DOUBLE) AS y",
    )


def feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON feature per customer as a line of text.

    The id is spelled in four ways, as number, text or decimal text, sometimes unusable. Polygons,
    multipolygons, points and missing geometries occur.
    """
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k",
        "CAST(1 + c_custkey % 265 AS INT) AS id",
        "-74.0D + CAST(c_custkey % 512 AS DOUBLE) / 1024D AS x",
        "40.5D + CAST((c_custkey * 7) % 512 AS DOUBLE) / 1024D AS y",
    )
    spelling = "element_at(array('LocationID', 'locationid', 'location_id', 'LOCATIONID'), CAST(k % 4 AS INT) + 1)"
    value = """CASE WHEN k % 19 = 0 THEN '"x"' WHEN k % 23 = 0 THEN '""' WHEN k % 29 = 0 THEN '0'
                    WHEN k % 5 = 1 THEN concat('"', id, '"') WHEN k % 5 = 2 THEN concat('"', id, '.0"')
                    ELSE CAST(id AS STRING) END"""
    ring = "concat('[[', x, ',', y, '],[', x + {s}, ',', y, '],[', x + {s}, ',', y + {s}, '],[', x, ',', y, ']]')"
    outer, far = ring.format(s="0.25D"), ring.format(s="0.5D")
    geometry = f"""CASE WHEN k % 31 = 0 THEN 'null'
        WHEN k % 37 = 0 THEN concat('{{"type":"Point","coordinates":[', x, ',', y, ']}}')
        WHEN k % 3 = 0 THEN concat('{{"type":"Polygon","coordinates":[', {outer}, ']}}')
        ELSE concat('{{"type":"MultiPolygon","coordinates":[[', {outer}, '],[', {far}, ']]}}') END"""
    return customers.selectExpr(
        f"""concat('{{"type":"Feature","properties":{{"', {spelling}, '":', {value},
            ',"customer":"', k, '"}},"geometry":', {geometry}, '}}') AS value"""
    )
