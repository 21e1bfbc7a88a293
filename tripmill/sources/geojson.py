"""Writer of GeoJSON feature collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.geometry import location_id, location_text

OPENING = '{"type":"FeatureCollection","features":['
CLOSING = "]}"


def _json_text(value: Column) -> Column:
    """A string as JSON: the only element of a JSON array, without the brackets."""
    return F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", "")


def feature_text(features: DataFrame) -> DataFrame:
    """``(feature_id, value)``: one GeoJSON feature per row, its location id normalised.

    Properties are a map of strings, so all but a numeric location id are written as text.
    """
    number = location_id(F.col("properties")).cast("string")
    identifier = F.coalesce(number, _json_text(location_text(F.col("properties"))), F.lit("null"))
    others = F.map_filter("properties", lambda name, _: name != "LocationID")
    tail = F.when(F.size(others) > 0, F.regexp_replace(F.to_json(others), r"^\{", ",")).otherwise(F.lit("}"))
    value = F.concat(
        F.lit('{"type":"Feature","properties":{"LocationID":'),
        identifier,
        tail,
        F.lit(',"geometry":'),
        F.col("geometry"),
        F.lit("}"),
    )
    return features.select("feature_id", value.alias("value"))


def write_collection(features: DataFrame, path: str) -> int:
    """Write features with distinct ids, in id order, one per line, and return their number.

    The part files, read in name order, form one FeatureCollection: the opening comes first, the closing
    last, and every feature but the first has a leading comma. Range partitioning keeps the write parallel.
    """
    lines = feature_text(features)
    summary = lines.agg(F.count("*").alias("n"), F.min("feature_id").alias("first")).first()
    spark = features.sparkSession
    frame = spark.createDataFrame([(0, OPENING), (2, CLOSING)], "slot int, value string").select(
        "slot", F.lit(None).cast(lines.schema["feature_id"].dataType).alias("feature_id"), "value"
    )
    comma = F.when(F.col("feature_id") == F.lit(summary["first"]), F.lit("")).otherwise(F.lit(","))
    body = lines.select(F.lit(1).alias("slot"), "feature_id", F.concat(comma, F.col("value")).alias("value"))
    ordered = frame.unionByName(body).repartitionByRange("slot", "feature_id").sortWithinPartitions("slot", "feature_id")
    ordered.select("value").write.mode("overwrite").text(path)
    return summary["n"]
