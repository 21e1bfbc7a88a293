"""Zone geometry from GeoJSON features and from vertex tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.projection import ConicProjection, to_longitude_latitude

# Spellings of the location id, in order of preference.
ID_PROPERTIES = ("LocationID", "locationid", "location_id", "LOCATIONID")
EMPTY_VALUES = ("", "0", "0.0", "false")

POLYGON = "array<array<array<double>>>"
MULTI_POLYGON = "array<array<array<array<double>>>>"


def _first_given(properties: Column) -> Column:
    """First property that is neither missing nor empty nor zero."""
    given = [F.when(~properties[name].isin(*EMPTY_VALUES), properties[name]) for name in ID_PROPERTIES]
    return F.coalesce(*given)


def location_id(properties: Column) -> Column:
    """Whole number, else a decimal cut to a whole number, else null."""
    raw = _first_given(properties)
    return F.coalesce(raw.try_cast("int"), raw.try_cast("double").try_cast("int"))


def location_text(properties: Column) -> Column:
    """As the writer keeps it: the normalised number, or the raw value where there is none."""
    return F.coalesce(location_id(properties).cast("string"), _first_given(properties))


def flat_points(geometry_type: Column, coordinates: Column) -> Column:
    """All points of a polygon or multipolygon in order; other types have none."""
    rings = F.when(geometry_type == "Polygon", F.from_json(coordinates, POLYGON)).when(
        geometry_type == "MultiPolygon", F.flatten(F.from_json(coordinates, MULTI_POLYGON))
    )
    return F.coalesce(F.flatten(rings), F.array().cast("array<array<double>>"))


def box_centre(points: Column) -> Column:
    """Centre of the bounding box as ``(lon, lat)``; null without points."""

    def middle(axis: int) -> Column:
        values = F.transform(points, lambda p: F.get(p, F.lit(axis)))
        return (F.array_min(values) + F.array_max(values)) / F.lit(2.0)

    return F.when(F.size(points) > 0, F.struct(middle(0).alias("lon"), middle(1).alias("lat")))


def with_location_id(features: DataFrame) -> DataFrame:
    return features.withColumn("location_id", location_id(F.col("properties")))


def with_points(features: DataFrame) -> DataFrame:
    return features.withColumn("points", flat_points(F.col("geometry_type"), F.col("coordinates")))


def zone_centroids(features: DataFrame) -> DataFrame:
    """``(location_id, lon, lat)``; of features with the same id the last with a centroid counts."""
    placed = with_points(with_location_id(features)).select(
        "feature_order", "location_id", box_centre(F.col("points")).alias("centre")
    )
    usable = placed.filter("location_id IS NOT NULL AND centre IS NOT NULL")
    last = F.max_by("centre", "feature_order").alias("centre")
    return usable.groupBy("location_id").agg(last).select("location_id", "centre.lon", "centre.lat")


def count_location_ids(features: DataFrame) -> DataFrame:
    """Unique ids as they stand in the features, those that are no number included."""
    return features.agg(F.count_distinct(location_text(F.col("properties"))).alias("locations"))


def vertex_centroids(vertices: DataFrame) -> DataFrame:
    """Bounding-box centre per feature, combined on the map side, however many vertices a feature has."""

    def middle(column: str) -> Column:
        return (F.min(column) + F.max(column)) / F.lit(2.0)

    return vertices.groupBy("feature_id").agg(middle("x").alias("x"), middle("y").alias("y"))


def reproject(vertices: DataFrame, projection: ConicProjection = ConicProjection()) -> DataFrame:
    """Projected ``x, y`` to ``lon, lat``."""
    longitude, latitude = to_longitude_latitude(F.col("x"), F.col("y"), projection)
    return vertices.withColumns({"lon": longitude, "lat": latitude}).drop("x", "y")


def geometry_type(rings: Column) -> Column:
    """Every ring is a polygon of its own; holes are not modelled."""
    return (
        F.when(rings == 0, "GeometryCollection").when(rings == 1, "Polygon").otherwise("MultiPolygon")
    )


def ring_summary(vertices: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """``(feature_id, geometry_type, rings, points)`` by counting alone.

    ``features`` lists ids that may have no vertices at all.
    """
    rings = vertices.groupBy("feature_id", "part").agg(F.count("*").alias("n"))
    shapes = rings.groupBy("feature_id").agg(F.count("*").alias("rings"), F.sum("n").alias("points"))
    if features is not None:
        shapes = features.select("feature_id").distinct().join(shapes, "feature_id", "left").na.fill(0, ["rings", "points"])
    return shapes.select("feature_id", geometry_type(F.col("rings")).alias("geometry_type"), "rings", "points")


def assemble(vertices: DataFrame, features: DataFrame) -> DataFrame:
    """``(feature_id, properties, geometry_type, geometry)`` with the geometry as GeoJSON text.

    A feature is one record of the format, so its vertices meet in one row. Rings are gathered before
    features, so the second step moves whole rings.
    """
    point = F.array("lon", "lat")
    in_order = F.array_sort(F.collect_list(F.struct("seq", point.alias("point"))))
    rings = vertices.groupBy("feature_id", "part").agg(in_order.alias("vertices"))
    rings = rings.select("feature_id", "part", F.transform("vertices", lambda v: v["point"]).alias("ring"))
    parts = F.array_sort(F.collect_list(F.struct("part", "ring")))
    shapes = rings.groupBy("feature_id").agg(parts.alias("parts"))
    joined = features.join(shapes, "feature_id", "left")
    lines = F.transform("parts", lambda p: p["ring"])
    count = F.coalesce(F.size("parts"), F.lit(0))
    polygon = F.to_json(F.struct(F.lit("Polygon").alias("type"), lines.alias("coordinates")))
    multi = F.transform(lines, lambda r: F.array(r))
    multi_polygon = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), multi.alias("coordinates")))
    geometry = (
        F.when(F.col("parts").isNull(), F.lit('{"type":"GeometryCollection","geometries":[]}'))
        .when(count == 1, polygon)
        .otherwise(multi_polygon)
    )
    kind = geometry_type(F.when(F.col("parts").isNull(), F.lit(0)).otherwise(count))
    return joined.select("feature_id", "properties", kind.alias("geometry_type"), geometry.alias("geometry"))
