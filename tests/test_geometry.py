import math

import pytest

from tripmill.functions.projection import ConicProjection
from tripmill.operators import geometry


def forward(lon, lat, p=ConicProjection()):
    """Projection in plain Python, the other way round."""
    radius = p.scale * p._t(math.radians(lat)) ** p.cone
    angle = p.cone * math.radians(lon - p.origin_longitude)
    east = radius * math.sin(angle) + p.false_easting_m
    north = p.origin_radius - radius * math.cos(angle) + p.false_northing_m
    return east / p.metres_per_unit, north / p.metres_per_unit


def test_origin(spark):
    df = spark.createDataFrame([(1, 984250.0, 0.0)], "id int, x double, y double")
    row = geometry.reproject(df).first()
    assert row["lon"] == pytest.approx(-74.0, abs=1e-12)
    assert row["lat"] == pytest.approx(40 + 10 / 60, abs=1e-10)


def test_round_trip(spark):
    places = [(-74.25, 40.5), (-73.7, 40.92), (-73.9851, 40.7589), (-74.0, 41.0)]
    df = spark.createDataFrame([(i, *forward(*place)) for i, place in enumerate(places)], "id int, x double, y double")
    got = [(r["lon"], r["lat"]) for r in geometry.reproject(df).orderBy("id").collect()]
    for (lon, lat), (a, b) in zip(places, got):
        assert a == pytest.approx(lon, abs=1e-10) and b == pytest.approx(lat, abs=1e-10)


def test_vertex_centroids_do_not_depend_on_layout(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 > 0, 1L, id % 7) AS feature_id", "CAST(id AS DOUBLE) AS x", "CAST(-id AS DOUBLE) AS y")
    a = sorted(map(tuple, geometry.vertex_centroids(df.repartition(17)).collect()))
    assert a == sorted(map(tuple, geometry.vertex_centroids(df.coalesce(1)).collect()))


def test_published_constants(spark):
    """A point on the central meridian and one in the city, projected apart from the class under test."""
    # The forward formulas with the published constants in degrees.
    e2 = 2 / 298.257222101 - 1 / 298.257222101**2
    e = math.sqrt(e2)
    m = lambda d: math.cos(math.radians(d)) / math.sqrt(1 - e2 * math.sin(math.radians(d)) ** 2)
    t = lambda d: math.tan(math.pi / 4 - math.radians(d) / 2) / (
        ((1 - e * math.sin(math.radians(d))) / (1 + e * math.sin(math.radians(d)))) ** (e / 2)
    )
    south, north, origin = 40 + 40 / 60, 41 + 2 / 60, 40 + 10 / 60
    n = math.log(m(south) / m(north)) / math.log(t(south) / t(north))
    unit = 6378137 * m(south) / (n * t(south) ** n)
    rows = []
    for lon, lat in ((-74.0, 41 + 10 / 60), (-73.9857, 40.7484)):
        angle = n * math.radians(lon + 74)
        x = (unit * t(lat) ** n * math.sin(angle) + 300000) * 3937 / 1200
        y = (unit * t(origin) ** n - unit * t(lat) ** n * math.cos(angle)) * 3937 / 1200
        rows.append((lon, lat, x, y))
    df = spark.createDataFrame(rows, "a double, b double, x double, y double")
    for r in geometry.reproject(df).collect():
        assert r["lon"] == pytest.approx(r["a"], abs=1e-9) and r["lat"] == pytest.approx(r["b"], abs=1e-9)
