"""Inverse Lambert conformal conic projection as column arithmetic."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ConicProjection:
    """Two-parallel conic; the defaults are the public EPSG:2263 definition, in US survey feet."""

    semi_major: float = 6378137.0
    inverse_flattening: float = 298.257222101
    parallel_1: float = 40 + 40 / 60
    parallel_2: float = 41 + 2 / 60
    origin_latitude: float = 40 + 10 / 60
    origin_longitude: float = -74.0
    false_easting_m: float = 300000.0
    false_northing_m: float = 0.0
    metres_per_unit: float = 1200 / 3937
    rounds: int = 5

    @property
    def eccentricity(self) -> float:
        flattening = 1 / self.inverse_flattening
        return math.sqrt(2 * flattening - flattening * flattening)

    def _m(self, latitude: float) -> float:
        s = self.eccentricity * math.sin(latitude)
        return math.cos(latitude) / math.sqrt(1 - s * s)

    def _t(self, latitude: float) -> float:
        e = self.eccentricity
        s = e * math.sin(latitude)
        return math.tan(math.pi / 4 - latitude / 2) / ((1 - s) / (1 + s)) ** (e / 2)

    @property
    def cone(self) -> float:
        p1, p2 = math.radians(self.parallel_1), math.radians(self.parallel_2)
        return (math.log(self._m(p1)) - math.log(self._m(p2))) / (math.log(self._t(p1)) - math.log(self._t(p2)))

    @property
    def scale(self) -> float:
        """Radius per unit of t**n."""
        p1 = math.radians(self.parallel_1)
        return self.semi_major * self._m(p1) / (self.cone * self._t(p1) ** self.cone)

    @property
    def origin_radius(self) -> float:
        return self.scale * self._t(math.radians(self.origin_latitude)) ** self.cone


def to_longitude_latitude(x: Column, y: Column, projection: ConicProjection = ConicProjection()) -> tuple[Column, Column]:
    p = projection
    east = x * F.lit(p.metres_per_unit) - F.lit(p.false_easting_m)
    north = F.lit(p.origin_radius + p.false_northing_m) - y * F.lit(p.metres_per_unit)
    radius = F.sqrt(east * east + north * north)
    longitude = F.degrees(F.atan2(east, north) / F.lit(p.cone)) + F.lit(p.origin_longitude)
    t = F.pow(radius / F.lit(p.scale), F.lit(1 / p.cone))
    return longitude, F.degrees(_latitude(t, p))


def _latitude(t: Column, p: ConicProjection) -> Column:
    # (1 - s) / (1 + s) is written as 2 / (1 + s) - 1, so each round mentions the previous one once and
    # the expression grows linearly with the rounds.
    e = p.eccentricity
    latitude = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)
    for _ in range(p.rounds):
        s = F.lit(e) * F.sin(latitude)
        ratio = F.pow(F.lit(2.0) / (F.lit(1.0) + s) - F.lit(1.0), F.lit(e / 2))
        latitude = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t * ratio)
    return latitude
