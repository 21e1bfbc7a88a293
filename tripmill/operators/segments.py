"""Trip and tip segments by k-means."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.columns import round_even
from tripmill.operators.kmeans import Fit, fit
from tripmill.session import Stage

FEATURES = ("trip_duration_min", "fare_amount", "trip_distance")
TIP_FEATURES = ("fare_amount", "tip_amount")
# Names of the trip segments.
SHORT_TRIPS = "Economy / Short Trips"
LONG_TRIPS = "Premium / Long Trips"

Centroids = Sequence[Sequence[float]]


def fill_features(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    return df.na.fill(0, list(features))


def scaled(features: Sequence[str] = FEATURES) -> list[str]:
    return [f"{c}_scaled" for c in features]


def _one_if_zero(deviation: Column) -> Column:
    return F.coalesce(F.nullif(deviation, F.lit(0.0)), F.lit(1.0))


def scale(df: DataFrame, means: dict[str, Column], deviations: dict[str, Column]) -> DataFrame:
    return df.withColumns({name: (F.col(c) - means[c]) / deviations[c] for c, name in zip(means, scaled(list(means)))})


def standardise(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Zero mean and unit population deviation; a constant feature is only centred.

    The statistics are one scalar subquery, so the step stays lazy.
    """
    parts = [F.avg(c).alias(f"{c}_mean") for c in features]
    parts += [_one_if_zero(F.stddev_pop(c)).alias(f"{c}_deviation") for c in features]
    statistics = df.agg(F.struct(*parts).alias("statistics")).scalar()
    return scale(df, {c: statistics[f"{c}_mean"] for c in features}, {c: statistics[f"{c}_deviation"] for c in features})


def weighted_points(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Distinct points with their number of rows: the same clustering problem on fewer rows."""
    return df.groupBy(*features).agg(F.count("*").cast("double").alias("weight"))


def weighted_statistics(points: DataFrame, features: Sequence[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """Means and deviations of the rows behind weighted points, as literals to nine decimals.

    Two passes keep them exact; rounding frees them from the order of the sums.
    """
    nine = lambda x: round(x * 1e9) / 1e9
    total = F.sum("weight")
    first = points.agg(*[(F.sum(F.col(c) * F.col("weight")) / total).alias(c) for c in features]).first()
    means = {c: F.lit(nine(first[c])) for c in features}
    spread = {c: (F.col(c) - means[c]) * (F.col(c) - means[c]) * F.col("weight") for c in features}
    second = points.agg(*[_one_if_zero(F.sqrt(F.sum(spread[c]) / total)).alias(c) for c in features]).first()
    return means, {c: F.lit(nine(second[c]) or 1.0) for c in features}


def squared_distance(centroid: Sequence[float], features: Sequence[str]) -> Column:
    return reduce(add, [(F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x))) for c, x in zip(features, centroid)])


def assign(df: DataFrame, centroids: Centroids, features: Sequence[str], name: str) -> DataFrame:
    """Number of the nearest centroid, the lower one in a tie, as plain column arithmetic."""
    candidates = [
        F.struct(squared_distance(c, features).alias("distance"), F.lit(i).alias("number")) for i, c in enumerate(centroids)
    ]
    if not candidates:
        return df.withColumn(name, F.lit(None).cast("int"))
    nearest = F.least(*candidates)["number"] if len(candidates) > 1 else F.lit(0)
    return df.withColumn(name, nearest)


def segment_names(assigned: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """``(trip_cluster, trip_type)``: the cluster with the least mean of its raw feature means, and the other.

    A ``weight`` column counts rows. There is one row per cluster, two in all, which bounds the window.
    """
    weight = F.col("weight") if "weight" in assigned.columns else F.lit(1.0)
    means = assigned.groupBy("trip_cluster").agg(*[(F.sum(F.col(c) * weight) / F.sum(weight)).alias(c) for c in features])
    level = reduce(add, [F.col(c) for c in features]) / F.lit(float(len(features)))
    place = F.row_number().over(Window.orderBy("level", "trip_cluster"))
    return means.select("trip_cluster", level.alias("level")).select(
        "trip_cluster", F.when(place == 1, SHORT_TRIPS).otherwise(LONG_TRIPS).alias("trip_type")
    )


def name_segments(assigned: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Rows with the name of their cluster; the names are one row per cluster and are broadcast."""
    return assigned.join(F.broadcast(segment_names(assigned, features)), "trip_cluster")


def segment_statistics(named: DataFrame) -> DataFrame:
    means = [round_even(F.avg(c)).alias(c) for c in ("trip_distance", "trip_duration_min", "fare_amount")]
    return named.groupBy("trip_type").agg(*means, F.count("trip_cluster").alias("count"))


def segments_by_hour(named: DataFrame) -> DataFrame:
    return named.groupBy("hour", "trip_type").agg(F.count("*").alias("count"))


def segment_sizes(named: DataFrame) -> DataFrame:
    return named.groupBy("trip_type").agg(F.count("*").alias("trip_count")).orderBy(F.desc("trip_count"), "trip_type")


def trip_segments(trips: DataFrame, stage: Stage, restarts: int = 10, seed: int = 42) -> tuple[DataFrame, Fit]:
    """Standardise, fit two clusters, assign every trip and name the clusters.

    Statistics, training and names need only the distinct points, which are stored; the trips are read
    twice, for the points and for the result.
    """
    ready = fill_features(trips)
    points = stage.save(weighted_points(ready, FEATURES), "points")
    if points.isEmpty():
        nothing = F.lit(None).cast("int"), F.lit(None).cast("string")
        return ready.withColumns({"trip_cluster": nothing[0], "trip_type": nothing[1]}), Fit([], 0.0, [])
    statistics = weighted_statistics(points, FEATURES)
    best = fit(scale(points, *statistics), scaled(), 2, seed=seed, restarts=restarts)

    def assigned(df: DataFrame) -> DataFrame:
        return assign(scale(df, *statistics), best.centroids, scaled(), "trip_cluster")

    names = segment_names(assigned(points))
    return assigned(ready).join(F.broadcast(names), "trip_cluster"), best


def tip_segments(
    points: DataFrame, stage: Stage, k: int = 3, restarts: int = 10, seed: int = 42
) -> tuple[DataFrame, Fit]:
    """Clusters of unscaled fare and tip: ``(cluster, fare_amount, tip_amount, trips)``.

    ``points`` are distinct pairs with weights. Clusters are numbered by the fare of their centroid.
    """
    points = stage.save(points, "points")
    best = fit(points, TIP_FEATURES, k, seed=seed, restarts=restarts)
    counts = assign(points, best.centroids, TIP_FEATURES, "cluster").groupBy("cluster").agg(
        F.sum("weight").cast("bigint").alias("trips")
    )
    rows = [(i, *c) for i, c in enumerate(best.centroids)]
    centroids = points.sparkSession.createDataFrame(rows, "cluster int, fare_amount double, tip_amount double")
    joined = centroids.join(counts, "cluster", "left").withColumn("trips", F.coalesce("trips", F.lit(0)))
    return joined.orderBy("cluster"), best
