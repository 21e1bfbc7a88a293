import random

import pytest
from pyspark.sql import functions as F

from tripmill.operators import sampling, segments
from tripmill.session import Stage


@pytest.fixture(scope="module")
def trips(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1200):
        long = i % 3 == 0
        rows.append((i, rng.gauss(60 if long else 12, 3), rng.gauss(50 if long else 9, 2), rng.gauss(15 if long else 2, 0.3), i % 24))
    rows += [(1200 + i, 10.0, 8.0, 2.0, 5) for i in range(600)]
    return spark.createDataFrame(rows, "id int, trip_duration_min double, fare_amount double, trip_distance double, hour int")


def nearest(row, centroids, features):
    return min(range(len(centroids)), key=lambda k: (sum((row[f] - c) ** 2 for f, c in zip(features, centroids[k])), k))


def test_standardise(spark, trips):
    constant = trips.withColumn("fare_amount", F.lit(4.0))
    row = segments.standardise(constant).agg(
        F.avg("trip_duration_min_scaled"), F.stddev_pop("trip_duration_min_scaled"), F.max(F.abs("fare_amount_scaled"))
    ).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == 0.0


def test_fill_features(spark):
    df = spark.createDataFrame([(None, 1.0, None)], "trip_duration_min double, fare_amount double, trip_distance double")
    assert tuple(segments.fill_features(df).first()) == (0.0, 1.0, 0.0)


def test_assign_is_nearest_and_ties_go_down(spark, trips):
    centroids = [[10.0, 9.0, 2.0], [60.0, 50.0, 15.0], [30.0, 30.0, 5.0]]
    out = segments.assign(trips, centroids, segments.FEATURES, "k").collect()
    assert all(r["k"] == nearest(r, centroids, segments.FEATURES) for r in out)
    tie = spark.createDataFrame([(5.0,)], "x double")
    assert segments.assign(tie, [[4.0], [6.0]], ["x"], "k").first()["k"] == 0
    assert segments.assign(tie, [[4.0]], ["x"], "k").first()["k"] == 0


def test_trip_segments(spark, trips):
    named, best = segments.trip_segments(trips, Stage(spark), restarts=3)
    assert len(best.costs) == 3 and best.cost == min(best.costs)
    rows = named.collect()
    assert len(rows) == trips.count()
    assert all(r["trip_cluster"] == nearest(r, best.centroids, segments.scaled()) for r in rows)
    assert all((r["trip_type"] == segments.LONG_TRIPS) == (r["id"] < 1200 and r["id"] % 3 == 0) for r in rows)
    cost = sum(sum((r[f] - c) ** 2 for f, c in zip(segments.scaled(), best.centroids[r["trip_cluster"]])) for r in rows)
    assert cost == pytest.approx(best.cost, rel=1e-9)
    sizes = [tuple(r) for r in segments.segment_sizes(named).collect()]
    assert sizes == [(segments.SHORT_TRIPS, 1400), (segments.LONG_TRIPS, 400)]


def test_weights_stand_for_copies(spark, trips):
    points = segments.weighted_points(trips, segments.FEATURES)
    assert points.count() < trips.count()
    assert points.agg(F.sum("weight")).first()[0] == trips.count()


def test_no_trips(spark, trips):
    named, best = segments.trip_segments(trips.limit(0), Stage(spark))
    assert named.count() == 0 and best.centroids == []
    points = spark.createDataFrame([], "fare_amount double, tip_amount double, weight double")
    assert segments.tip_segments(points, Stage(spark))[0].count() == 0


def test_targets():
    assert sampling.stratum_targets({"a": 900_000, "b": 100, "c": 10}) == {"a": 49993, "b": 100, "c": 10}


def expected_sample(trips, key, targets, stratum):
    """The smallest hashes of each stratum, by sorting everything."""
    rows = trips.withColumn("u", sampling.hash_unit(key, 42)).collect()
    wanted = set()
    for name, n in targets.items():
        ranked = sorted((r["u"], r["id"]) for r in rows if r[stratum] == name)
        wanted |= {i for _, i in ranked[:n]}
    return wanted


@pytest.mark.parametrize("partitions", [1, 13])
def test_sample_is_exact_and_stable(spark, trips, partitions):
    df = trips.withColumn("kind", F.when(F.col("id") < 30, "rare").otherwise("common")).repartition(partitions)
    sample = sampling.stratified_sample(df, "kind", ["id"], Stage(spark), total=200, floor=20)
    targets = sampling.stratum_targets({"rare": 30, "common": 1770}, 200, 20)
    got = [r["id"] for r in sample.collect()]
    assert len(got) == len(set(got)) == sum(targets.values())
    assert set(got) == expected_sample(df, ["id"], targets, "kind")
    assert sample.columns == df.columns


def test_sample_that_comes_out_short_is_read_again(spark, trips, monkeypatch):
    df = trips.withColumn("kind", F.lit("all"))
    monkeypatch.setattr(sampling, "SPARE", 0)
    for slack in (0.0, -10.0, -30.0):
        monkeypatch.setattr(sampling, "SLACK", slack)
        got = {r["id"] for r in sampling.stratified_sample(df, "kind", ["id"], Stage(spark), total=500).collect()}
        assert got == expected_sample(df, ["id"], {"all": 500}, "kind")


def test_sample_looks_at_few_rows_more_than_it_takes(spark, monkeypatch):
    saved = {}
    inner = Stage.save

    def watched(self, df, name):
        out = inner(self, df, name)
        saved[name] = out.count()
        return out

    monkeypatch.setattr(Stage, "save", watched)
    df = spark.range(40_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS kind")
    assert sampling.stratified_sample(df, "kind", ["id"], Stage(spark), total=2000).count() == 1999
    assert 1999 <= saved["candidates"] < 2600


def test_sample_of_everything_and_of_nothing(spark, trips):
    df = trips.withColumn("kind", F.lit("all"))
    assert sampling.stratified_sample(df, "kind", ["id"], Stage(spark)).count() == df.count()
    assert sampling.stratified_sample(df.limit(0), "kind", ["id"], Stage(spark)).count() == 0


def test_sample_of_rows_that_share_a_key(spark):
    df = spark.range(100_000).selectExpr("1 AS same", "'all' AS kind", "id")
    drawn = sampling.stratified_sample(df, "kind", ["same"], Stage(spark), total=100)
    assert drawn.columns == df.columns
    assert len({r["id"] for r in drawn.collect()}) == 100


def test_sample_of_a_number_of_rows(spark, trips):
    got = sampling.sample_rows(trips, 50, ["id"], Stage(spark))
    assert {r["id"] for r in got.collect()} == expected_sample(trips.withColumn("all", F.lit(1)), ["id"], {1: 50}, "all")
    assert got.columns == trips.columns
    assert sampling.sample_rows(trips, 10_000, ["id"], Stage(spark)).count() == trips.count()
