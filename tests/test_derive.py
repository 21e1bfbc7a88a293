import itertools
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tripmill.plans import derive

MONTHLY = "year int, month int, avg_duration double, trip_count bigint"


def test_kpis(spark):
    df = spark.createDataFrame([(2025, 1, 10.0, 1), (2025, 2, 20.0, 3), (2025, 3, None, 5)], MONTHLY)
    assert tuple(derive.kpis(df).first()) == (15.0, 17.5, 9)
    assert tuple(derive.kpis(df.limit(0)).first()) == (0.0, 0.0, 0)
    assert tuple(derive.kpis(df.filter("month = 3")).first()) == (0.0, 0.0, 5)


def test_heatmap_pivot(spark):
    df = spark.createDataFrame([(2, 0, 5), (12, 6, 7), (2, 6, 1)], "month int, day_of_week int, trip_count bigint")
    out = derive.heatmap_pivot(df)
    assert out.columns == ["day_of_week", "February", "December", "day_name"]
    rows = out.collect()
    assert [r["day_of_week"] for r in rows] == list(range(7))
    assert tuple(rows[6]) == (6, 1, 7, "Saturday") and tuple(rows[3]) == (3, 0, 0, "Wednesday")
    assert derive.heatmap_pivot(df, [1]).columns == ["day_of_week", "January", "day_name"]


def test_labels(spark):
    df = spark.createDataFrame([(132, 5), (264, 4), (3, 3), (4, 2), (5, 1)], "location_id int, trip_count bigint")
    lookup = spark.createDataFrame([(264, "Unknown", "N/A", "x"), (3, "", "Only Zone", "x"), (4, "B", "", "x")], "LocationID int, Borough string, Zone string, service_zone string")
    got = {r["location_id"]: r["zone_label"] for r in derive.zone_labels(df, lookup).collect()}
    assert got == {132: "JFK Airport", 264: "N/A (Unknown)", 3: "Only Zone", 4: "Zone 4", 5: "Zone 5"}
    top = derive.top_pickup_labels(df.withColumnRenamed("location_id", "pulocationid"), lookup)
    assert [r["trip_count"] for r in top.collect()] == [1, 2, 3, 4, 5]


def test_shares_and_markers(spark):
    df = spark.createDataFrame([(1, 1000, "a"), (2, 250, "b")], "location_id int, trip_count bigint, zone_label string")
    assert sum(r["percent"] for r in derive.shares(df).collect()) == pytest.approx(100)
    rows = derive.markers(df).orderBy("location_id").collect()
    assert [r["size"] for r in rows] == [26.0, 16.0]
    assert rows[0]["text"] == "a<br>Trips: 1,000"


def test_located(spark):
    counts = spark.createDataFrame([(1, 5), (2, 6)], "location_id int, trip_count bigint")
    centroids = spark.createDataFrame([(1, 0.5, 1.5), (3, 2.0, 2.0)], "location_id int, lon double, lat double")
    assert [tuple(r) for r in derive.locate(counts, centroids).collect()] == [(1, 5, 0.5, 1.5)]
    assert tuple(derive.locate_report(counts, centroids).first()) == (2, 1, 1)


def test_correlation_is_pairwise_complete(spark):
    rng = random.Random(5)
    data = [(x := rng.random(), None if rng.random() < 0.3 else x + rng.random(), None if rng.random() < 0.5 else rng.random(), 4.0, None) for _ in range(400)]
    df = spark.createDataFrame(data, "a double, b double, c double, constant double, empty double").repartition(7)
    got = {(r["variable"], r["other"]): r["correlation"] for r in derive.correlation_matrix(df, df.columns).collect()}
    assert len(got) == 25
    for (i, x), (j, y) in itertools.product(enumerate(df.columns), repeat=2):
        pairs = [(row[i], row[j]) for row in data if row[i] is not None and row[j] is not None]
        if {x, y} & {"constant", "empty"}:
            assert got[x, y] is None
        else:
            assert got[x, y] == pytest.approx(statistics.correlation(*zip(*pairs)), abs=1e-12)
            assert got[x, y] == pytest.approx(got[y, x], abs=1e-12)


def test_correlation_far_from_zero(spark):
    """Values of a small spread around a large one, with a constant that binary fractions cannot hold."""
    rng = random.Random(8)
    data = [(1e9 + (x := rng.random()), 1e9 - x + rng.random() / 10, 0.1, None if rng.random() < 0.5 else 0.3) for _ in range(500)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double").repartition(5)
    got = {(r["variable"], r["other"]): r["correlation"] for r in derive.correlation_matrix(df, df.columns).collect()}
    assert got["a", "b"] == pytest.approx(statistics.correlation([r[0] - 1e9 for r in data], [r[1] - 1e9 for r in data]), abs=1e-9)
    assert got["a", "c"] is None and got["d", "a"] is None and got["c", "c"] is None


def test_correlation_groups_rows_before_it_makes_pairs(spark):
    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS a", "IF(id % 3 = 0, NULL, CAST(id % 7 AS DOUBLE)) AS b")
    plan = derive.correlation_matrix(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range") == 1 and plan.rindex("Generate inline") < plan.rindex("Aggregate [known")


def test_correlation_text(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.5, 1.0), (4.0, 5.0, 1.0)], "trip_distance double, tip_amount double, other double")
    matrix = derive.display_names(derive.correlation_matrix(df, df.columns))
    row = {(r["variable"], r["other"]): r["text"] for r in matrix.collect()}
    assert row["Trip Distance", "Tip Amount"] == "0.85" and row["other", "Tip Amount"] is None
