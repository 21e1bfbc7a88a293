"""Every registered query against its SQL twin, on the smallest data."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from tripmill import oracle
from tripmill import queries as registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLE = oracle.sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_entry_registers_all():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []


def test_entry_is_the_weekday_revenue(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["day_of_week", "total_revenue", "total_fare", "total_tip"]
    assert df.count() == 7


def test_trained_queries(spark):
    stats = {r["trip_type"]: r for r in QUERIES["m03_trip_segments"](spark, SF_DIR).collect()}
    assert set(stats) == {"Economy / Short Trips", "Premium / Long Trips"}
    trips = QUERIES["q12_clustering"](spark, SF_DIR).count()
    assert sum(r["count"] for r in stats.values()) == trips
    centroids = QUERIES["m10_tip_centroids"](spark, SF_DIR).collect()
    fares = [r["fare_amount"] for r in centroids]
    assert fares == sorted(fares) and len(fares) == 3
    assert sum(r["trips"] for r in centroids) == QUERIES["q13_cluster_data"](spark, SF_DIR).count()
    by_cluster = QUERIES["m09_tip_clusters"](spark, SF_DIR).groupBy("cluster").count().collect()
    assert {r["cluster"]: r["count"] for r in by_cluster} == {r["cluster"]: r["trips"] for r in centroids}
