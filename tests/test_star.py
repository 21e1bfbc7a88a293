import random
from datetime import date, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tripmill import fixtures
from tripmill.functions.columns import hour_floor
from tripmill.operators import keys, star
from tripmill.operators.cleaning import TripCleaner
from tripmill.session import Stage
from tripmill.sources import files

TYPES = (
    "id int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, fare_amount double, "
    "tip_amount double, total_amount double, VendorID int"
)


def trips(spark, *rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], TYPES)


def at(hour, minute=0, second=0, day=9, month=3, micro=0):
    return datetime(2025, month, day, hour, minute, second, micro)


def test_required_columns(spark):
    with pytest.raises(ValueError, match="tpep_dropoff_datetime"):
        star.build_star(spark.createDataFrame([(at(1),)], "tpep_pickup_datetime timestamp_ntz"), Stage(spark))


def test_metrics(spark):
    rows = [
        (at(1), at(1, 0, 1), 3.0, 1.0, 4.0, 1),
        (at(1), at(0, 59, 50), 0.0, 1.0, 4.0, 1),
        (at(1), None, 0.0, 0.0, 4.0, 1),
        (at(1), at(1, 10), None, 1.0, 4.0, 1),
        (at(1), at(1, 10), float("nan"), 1.0, 4.0, 1),
        (at(1), at(1, 10), 1e-300, 1e300, 4.0, 1),
        (at(1), at(1, 0, 0, micro=300000), 8.0, 1.0, 4.0, 1),
    ]
    out = star.add_metrics(trips(spark, *rows)).orderBy("id").collect()
    assert [r["trip_duration_min"] for r in out] == [0.02, -0.17, None, 10.0, 10.0, 10.0, 0.0]
    assert [r["tip_percentage"] for r in out] == [33.33, 0.0, 0.0, 0.0, 0.0, 0.0, 12.5]
    without = star.add_metrics(trips(spark, rows[0]).drop("tip_amount"))
    assert without.first()["tip_percentage"] is None and dict(without.dtypes)["tip_percentage"] == "double"


def test_hours_do_not_follow_a_time_zone(spark):
    """02:30 does not exist on this day in some zones."""
    rows = [(at(2, 30), at(3), 1.0, 1.0, 1.0, 1), (at(2, 59, 59, micro=999999), at(3), 1.0, 1.0, 1.0, 1), (None, at(3), 1.0, 1.0, 1.0, 1)]
    hours = star.distinct_hours(trips(spark, *rows)).collect()
    assert [r["full_datetime"] for r in hours] == [at(2)]


def test_hours_of_any_age(spark):
    moments = [datetime(1, 1, 1, 5, 7), datetime(1969, 12, 31, 22, 59, 59, 999999), datetime(1969, 12, 31, 23), datetime(9999, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    got = [r[0] for r in df.select(hour_floor(F.col("t"))).collect()]
    assert got == [m.replace(minute=0, second=0, microsecond=0) for m in moments]


def test_hour_keys_over_years(spark):
    moments = [datetime(y, m, d, h) for y in (2020, 2021, 2024) for m, d, h in ((1, 1, 0), (6, 15, 12), (12, 31, 23))]
    rows = [(m, m, 1.0, 1.0, 1.0, 1) for m in moments * 2]
    random.Random(1).shuffle(rows)
    out = star.build_dim_datetime(trips(spark, *rows), Stage(spark)).orderBy("datetime_id").collect()
    assert [r["full_datetime"] for r in out] == moments
    assert [r["datetime_id"] for r in out] == list(range(1, 10))
    first = out[3].asDict()
    assert (first["date"], first["week"], first["quarter"], first["season"]) == (date(2021, 1, 1), 53, 1, "Winter")
    assert [out[i]["season"] for i in (1, 2)] == ["Summer", "Winter"]


def combinations(spark, n=3000):
    """Distinct rows of which more than a third share the first column, with nulls and NaN-free doubles."""
    rng = random.Random(7)
    rows = {(5.0 if rng.random() < 0.4 else rng.choice([None, *map(float, range(40))]), rng.choice([None, *map(float, range(60))]), float(rng.randrange(50))) for _ in range(n)}
    return spark.createDataFrame(list(rows), "a double, b double, c double")


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_dense_key_is_the_global_row_number(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = combinations(spark).repartition(partitions)
        keyed = keys.dense_key(df, ["a", "b", "c"], "key", Stage(spark))
        got = {(r["a"], r["b"], r["c"]): r["key"] for r in keyed.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ordered = sorted(got, key=lambda t: tuple((v is not None, v or 0.0) for v in t))
    assert [got[t] for t in ordered] == list(range(1, len(got) + 1))
    assert len(got) == df.count()


@pytest.fixture(scope="module")
def cleaned(spark):
    raw = fixtures.trips(spark, "/root/testdata/sf0.001")
    return Stage(spark).save(TripCleaner(fixtures.CLEANING).clean(raw), "cleaned")


def restored(built):
    return built.with_fares(built.fact_trips.select("event_id", "fare_id"), *star.money_columns(built.dim_fare)).drop("fare_id")


def test_star_restores_the_money(spark, cleaned):
    built = star.build_star(cleaned, Stage(spark))
    assert built.fact_trips.count() == cleaned.count()
    wanted = cleaned.select("event_id", *star.money_columns(built.dim_fare))
    assert restored(built).exceptAll(wanted).count() == 0
    assert wanted.exceptAll(restored(built)).count() == 0
    columns = built.fact_trips.columns
    assert columns[columns.index("datetime_id") + 1] == "fare_id"
    assert not set(columns) & set(star.money_columns(cleaned))


def test_large_dimension_path_gives_the_same_star(spark, cleaned, monkeypatch, capsys):
    """Sizes that do not fit a broadcast: hot combinations are salted, and facts are read once."""
    rows = cleaned.withColumn("event_id", F.monotonically_increasing_id())
    skewed = rows.unionByName(rows.limit(1).select(*rows.columns).join(spark.range(300).withColumnRenamed("id", "copy")).drop("copy"))
    skewed = Stage(spark).save(skewed, "skewed")
    plain = star.build_star(skewed, Stage(spark))
    split = star.build_star(skewed, Stage(spark), broadcast_bytes=0, hot_share=0.05)
    assert 0 < split.hot_fares.count() < split.fare_rows
    same = ["event_id", "datetime_id", "fare_id", "trip_duration_min", "tip_percentage"]
    assert sorted(split.fact_trips.select(same).collect()) == sorted(plain.fact_trips.select(same).collect())
    assert sorted(restored(split).collect()) == sorted(restored(plain).collect())
    split.with_fares(skewed.select("event_id", F.lit(1).cast("bigint").alias("fare_id"), "PULocationID"), "tip_amount").explain()
    plan = capsys.readouterr().out.split("== Initial Plan ==")[-1]
    # One scan of facts, one of the dimension, and the hot keys on either side.
    assert plan.count("skewed-") == 1 and plan.count("FileScan") <= 4


def test_hot_keys_are_spread_over_salts(spark):
    """A third of the facts share one key, another tenth a null one."""
    key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id % 500 END AS k"
    facts = spark.range(30_000).selectExpr("id", key)
    dimension = spark.range(500).selectExpr("id AS k", "id * 10 AS v").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, -1L AS v"))
    hot = dimension.where("k = 7 OR k IS NULL")
    left, right = keys.salted_sides(facts, dimension, ["k"], hot, True)
    most = left.groupBy("k", "_salt").count().agg(F.max("count")).first()[0]
    assert most < 30_000 / 3 / keys.SALTS * 1.5
    assert right.count() == dimension.count() + 2 * (keys.SALTS - 1)
    for how, null_safe in (("left", True), ("inner", True), ("inner", False), ("left", False)):
        got = keys.hot_split_join(facts, dimension, ["k"], hot, False, how, null_safe)
        plain = keys.hot_split_join(facts, dimension, ["k"], None, True, how, null_safe)
        assert got.columns == plain.columns and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_nulls_and_negative_zero_in_money(spark, monkeypatch):
    rows = [(at(1), at(2), None, None, 1.0, 1), (at(1), at(2), None, None, 1.0, 2), (at(1), at(2), -0.0, 1.0, 1.0, 3), (at(1), at(2), 0.0, 1.0, 1.0, 4), (at(1), at(2), float("nan"), None, 1.0, 5)]
    for fits in (True, False):
        monkeypatch.setattr(star, "fits_broadcast", lambda *a, fits=fits, **k: fits)
        built = star.build_star(trips(spark, *rows), Stage(spark))
        assert built.dim_fare.count() == 2
        ids = {r["id"]: r["fare_id"] for r in built.fact_trips.collect()}
        assert ids == {0: 1, 1: 1, 2: 2, 3: 2, 4: 1}


def test_no_money_columns(spark):
    df = trips(spark, (at(1), at(2), 1.0, 1.0, 1.0, 1), (None, at(2), 1.0, 1.0, 1.0, 1)).drop("fare_amount", "tip_amount", "total_amount")
    built = star.build_star(df, Stage(spark))
    assert [tuple(r) for r in built.dim_fare.collect()] == [(1,)]
    assert sorted((r["id"], r["datetime_id"], r["fare_id"]) for r in built.fact_trips.collect()) == [(0, 1, 1), (1, None, 1)]


def test_empty_input(spark):
    built = star.build_star(trips(spark), Stage(spark))
    assert built.fact_trips.count() == 0 and built.dim_fare.count() == 0 and built.dim_datetime.count() == 0


def test_star_in_another_session_zone(spark):
    columns = "CAST(p AS TIMESTAMP_NTZ) AS tpep_pickup_datetime, CAST(p AS TIMESTAMP_NTZ) + INTERVAL 7 MINUTES AS tpep_dropoff_datetime"
    hours = ("2024-03-10 02:30:00", "2024-03-10 10:30:00", "2024-11-03 01:30:00", "1969-12-31 23:10:00")
    query = f"SELECT {columns}, 5.0D AS fare_amount FROM VALUES {', '.join(f'({h!r})' for h in hours)} t(p)"
    results = []
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            built = star.build_star(spark.sql(query), Stage(spark))
            hours_found = sorted(map(tuple, built.dim_datetime.collect()))
            results.append((hours_found, sorted(r["datetime_id"] for r in built.fact_trips.collect())))
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
    assert results[0] == results[1] and results[0][1] == [1, 2, 3, 4]


def test_fares_in_order_of_first_appearance(spark, cleaned, tmp_path):
    """Numbered by files in order of their names and rows in order of their places, whatever the partitions."""
    money = star.money_columns(cleaned)
    for month in ("b", "a"):
        part = cleaned.filter(F.col("event_id") % 2 == int(month == "a")).orderBy(F.xxhash64("event_id"))
        part.coalesce(1).write.option("parquet.block.size", 4096).parquet(str(tmp_path / f"{month}.parquet"))
    placed = files.read_trips(spark, str(tmp_path), positions=True)
    rows = sorted(placed.select(*star.POSITION, "event_id", *money).collect(), key=lambda r: (r[0], r[1]))
    assert len({(r[0], r[1]) for r in rows}) == len(rows) == cleaned.count()
    want: dict = {}
    ids = {r["event_id"]: want.setdefault(tuple(r[3:]), len(want) + 1) for r in rows}
    for limit in (star.BROADCAST_BYTES, 0):
        built = star.build_star(placed.repartition(5), Stage(spark), broadcast_bytes=limit, hot_share=0.05, position=star.POSITION)
        assert {tuple(r[c] for c in money): r["fare_id"] for r in built.dim_fare.collect()} == want
        assert {r["event_id"]: r["fare_id"] for r in built.fact_trips.select("event_id", "fare_id").collect()} == ids
        assert not set(star.POSITION) & set(built.fact_trips.columns) and "first_seen" not in built.dim_fare.columns
    plain = star.build_star(placed, Stage(spark))
    assert plain.fact_trips.columns == star.build_star(cleaned, Stage(spark)).fact_trips.columns
