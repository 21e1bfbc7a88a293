from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tripmill import fixtures
from tripmill.config import CleaningConfig
from tripmill.operators.cleaning import TripCleaner

START = datetime(2025, 1, 10, 8, 0, 0)
GOOD = dict(
    id=0,
    tpep_pickup_datetime=START,
    tpep_dropoff_datetime=START + timedelta(minutes=30),
    passenger_count=1.0,
    trip_distance=5.0,
    RatecodeID=1.0,
    PULocationID=1,
    DOLocationID=265,
    payment_type=1,
    fare_amount=20.0,
    extra=1.0,
    mta_tax=0.5,
    tip_amount=2.0,
    tolls_amount=0.0,
    congestion_surcharge=2.5,
    total_amount=26.0,
)
TYPES = (
    "id int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, "
    "trip_distance double, RatecodeID double, PULocationID int, DOLocationID int, payment_type int, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "congestion_surcharge double, total_amount double"
)
NAN = float("nan")
MONEY = ["fare_amount", "tip_amount", "total_amount", "extra", "tolls_amount", "congestion_surcharge", "mta_tax"]


def trips(spark, *changes):
    rows = [Row(**{**GOOD, "id": i, **change}) for i, change in enumerate(changes)]
    return spark.createDataFrame(rows, TYPES)


def kept(spark, *changes, config=CleaningConfig()):
    df = TripCleaner(config).clean(trips(spark, *changes))
    return sorted(r["id"] for r in df.select("id").collect())


def lasting(**delta):
    return {"tpep_dropoff_datetime": START + timedelta(**delta)}


def test_good_trip_stays(spark):
    assert kept(spark, {}) == [0]


@pytest.mark.parametrize("column", [*MONEY, "trip_distance", "passenger_count"])
def test_negative_null_and_nan_drop(spark, column):
    assert kept(spark, {}, {column: -0.5}, {column: None}, {column: NAN}) == [0]


def test_bounds_are_inclusive(spark):
    changes = [
        {"passenger_count": 6.0},
        {"trip_distance": 0.01},
        {"trip_distance": 50.0, **lasting(hours=4)},
        {"trip_distance": 50.0, **lasting(minutes=30)},
        {"tpep_pickup_datetime": datetime(2025, 1, 1), "tpep_dropoff_datetime": datetime(2025, 1, 1, 0, 30)},
        {"tpep_pickup_datetime": datetime(2025, 3, 31, 23, 59, 59), "tpep_dropoff_datetime": datetime(2025, 4, 1, 0, 30)},
        {"total_amount": 25.0},
        {"payment_type": 6, "RatecodeID": 6.0, "PULocationID": 265, "DOLocationID": 1},
    ]
    assert kept(spark, *changes) == list(range(len(changes)))


def test_outside_bounds_drop(spark):
    changes = [
        {"passenger_count": 0.0},
        {"passenger_count": 7.0},
        {"trip_distance": 0.009},
        {"trip_distance": 50.01},
        lasting(hours=4, microseconds=1),
        lasting(seconds=-1),
        lasting(seconds=0),
        {"trip_distance": 50.0, **lasting(minutes=29)},
        {"tpep_pickup_datetime": datetime(2025, 3, 31, 23, 59, 59, 500000), "tpep_dropoff_datetime": datetime(2025, 4, 1, 0, 30)},
        {"tpep_pickup_datetime": None},
        {"tpep_dropoff_datetime": None},
        {"total_amount": 24.99},
        {"fare_amount": 0.0},
        {"payment_type": 0},
        {"payment_type": None},
        {"RatecodeID": 99.0},
        {"RatecodeID": NAN},
        {"PULocationID": 0},
        {"DOLocationID": 266},
        {"DOLocationID": None},
    ]
    assert kept(spark, *changes) == []


def test_free_trip_stays(spark):
    assert kept(spark, {c: 0.0 for c in MONEY}) == [0]


def test_charge_rule_alone_takes_nulls_as_zero(spark):
    cleaner = TripCleaner()
    df = trips(spark, {"tip_amount": None}, {"tip_amount": NAN}, {"fare_amount": None}, {"total_amount": NAN}, {"total_amount": None})
    assert sorted(r["id"] for r in cleaner.apply(df, cleaner.charges(df)).collect()) == [0, 1, 2]


def test_codes_and_times_from_text(spark):
    df = spark.createDataFrame(
        [("2025-01-10 08:00:00", "2025-01-10 08:30:00", "1", "2.0", " 7 "), ("x", "2025-01-10 08:30:00", "1", "2", "7"),
         ("2025-01-10 08:00:00", "2025-01-10 08:30:00", "one", "2", "7"), ("2025-01-10 08:00:00", "2025-01-10 08:30:00", "1", "2", "")],
        "tpep_pickup_datetime string, tpep_dropoff_datetime string, payment_type string, rate_code string, pickup_location_id string",
    )
    out = TripCleaner().clean(df)
    assert dict(out.dtypes) == {
        "tpep_pickup_datetime": "timestamp_ntz",
        "tpep_dropoff_datetime": "timestamp_ntz",
        "payment_type": "bigint",
        "rate_code": "bigint",
        "pickup_location_id": "bigint",
    }
    assert [tuple(r) for r in out.collect()] == [(START, START + timedelta(minutes=30), 1, 2, 7)]


def test_rules_on_absent_columns_are_left_out(spark):
    df = spark.range(3)
    assert TripCleaner().rules(df) == []
    assert TripCleaner().clean(df).count() == 3
    assert TripCleaner().removals(df).count() == 0
    some = trips(spark, {}, {"fare_amount": -1.0}).select("id", "fare_amount")
    assert [r.name for r in TripCleaner().rules(some)] == ["negative fare_amount"]
    assert TripCleaner().clean(some).count() == 1


def test_thresholds_can_be_changed(spark):
    config = CleaningConfig(max_passengers=8, payment_types=(0,), location_columns=(), max_mph=5.0)
    assert kept(spark, {"passenger_count": 8.0, "payment_type": 0, "DOLocationID": 999, **lasting(hours=2)}, config=config) == [0]


def test_removals_and_kept_add_up(spark):
    df = fixtures.trips(spark, "/root/testdata/sf0.001")
    cleaner = TripCleaner(fixtures.CLEANING)
    removed = cleaner.removals(df).agg(F.sum("removed")).first()[0]
    assert removed + cleaner.clean(df).count() == df.count()


def test_cleaning_twice_and_in_any_order_changes_nothing(spark):
    df = fixtures.trips(spark, "/root/testdata/sf0.001")
    cleaner = TripCleaner(fixtures.CLEANING)
    once = cleaner.clean(df)
    assert sorted(cleaner.clean(once).collect()) == sorted(once.collect())
    backwards = cleaner.apply(df, list(reversed(cleaner.rules(df))))
    assert backwards.exceptAll(once).count() == 0 and once.count() == backwards.count()


def test_filters_reach_the_scan(spark, tmp_path, capsys):
    trips(spark, {}).write.parquet(str(tmp_path / "t"))
    df = TripCleaner().clean(spark.read.parquet(str(tmp_path / "t")))
    df.explain("formatted")
    plan = capsys.readouterr().out
    for pushed in ("GreaterThanOrEqual(fare_amount,0.0)", "LessThanOrEqual(trip_distance,50.0)", "In(payment_type"):
        assert pushed in plan
