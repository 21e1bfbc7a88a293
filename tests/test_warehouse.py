import uuid
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripmill import fixtures
from tripmill.config import QualityConfig
from tripmill.operators.quality import QualityCheckError, StarChecker
from tripmill.plans import load
from tripmill.plans.marts import Marts
from tripmill.session import Stage, shared_folder
from tripmill.sources.warehouse import Warehouse

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trips(spark):
    return Stage(spark).save(fixtures.trips(spark, SF_DIR), "trips")


@pytest.fixture(scope="module")
def warehouse(spark, trips):
    name = f"test_{uuid.uuid4().hex[:8]}"
    built = Warehouse(spark, name, f"{shared_folder(spark)}/{name}")
    load.load_trips(trips, built, fixtures.CLEANING)
    load.load_weather(fixtures.weather(trips), built)
    return built


def test_create_twice_and_drop(spark):
    name = f"test_{uuid.uuid4().hex[:8]}"
    warehouse = Warehouse(spark, name, f"{shared_folder(spark)}/{name}").create().create()
    warehouse.save_dimension(spark.range(3), "small")
    assert warehouse.table("small").count() == 3
    warehouse.save_dimension(spark.range(0), "small")
    assert warehouse.table("small").count() == 0
    warehouse.drop(["small", "never_there"])
    assert not warehouse.exists("small")


def test_fact_is_partitioned_and_the_helper_is_hidden(spark, warehouse):
    assert "pickup_month" not in warehouse.table("fact_trips").columns
    months = {r["pickup_month"].month for r in warehouse.load_star().fact_trips.select("pickup_month").distinct().collect()}
    assert months == {1, 2, 3}
    compact = warehouse.save_fact(warehouse.table("fact_trips"), "fact_compact", compact=True)
    assert sorted(compact.collect()) == sorted(warehouse.table("fact_trips").collect())


def test_year_filter_prunes_months(spark, warehouse, capsys):
    marts = Marts(warehouse.load_star(), fixtures.MARTS)
    marts.monthly().explain("formatted")
    shown = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(pickup_month" in shown
    assert "ReadSchema: struct<trip_duration_min:double,datetime_id:bigint>" in shown
    later = Marts(warehouse.load_star(), replace(fixtures.MARTS, year=2025))
    assert later.monthly().count() == 0 and later.fare_weekday().count() == 0 and later.correlation().count() == 0


def test_query(warehouse, spark):
    assert warehouse.query("SELECT count(*) AS n FROM fact_trips").first()["n"] == warehouse.table("fact_trips").count()
    assert spark.catalog.currentDatabase() == "default"
    with pytest.raises(AnalysisException):
        warehouse.query("SELECT * FROM nowhere")
    assert warehouse.query("SELECT * FROM nowhere", on_error="empty").count() == 0


def test_checks_pass_on_the_stored_star(warehouse, trips):
    from tripmill.operators.cleaning import TripCleaner

    checker = StarChecker(TripCleaner(fixtures.CLEANING).clean(trips), warehouse.load_star(), fixtures.QUALITY)
    assert all(r["passed"] for r in checker.report().collect())
    checker.raise_on_failure()


def test_first_failure_is_raised_with_a_preview(warehouse, trips):
    star = warehouse.load_star()
    with pytest.raises(QualityCheckError, match="row_count: "):
        StarChecker(trips, star, fixtures.QUALITY).raise_on_failure()
    for check in ("hour_coverage", "input_range"):
        with pytest.raises(QualityCheckError, match=f"{check}: .*datetime"):
            StarChecker(trips, star, fixtures.QUALITY).raise_on_failure([check])
    narrow = QualityConfig(datetime(2024, 2, 1), datetime(2024, 2, 2))
    for check in ("hour_range", "fact_range"):
        with pytest.raises(QualityCheckError, match=check):
            StarChecker(trips, star, narrow).raise_on_failure([check])
    bad = replace(star, fact_trips=star.fact_trips.withColumn("trip_distance", -F.col("trip_distance")))
    with pytest.raises(QualityCheckError, match="non_negative fact trip_distance: .*-"):
        StarChecker(trips, bad, fixtures.QUALITY).raise_on_failure(["non_negative"])


def test_null_values_pass_the_checks(warehouse, trips):
    star = warehouse.load_star()
    empty = replace(star, fact_trips=star.fact_trips.withColumns({"trip_distance": F.lit(None).cast("double"), "datetime_id": F.lit(None).cast("bigint")}))
    StarChecker(trips, empty, QualityConfig(datetime(2024, 1, 1), datetime(2025, 1, 1))).raise_on_failure(["non_negative", "fact_range"])


def test_failed_check_keeps_the_current_star(warehouse, trips):
    before = warehouse.table("fact_trips").count()
    with pytest.raises(QualityCheckError):
        load.load_trips(trips, warehouse, fixtures.CLEANING, QualityConfig(datetime(2020, 1, 1), datetime(2020, 1, 2)))
    assert warehouse.table("fact_trips").count() == before
    assert warehouse.load_star().dim_weather is not None


def test_weather_trouble_is_reported_only(warehouse, trips, caplog):
    broken = trips.selectExpr("CAST(raise_error('no weather') AS STRING) AS datetime", "1D AS temp")
    star = load.load_weather(broken, warehouse)
    assert "weather dimension not loaded" in caplog.text
    assert star.fact_trips.count() > 0
    assert load.load_weather(None, warehouse).hour_rows == star.hour_rows
    load.load_weather(fixtures.weather(trips), warehouse)


def test_failed_weather_reload_keeps_the_stored_dimension(warehouse, trips):
    load.load_weather(fixtures.weather(trips), warehouse)
    before = sorted(map(str, warehouse.table("dim_weather").collect()))
    broken = trips.selectExpr("CAST(raise_error('no weather') AS STRING) AS datetime", "1D AS temp")
    star = load.load_weather(broken, warehouse)
    assert sorted(map(str, star.dim_weather.collect())) == before


def write_load(warehouse, mark):
    """A small load whose tables all carry the same mark."""
    spark = warehouse.spark
    for table in ("dim_datetime", "dim_fare", *(["hot_fares"] if mark % 2 else [])):
        warehouse.save(spark.range(mark).select(F.lit(mark).alias("mark")), table)
    fact = spark.range(mark).select(F.lit(mark).alias("mark"), F.lit(datetime(2024, 1, 1)).alias("tpep_pickup_datetime"))
    warehouse.save_fact(fact, warehouse.pending("fact_trips"))


def marks(spark, name):
    """Marks that a reader sees who knows only the name of the database: by table, by SQL, and in the star."""
    reader = Warehouse(spark, name)
    star = reader.load_star()
    tables = [star.dim_datetime, star.dim_fare, star.fact_trips, *([star.hot_fares] if star.hot_fares else [])]
    sql = "SELECT f.mark AS a, d.mark AS b, count(*) AS n FROM fact_trips f CROSS JOIN dim_fare d GROUP BY ALL"
    seen = {r["mark"] for t in tables for r in t.select("mark").collect()}
    seen |= {r["mark"] for r in reader.table("fact_trips").select("mark").collect()}
    joined = reader.query(sql).collect()
    return seen | {m for r in joined for m in (r["a"], r["b"])}, [r["n"] for r in joined]


class Killed(Exception):
    pass


def test_readers_see_one_whole_load_wherever_a_load_stops(spark, monkeypatch):
    """Every statement and every write of a load is a place to stop, before it is done or right after."""
    name = f"test_{uuid.uuid4().hex[:8]}"
    place = f"{shared_folder(spark)}/{name}"
    first = Warehouse(spark, name, place)
    first.begin()
    write_load(first, 3)
    first.publish()
    assert marks(spark, name) == ({3}, [9])
    session, write = type(spark), first.spark.range(1).write.__class__
    sql, save, state = session.sql, write.saveAsTable, {}

    def stopping(inner):
        def run(self, *arguments, **named):
            state["step"] += 1
            if state["step"] == state["stop"] and not state["after"]:
                raise Killed
            result = inner(self, *arguments, **named)
            if state["step"] == state["stop"]:
                raise Killed
            return result

        return run

    now, mark = 3, 4
    for after in (False, True):
        stop, done = 1, False
        while not done:
            state.update(step=0, stop=stop, after=after)
            with monkeypatch.context() as patched:
                patched.setattr(session, "sql", stopping(sql))
                patched.setattr(write, "saveAsTable", stopping(save))
                loading = Warehouse(spark, name, place)
                try:
                    loading.begin()
                    write_load(loading, mark)
                    loading.publish()
                    done = True
                except Killed:
                    pass
            seen, counts = marks(spark, name)
            assert seen in ({now}, {mark}) and counts == [next(iter(seen)) ** 2], (stop, after)
            if seen == {mark}:
                now, mark = mark, 7 - mark
            stop += 1
        assert stop > 8
    stored = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{name}`").collect()]
    Warehouse(spark, name, place).begin()
    left = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{name}`").collect()]
    assert sorted(left) == sorted(first.current().values()) and len(left) < len(stored)


def test_readers_of_the_load_before_end_their_queries(spark):
    name = f"test_{uuid.uuid4().hex[:8]}"
    warehouse = Warehouse(spark, name, f"{shared_folder(spark)}/{name}")
    for mark in (2, 5):
        warehouse.begin()
        write_load(warehouse, mark)
        if mark == 5:
            before = warehouse.load_star()
        warehouse.publish()
    assert before.fact_trips.count() == 2 and warehouse.table("fact_trips").count() == 5


def test_a_load_with_a_table_missing_is_not_published(spark):
    name = f"test_{uuid.uuid4().hex[:8]}"
    warehouse = Warehouse(spark, name, f"{shared_folder(spark)}/{name}")
    warehouse.begin()
    warehouse.save(spark.range(1), "dim_fare")
    with pytest.raises(RuntimeError, match="dim_datetime, fact_trips"):
        warehouse.publish()
    assert warehouse.current() == {}


def test_weather_made_for_another_load_is_not_added(spark):
    name = f"test_{uuid.uuid4().hex[:8]}"
    warehouse = Warehouse(spark, name, f"{shared_folder(spark)}/{name}")
    for mark in (2, 4):
        warehouse.begin()
        write_load(warehouse, mark)
        warehouse.publish()
        if mark == 2:
            older = warehouse.current()
    warehouse.save(spark.range(1), "dim_weather")
    with pytest.raises(RuntimeError, match="another load"):
        warehouse.add("dim_weather", older)
    assert not warehouse.exists("dim_weather")
    warehouse.add("dim_weather", warehouse.current())  # Nothing was saved under the new name in between.
    assert warehouse.exists("dim_weather") and warehouse.load_star().dim_weather.count() == 1


def test_tables_from_before_there_were_loads_are_read_and_replaced(spark):
    name = f"test_{uuid.uuid4().hex[:8]}"
    warehouse = Warehouse(spark, name, f"{shared_folder(spark)}/{name}").create()
    for table in ("dim_datetime", "dim_fare", "fact_trips", "dim_weather"):
        warehouse.save_dimension(spark.range(1).select(F.lit(1).alias("mark")), table)
    assert marks(spark, name) == ({1}, [1]) and warehouse.exists("dim_weather")
    warehouse.begin()
    write_load(warehouse, 2)
    warehouse.publish()
    assert marks(spark, name) == ({2}, [4]) and not warehouse.exists("dim_weather")
    warehouse.begin()
    assert not warehouse._stored("fact_trips")


def test_an_own_view_goes_before_a_table(spark, warehouse):
    spark.range(7).createOrReplaceTempView("dim_fare")
    try:
        assert warehouse.query("SELECT count(*) AS n FROM dim_fare").first()["n"] == 7
        assert spark.table("dim_fare").count() == 7
    finally:
        spark.catalog.dropTempView("dim_fare")
    assert warehouse.query("SELECT * FROM dim_fare").count() == warehouse.table("dim_fare").count()


def test_own_stage_is_removed(spark, trips, tmp_path):
    with Stage(spark, str(tmp_path / "stage")) as stage:
        assert stage.save(trips.limit(3), "few").count() == 3 and (tmp_path / "stage").exists()
    assert not (tmp_path / "stage").exists()


def test_run_from_files(spark, trips, tmp_path):
    for month in range(3):
        trips.filter(F.col("event_id") % 3 == month).write.parquet(str(tmp_path / f"m{month}.parquet"))
    fixtures.weather(trips).drop("source_order").coalesce(1).write.option("header", True).csv(str(tmp_path / "w"))
    name = f"test_{uuid.uuid4().hex[:8]}"
    built = Warehouse(spark, name, f"{shared_folder(spark)}/{name}")
    star = load.run(spark, str(tmp_path), [str(tmp_path / "w"), str(tmp_path / "no")], built, fixtures.CLEANING)
    assert star.dim_weather.count() > 0
    rollup = Marts(star, fixtures.MARTS, Stage(spark)).all()
    assert len(rollup) == 15 and rollup["monthly"].count() == 3


def test_marts_share_one_scan_of_the_facts(spark, trips, monkeypatch):
    """With a stage, time, place, payment and weather marts read one rollup, and give the rows that each gives alone."""
    name = f"test_{uuid.uuid4().hex[:8]}"
    warehouse = Warehouse(spark, name, f"{shared_folder(spark)}/{name}")
    load.load_trips(trips, warehouse, fixtures.CLEANING, fixtures.QUALITY, Stage(spark))
    star = load.load_weather(fixtures.weather(trips), warehouse)
    alone, together = Marts(star, fixtures.MARTS), Marts(star, fixtures.MARTS, Stage(spark))
    own = {"fare_weekday", "correlation", "clustering", "cluster_data"}
    marts = together.all()
    assert {m for m, df in marts.items() if any("/fact_trips__" in f for f in df.inputFiles())} == own
    for mart in set(marts) - own:
        assert sorted(map(str, marts[mart].collect())) == sorted(map(str, getattr(alone, mart)().collect())), mart
    written = []
    inner = Stage.save

    def watched(self, df, name):
        written.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("Expand")))
        return inner(self, df, name)

    monkeypatch.setattr(Stage, "save", watched)
    Marts(star, fixtures.MARTS, Stage(spark)).all()
    assert written == [("rollup", 1)]
