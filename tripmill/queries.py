"""Registry: one query per operator, over the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import fixtures, oracle
from tripmill.config import DROPOFF, PICKUP, QualityConfig
from tripmill.functions.columns import hour_floor, round_even, season
from tripmill.operators import geometry, segments, star as stars, weather as weathers
from tripmill.operators.cleaning import TripCleaner
from tripmill.operators.quality import StarChecker
from tripmill.operators.sampling import stratified_sample
from tripmill.operators.star import Star
from tripmill.plans import derive
from tripmill.plans.load import load_trips, load_weather
from tripmill.plans.marts import Marts
from tripmill.session import Stage, ensure_utc, shared_folder
from tripmill.sources import files, geojson
from tripmill.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# Literal centroids of (duration, fare, distance), so that assignment does not depend on training.
CENTROIDS = ((20.0, 8.0, 2.0), (60.0, 32.0, 8.0))
SAMPLE = 1000

_prepared: dict[tuple[str, str], "Prepared"] = {}


class Prepared:
    """What several queries of one session share: the stored star, as a dashboard would find it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.stage = Stage(spark)
        self._trips: DataFrame | None = None
        self._star: Star | None = None
        self._features: DataFrame | None = None
        self._tips = None
        self._large: Star | None = None
        self._named: DataFrame | None = None
        self._trained: tuple[DataFrame, segments.Fit] | None = None
        name = f"trips_{uuid.uuid4().hex[:12]}"
        self.warehouse = Warehouse(spark, name, f"{shared_folder(spark)}/{name}")

    @property
    def star(self) -> Star:
        if self._star is None:
            load_trips(self.trips, self.warehouse, fixtures.CLEANING, fixtures.QUALITY, self.stage)
            self._star = load_weather(self.weather, self.warehouse)
        return self._star

    @property
    def trips(self) -> DataFrame:
        """Stored trips, so that cleaning filters reach a Parquet scan as they do on trip files."""
        if self._trips is None:
            self._trips = self.stage.save(fixtures.trips(self.spark, self.sf_dir), "trips")
        return self._trips

    @property
    def weather(self) -> DataFrame:
        return fixtures.weather(self.trips)

    @property
    def cleaned(self) -> DataFrame:
        return TripCleaner(fixtures.CLEANING).clean(self.trips)

    @property
    def fact(self) -> DataFrame:
        self.star
        return self.warehouse.table("fact_trips")

    @property
    def marts(self) -> Marts:
        return Marts(self.star, fixtures.MARTS)

    @property
    def features(self) -> DataFrame:
        if self._features is None:
            path = self.stage.path("features")
            fixtures.feature_lines(self.spark, self.sf_dir).write.text(path)
            self._features = files.read_features(self.spark, path)
        return self._features

    def lookup_files(self) -> str:
        path = self.stage.path("lookup")
        fixtures.zone_lookup(self.spark, self.sf_dir).write.option("header", True).csv(path)
        return path

    @property
    def lookup(self) -> DataFrame:
        return fixtures.zone_lookup(self.spark, self.sf_dir)

    @property
    def large(self) -> Star:
        """The star as if no dimension could be broadcast, with a fact that was joined in that way."""
        if self._large is None:
            star = stars.build_star(self.cleaned, self.stage, broadcast_bytes=0, hot_share=1e-3)
            self._large = replace(star, fact_trips=self.stage.save(star.fact_trips, "fact"), dim_weather=self.star.dim_weather)
        return self._large

    @property
    def tips(self):
        if self._tips is None:
            self._tips = segments.tip_segments(self.marts.tip_points(), self.stage)
        return self._tips

    @property
    def named(self) -> DataFrame:
        """Assigned once and stored, as naming reads the rows twice and four reports share them."""
        if self._named is None:
            assigned = segments.assign(self.marts.clustering(), CENTROIDS, segments.FEATURES, "trip_cluster")
            self._named = segments.name_segments(self.stage.save(assigned, "assigned"))
        return self._named

    @property
    def trained(self) -> tuple[DataFrame, segments.Fit]:
        if self._trained is None:
            self._trained = segments.trip_segments(self.marts.clustering(), self.stage)
        return self._trained


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    key = (ensure_utc(spark).sparkContext.applicationId, sf_dir)
    if key not in _prepared:
        _prepared[key] = Prepared(spark, sf_dir)
    return _prepared[key]


_queries: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Prepared], DataFrame]], Callable[[Prepared], DataFrame]]:
    def register(build: Callable[[Prepared], DataFrame]) -> Callable[[Prepared], DataFrame]:
        _queries[name] = lambda spark, sf_dir: build(prepared(spark, sf_dir))
        return build

    return register


# -- sources and sinks -----------------------------------------------------------------------------


@query("s01_trip_files")
def trip_files(p: Prepared) -> DataFrame:
    """Three monthly datasets, one of which lacks a column."""
    folder = p.stage.path("trips")
    wanted = p.trips.select("event_id", "VendorID", "fare_amount", "congestion_surcharge")
    for month in range(3):
        part = wanted.filter(F.col("event_id") % 3 == month)
        (part.drop("congestion_surcharge") if month == 2 else part).write.parquet(f"{folder}/month-{month}.parquet")
    return files.read_trips(p.spark, folder)


@query("s02_weather_csv")
def weather_csv(p: Prepared) -> DataFrame:
    root = p.stage.path("weather")
    raw = p.weather
    for number in (0, 1):
        part = raw.filter(F.col("source_order") == number).drop("source_order")
        part.write.option("header", True).csv(f"{root}/{number}")
    read = files.read_weather(p.spark, [f"{root}/0", f"{root}/1", f"{root}/missing"])
    return read.drop("file", "block_start", "row_in_block")


@query("s03_zone_lookup")
def zone_lookup(p: Prepared) -> DataFrame:
    return files.read_zone_lookup(p.spark, p.lookup_files())


@query("s04_features")
def features(p: Prepared) -> DataFrame:
    properties = F.col("properties")
    raw = F.coalesce(*[properties[name] for name in geometry.ID_PROPERTIES])
    return p.features.select(properties["customer"].cast("bigint").alias("customer"), "geometry_type", raw.alias("raw_id"))


@query("s05_dimension_table")
def dimension_table(p: Prepared) -> DataFrame:
    return p.warehouse.save_dimension(p.star.dim_datetime, "dim_datetime_copy")


@query("s06_fact_table")
def fact_table(p: Prepared) -> DataFrame:
    return p.warehouse.save_fact(p.fact, "fact_trips_copy", compact=True)


@query("s09_sql")
def warehouse_sql(p: Prepared) -> DataFrame:
    p.star
    return p.warehouse.query(
        """SELECT dd.season, dd.hour, COUNT(*) AS trips, SUM(ft.trip_distance) AS distance
           FROM fact_trips ft JOIN dim_datetime dd ON ft.datetime_id = dd.datetime_id GROUP BY dd.season, dd.hour"""
    )


@query("s10_all_marts")
def all_marts(p: Prepared) -> DataFrame:
    marts = Marts(p.star, fixtures.MARTS, p.stage).all()
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("mart"), "row_count") for n, df in marts.items()]
    return reduce(DataFrame.unionByName, counts)


@query("s10_no_weather")
def marts_without_weather(p: Prepared) -> DataFrame:
    marts = Marts(replace(p.star, dim_weather=None), fixtures.MARTS, p.stage).all()
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("mart"), "row_count") for n, df in marts.items()]
    return reduce(DataFrame.unionByName, counts)


@query("s11_geojson")
def geojson_round_trip(p: Prepared) -> DataFrame:
    """Features written as a collection and read again: points of each."""
    vertices = geometry.reproject(fixtures.vertices(p.spark, p.sf_dir))
    listed = vertices.select("feature_id").distinct()
    named = listed.select("feature_id", F.create_map(F.lit("LocationID"), F.col("feature_id").cast("string")).alias("properties"))
    path = p.stage.path("collection")
    geojson.write_collection(p.stage.save(geometry.assemble(vertices, named), "assembled"), path)
    again = geometry.with_points(geometry.with_location_id(files.read_features(p.spark, path)))
    return again.select(F.col("location_id").cast("bigint").alias("feature_id"), F.size("points").cast("bigint").alias("points"))


@query("s07_created_tables")
def created_tables(p: Prepared) -> DataFrame:
    """Rows of a dimension stored twice in a new database."""
    warehouse = Warehouse(p.spark, f"{p.warehouse.database}_new", p.stage.path("database")).create().create()
    warehouse.save_dimension(p.star.dim_datetime, "hours")
    return warehouse.save_dimension(p.star.dim_datetime, "hours").agg(F.count("*").alias("hours"))


@query("s08_dropped_tables")
def dropped_tables(p: Prepared) -> DataFrame:
    """What is left when some tables, one of them missing, are dropped."""
    warehouse = Warehouse(p.spark, f"{p.warehouse.database}_old", p.stage.path("database")).create()
    for table in ("hours", "more_hours"):
        warehouse.save_dimension(p.star.dim_datetime, table)
    warehouse.drop(["more_hours", "never_there"])
    left = [t for t in ("hours", "more_hours", "never_there") if warehouse.exists(t)]
    return reduce(DataFrame.unionByName, [warehouse.table(t).agg(F.lit(t).alias("name"), F.count("*").alias("rows")) for t in left])


# -- cleaning --------------------------------------------------------------------------------------


def _cleaner() -> TripCleaner:
    return TripCleaner(fixtures.CLEANING)


@query("c01_timestamps")
def timestamps(p: Prepared) -> DataFrame:
    """Times as text, some of them unreadable."""

    def text(column: str, modulus: int):
        readable = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return F.when(F.col("event_id") % modulus == 0, "not a time").otherwise(readable)

    raw = p.trips.select(
        "event_id",
        text("tpep_pickup_datetime", 83).alias("tpep_pickup_datetime"),
        text("tpep_dropoff_datetime", 89).alias("tpep_dropoff_datetime"),
    )
    return _cleaner().coerce(raw)


def _rule_query(name: str, rules: Callable[[TripCleaner, DataFrame], list]) -> None:
    @query(name)
    def build(p: Prepared) -> DataFrame:
        cleaner, trips = _cleaner(), p.trips
        return cleaner.apply(trips, rules(cleaner, trips)).select("event_id")


def _condition_query(name: str, condition: Callable) -> None:
    @query(name)
    def build(p: Prepared) -> DataFrame:
        trips = p.trips
        return trips.filter(condition(_cleaner(), trips)).select("event_id")


_rule_query("c02_non_negative", TripCleaner.non_negative)
_rule_query("c03_passengers", TripCleaner.passengers)
_rule_query("c04_pickup_range", TripCleaner.pickup_range)
_condition_query("c05_distance", lambda cleaner, trips: cleaner.distance())
_condition_query("c06_duration", TripCleaner.duration)
_condition_query("c07_speed", TripCleaner.speed)
_condition_query("c08_charge_total", TripCleaner.total_covers_charges)
_condition_query("c09_paid_fare", TripCleaner.paid_fare)


def _coded_query(name: str, column: str, rules: Callable[[TripCleaner, DataFrame], list], *also: str) -> None:
    """The code as text, some of it unreadable."""

    @query(name)
    def build(p: Prepared) -> DataFrame:
        code = F.when(F.col("event_id") % 83 == 0, "n/a").otherwise(F.col(column).cast("string"))
        raw = p.trips.select("event_id", code.alias(column), *also)
        cleaner = _cleaner()
        return cleaner.coerce(cleaner.apply(raw, rules(cleaner, raw)))


_coded_query("c10_payment_type", "payment_type", TripCleaner.payment_type)
_coded_query("c11_rate_code", "RatecodeID", TripCleaner.rate_codes)
_coded_query("c12_location", "PULocationID", TripCleaner.locations, "DOLocationID")


@query("c13_removals")
def removals(p: Prepared) -> DataFrame:
    return _cleaner().removals(p.trips)


@query("c14_absent_columns")
def absent_columns(p: Prepared) -> DataFrame:
    """Rules whose columns are missing fall away; the others stay."""
    few = p.trips.select("event_id", PICKUP, DROPOFF, "passenger_count", "payment_type")
    return _cleaner().clean(few).select("event_id")


@query("c15_clean")
def clean(p: Prepared) -> DataFrame:
    return p.cleaned


# -- star schema -----------------------------------------------------------------------------------


@query("t02_duration")
def duration(p: Prepared) -> DataFrame:
    return stars.add_metrics(p.trips).select("event_id", "trip_duration_min")


@query("t03_tip_percentage")
def tip_percentage(p: Prepared) -> DataFrame:
    return stars.add_metrics(p.trips).select("event_id", "tip_percentage")


@query("t04_hour_floor")
def floor_hours(p: Prepared) -> DataFrame:
    return p.trips.select("event_id", hour_floor(F.col(PICKUP)).alias("pickup_hour"))


@query("t05_distinct_hours")
def distinct_hours(p: Prepared) -> DataFrame:
    return stars.distinct_hours(p.cleaned).orderBy("full_datetime")


@query("t06_calendar")
def calendar(p: Prepared) -> DataFrame:
    return stars.calendar(stars.distinct_hours(p.cleaned)).drop("season")


@query("t07_season")
def seasons(p: Prepared) -> DataFrame:
    orders = fixtures.table(p.spark, p.sf_dir, "orders")
    return orders.select("o_orderkey", season(F.month("o_orderdate")).alias("season"))


@query("t08_hour_keys")
def hour_keys(p: Prepared) -> DataFrame:
    return stars.build_dim_datetime(p.cleaned, p.stage)


@query("t09_hour_join")
def hour_join(p: Prepared) -> DataFrame:
    dim = p.star.dim_datetime
    return stars.attach_datetime_id(p.cleaned, dim, p.star.hours_are_small).select("event_id", "datetime_id")


@query("t10_fare_combinations")
def fare_combinations(p: Prepared) -> DataFrame:
    """On order lines, where combinations with nulls are many."""
    quantity = F.when(F.col("l_returnflag") != "A", F.col("l_quantity"))
    lines = fixtures.table(p.spark, p.sf_dir, "lineitem").select(
        F.col("l_discount").alias("fare_amount"), F.col("l_tax").alias("tip_amount"), quantity.alias("total_amount")
    )
    return stars.fare_combinations(lines)


@query("t11_fare_keys")
def fare_keys(p: Prepared) -> DataFrame:
    return stars.number_fares(stars.fare_combinations(p.cleaned), p.stage).drop("trips")


@query("t11_first_appearance")
def fare_keys_by_appearance(p: Prepared) -> DataFrame:
    """Fares numbered in the order of their first trips, which are in order of ``event_id``."""
    numbered = stars.number_fares(stars.fare_combinations(p.cleaned, ["event_id"]), p.stage)
    return numbered.select("fare_id", *stars.money_columns(numbered), F.col("first_seen").alias("event_id"), "trips")


@query("t12_fare_join")
def fare_join(p: Prepared) -> DataFrame:
    star = p.star
    return stars.attach_fare_id(p.cleaned, star.dim_fare, star.hot_fares, star.fares_are_small).select("event_id", "fare_id")


@query("t12_fare_join_large")
def fare_join_large(p: Prepared) -> DataFrame:
    return p.large.fact_trips.select("event_id", "fare_id")


@query("t13_fact_order")
def fact_order(p: Prepared) -> DataFrame:
    return stars.fact_order(p.fact.select("fare_id", *[c for c in p.fact.columns if c != "fare_id"]))


@query("t14_no_money")
def no_money(p: Prepared) -> DataFrame:
    return stars.build_star(p.cleaned.drop(*stars.money_columns(p.cleaned)), p.stage).fact_trips


@query("t15_star")
def whole_star(p: Prepared) -> DataFrame:
    star = stars.build_star(p.cleaned, p.stage)
    fact = star.fact_trips.select("event_id", "trip_duration_min", "tip_percentage", "datetime_id", "fare_id")
    hours = star.with_hours(fact, *[c for c in star.dim_datetime.columns if c != "datetime_id"])
    return star.with_fares(hours, *stars.money_columns(star.dim_fare))


@query("t15_star_large")
def whole_star_large(p: Prepared) -> DataFrame:
    star = p.large
    fact = star.fact_trips.select("event_id", "trip_duration_min", "tip_percentage", "datetime_id", "fare_id")
    hours = star.with_hours(fact, *[c for c in star.dim_datetime.columns if c != "datetime_id"])
    return star.with_fares(hours, *stars.money_columns(star.dim_fare))


@query("t01_required")
def required(p: Prepared) -> DataFrame:
    """Whether trips with only some of the time columns are accepted."""
    rows = []
    for name, dropped in (("both", ()), ("no pickup", (PICKUP,)), ("no dropoff", (DROPOFF,)), ("neither", (PICKUP, DROPOFF))):
        try:
            stars.require_timestamps(p.trips.drop(*dropped))
            accepted = True
        except ValueError:
            accepted = False
        rows.append(p.trips.agg(F.lit(name).alias("columns"), F.lit(accepted).alias("accepted"), F.count("*").alias("trips")))
    return reduce(DataFrame.unionByName, rows)


# -- weather ---------------------------------------------------------------------------------------


def _matched(p: Prepared) -> DataFrame:
    raw = weathers.parse_time(p.weather)
    return weathers.match_hours(raw, p.star.dim_datetime, p.star.hours_are_small)


@query("w01_parse_time")
def parse_time(p: Prepared) -> DataFrame:
    return weathers.parse_time(p.weather).select("source_order", "datetime", "full_datetime")


@query("w02_match_hours")
def match_hours(p: Prepared) -> DataFrame:
    return _matched(p).select("datetime_id", "source_order", "temp", "conditions")


@query("w03_attributes")
def attributes(p: Prepared) -> DataFrame:
    return weathers.keep_attributes(_matched(p))


@query("w04_first_per_hour")
def first_per_hour(p: Prepared) -> DataFrame:
    return weathers.first_per_hour(_matched(p))


@query("w05_dim_weather")
def dim_weather(p: Prepared) -> DataFrame:
    p.star
    return p.warehouse.table("dim_weather")


# -- quality ---------------------------------------------------------------------------------------

# Narrower than the data and applied to trips before cleaning, so that checks have something to find.
NARROW = QualityConfig(
    start=fixtures.START.replace(day=5), end=fixtures.END.replace(day=20, hour=23, minute=59, second=59)
)


def _check_query(name: str, *checks: str) -> None:
    @query(name)
    def build(p: Prepared) -> DataFrame:
        return StarChecker(p.trips, p.star, NARROW).report(checks)


_check_query("v01_row_count", "row_count")
_check_query("v03_hour_coverage", "hour_coverage")
_check_query("v04a_input_range", "input_range")
_check_query("v04b_hour_range", "hour_range")
_check_query("v04c_fact_range", "fact_range")


@query("v02_non_negative")
def non_negative(p: Prepared) -> DataFrame:
    """On trips before cleaning, with the money columns still in the fact."""
    fact = stars.add_metrics(p.trips)
    fares = p.trips.select(*stars.money_columns(p.trips)).distinct()
    return StarChecker(p.trips, replace(p.star, fact_trips=fact, dim_fare=fares), NARROW).report(["non_negative"])


@query("v05_all_checks")
def all_checks(p: Prepared) -> DataFrame:
    return StarChecker(p.trips, p.star, NARROW).report()


# -- marts -----------------------------------------------------------------------------------------


def _mart_query(name: str, mart: str) -> None:
    @query(name)
    def build(p: Prepared) -> DataFrame:
        return getattr(p.marts, mart)()


for _key, _mart in zip(oracle.MART_KEYS, oracle.MART_NAMES):
    _mart_query(_key, _mart)


@query("q04_fare_weekday_large")
def fare_weekday_large(p: Prepared) -> DataFrame:
    return Marts(p.large, fixtures.MARTS).fare_weekday()


@query("q12_clustering_large")
def clustering_large(p: Prepared) -> DataFrame:
    return Marts(p.large, fixtures.MARTS).clustering()


# -- derived ---------------------------------------------------------------------------------------


@query("p01_month_start")
def month_start(p: Prepared) -> DataFrame:
    return derive.month_start(p.marts.monthly())


@query("p02_day_names")
def day_names(p: Prepared) -> DataFrame:
    return derive.day_names(p.marts.fare_weekday())


@query("p02_day_names_durations")
def day_names_of_durations(p: Prepared) -> DataFrame:
    return derive.day_names(p.marts.weekday())


@query("p03_weekend")
def weekend(p: Prepared) -> DataFrame:
    return derive.weekend_flag(p.marts.weekday())


@query("p04_heatmap_pivot")
def heatmap_pivot(p: Prepared) -> DataFrame:
    return derive.heatmap_pivot(p.marts.heatmap(), months=range(1, 13))


@query("p05_kpis")
def kpis(p: Prepared) -> DataFrame:
    names = ("avg_duration", "avg_duration_per_trip")
    return derive.kpis(p.marts.monthly()).withColumns({c: round_even(F.col(c), 6) for c in names})


@query("p06_safe_average")
def safe_average(p: Prepared) -> DataFrame:
    """Every fifth place has no known distance and falls back to the default."""
    known = F.when(F.col("PULocationID") % 5 != 0, F.col("trip_distance"))
    mean = round_even(derive.average_or_default(known), 6)
    return p.fact.groupBy("PULocationID").agg(mean.alias("avg_distance"))


def _labelled(p: Prepared) -> DataFrame:
    return derive.zone_labels(p.marts.pickup_counts_all(), p.lookup)


@query("p07_zone_labels")
def zone_labels(p: Prepared) -> DataFrame:
    return _labelled(p)


@query("p08_top_labels")
def top_labels(p: Prepared) -> DataFrame:
    return derive.top_pickup_labels(p.marts.top_pickup_locations())


@query("p08_top_labels_lookup")
def top_labels_from_lookup(p: Prepared) -> DataFrame:
    return derive.top_pickup_labels(p.marts.top_pickup_locations(), p.lookup)


@query("p09_located_pickups")
def located_pickups(p: Prepared) -> DataFrame:
    return derive.locate(p.marts.pickup_counts_all(), geometry.zone_centroids(p.features))


@query("p09_located")
def located(p: Prepared) -> DataFrame:
    return derive.locate(p.marts.dropoff_counts_all(), geometry.zone_centroids(p.features))


@query("p09_located_report")
def located_report(p: Prepared) -> DataFrame:
    return derive.locate_report(p.marts.dropoff_counts_all(), geometry.zone_centroids(p.features))


@query("p10_markers")
def markers(p: Prepared) -> DataFrame:
    return derive.markers(_labelled(p)).withColumn("size", round_even(F.col("size"), 6))


@query("p10_markers_located")
def markers_of_located(p: Prepared) -> DataFrame:
    """Sizes relative to the largest count that has a place."""
    located = derive.locate(_labelled(p), geometry.zone_centroids(p.features))
    return derive.markers(located).withColumn("size", round_even(F.col("size"), 6))


def _matrix(p: Prepared) -> DataFrame:
    matrix = derive.correlation_matrix(p.marts.correlation())
    return matrix.withColumn("correlation", round_even(F.col("correlation"), 6))


@query("p11_correlation")
def correlation(p: Prepared) -> DataFrame:
    return _matrix(p).drop("text")


@query("p12_display_names")
def display_names(p: Prepared) -> DataFrame:
    return derive.display_names(_matrix(p)).select("variable", "other", "correlation")


@query("p13_shares")
def shares(p: Prepared) -> DataFrame:
    payment = derive.shares(p.marts.payment_type_distribution())
    return payment.withColumn("percent", round_even(F.col("percent"), 6))


@query("p13_trip_type_shares")
def trip_type_shares(p: Prepared) -> DataFrame:
    sizes = derive.shares(segments.segment_sizes(p.named))
    return sizes.withColumn("percent", round_even(F.col("percent"), 6))


# -- segments --------------------------------------------------------------------------------------


@query("m01_features")
def filled_features(p: Prepared) -> DataFrame:
    gaps = F.when(F.col("event_id") % 11 != 0, F.col("trip_distance"))
    trips = stars.add_metrics(p.trips).withColumn("trip_distance", gaps)
    return segments.fill_features(trips.select("event_id", *segments.FEATURES))


@query("m02_standardise")
def standardise(p: Prepared) -> DataFrame:
    # Stored, because the statistics and the result both read the rows.
    ready = segments.standardise(p.stage.save(p.marts.clustering().select(*segments.FEATURES), "features"))
    return ready.withColumns({c: round_even(F.col(c), 6) for c in segments.scaled()})


@query("m03_trip_segments")
def trip_segments(p: Prepared) -> DataFrame:
    named, _ = segments.trip_segments(p.marts.clustering(), p.stage)
    return segments.segment_statistics(named)


def _squares(centroids: list[list[float]], features: list[str]):
    return [sum(((F.col(c) - x) * (F.col(c) - x) for c, x in zip(features, m)), F.lit(0.0)) for m in centroids]


def _nearest(centroids: list[list[float]], features: list[str], cluster: str):
    """Whether no row has a centroid that is nearer than its own."""
    squares = _squares(centroids, features)
    own = F.get(F.array(*squares), F.col(cluster))
    return (F.count_if(own > F.least(*squares) + 1e-9) == 0).alias("nearest")


def _best(best: segments.Fit, own):
    """Whether the cost of the rows as they are assigned is that of the cheapest restart."""
    return (F.sum(own) <= F.lit(min(best.costs) * (1 + 1e-6))).alias("best")


@query("m03_checks")
def trip_segment_checks(p: Prepared) -> DataFrame:
    """What must hold of any trained segments."""
    named, best = p.trained
    level = sum((F.col(c) for c in segments.FEATURES), F.lit(0.0))
    short = F.avg(F.when(F.col("trip_type") == segments.SHORT_TRIPS, level))
    long = F.avg(F.when(F.col("trip_type") == segments.LONG_TRIPS, level))
    return named.agg(
        F.count("*").alias("trips"),
        F.count_distinct("trip_cluster").alias("clusters"),
        F.count_distinct("trip_type").alias("names"),
        (short < long).alias("short_is_shorter"),
        _nearest(best.centroids, segments.scaled(), "trip_cluster"),
        _best(best, F.get(F.array(*_squares(best.centroids, segments.scaled())), F.col("trip_cluster"))),
    )


@query("m09_checks")
def tip_cluster_checks(p: Prepared) -> DataFrame:
    _, best = p.tips
    assigned = segments.assign(p.marts.cluster_data(), best.centroids, segments.TIP_FEATURES, "cluster")
    near = _nearest(best.centroids, list(segments.TIP_FEATURES), "cluster")
    return assigned.agg(F.count("*").alias("trips"), F.count_distinct("cluster").alias("clusters"), near)


@query("m10_checks")
def tip_centroid_checks(p: Prepared) -> DataFrame:
    centroids, best = p.tips
    fares = F.transform(F.array_sort(F.collect_list(F.struct("cluster", "fare_amount"))), lambda x: x["fare_amount"])
    found = centroids.agg(
        F.sum("trips").alias("trips"),
        F.count("*").alias("clusters"),
        (fares == F.array_sort(fares)).alias("by_fare"),
    )
    features = list(segments.TIP_FEATURES)
    assigned = segments.assign(p.marts.tip_points(), best.centroids, features, "cluster")
    cost = _best(best, F.get(F.array(*_squares(best.centroids, features)), F.col("cluster")) * F.col("weight"))
    return found.crossJoin(assigned.agg(cost))


@query("m04_names")
def named_segments(p: Prepared) -> DataFrame:
    return p.named.select(*segments.FEATURES, "trip_cluster", "trip_type")


@query("m05_statistics")
def segment_statistics(p: Prepared) -> DataFrame:
    return segments.segment_statistics(p.named)


@query("m06_by_hour")
def segments_by_hour(p: Prepared) -> DataFrame:
    return segments.segments_by_hour(p.named)


@query("m07_sizes")
def segment_sizes(p: Prepared) -> DataFrame:
    return segments.segment_sizes(p.named)


@query("m08_sample")
def sample(p: Prepared) -> DataFrame:
    assigned = segments.assign(p.marts.clustering("event_id"), CENTROIDS, segments.FEATURES, "trip_cluster")
    # Sampling reads its input twice, so it gets stored rows.
    assigned = p.stage.save(assigned.select("event_id", "trip_cluster", *segments.FEATURES), "assigned")
    named = p.stage.save(segments.name_segments(assigned).select("event_id", "trip_type"), "named")
    return stratified_sample(named, "trip_type", ["event_id"], p.stage, total=SAMPLE)


@query("m09_tip_clusters")
def tip_clusters(p: Prepared) -> DataFrame:
    _, best = p.tips
    return segments.assign(p.marts.cluster_data(), best.centroids, segments.TIP_FEATURES, "cluster")


@query("m10_tip_centroids")
def tip_centroids(p: Prepared) -> DataFrame:
    return p.tips[0]


@query("m11_assign")
def assign(p: Prepared) -> DataFrame:
    trips = p.marts.clustering().select(*segments.FEATURES)
    return segments.assign(trips, CENTROIDS, segments.FEATURES, "trip_cluster")


# -- geometry --------------------------------------------------------------------------------------


def _customer():
    return F.col("properties")["customer"].cast("bigint").alias("customer")


@query("g01_location_id")
def location_id(p: Prepared) -> DataFrame:
    properties = F.col("properties")
    return p.features.select(
        _customer(),
        geometry.location_id(properties).alias("location_id"),
        geometry.location_text(properties).alias("location_text"),
    )


@query("g02_points")
def points(p: Prepared) -> DataFrame:
    exploded = geometry.with_points(p.features).select(_customer(), F.posexplode("points").alias("position", "point"))
    return exploded.select("customer", "position", F.col("point")[0].alias("lon"), F.col("point")[1].alias("lat"))


@query("g03_box_centre")
def box_centre(p: Prepared) -> DataFrame:
    centres = geometry.with_points(p.features).select(_customer(), geometry.box_centre(F.col("points")).alias("centre"))
    return centres.select("customer", "centre.lon", "centre.lat")


@query("g03_vertex_centre")
def vertex_centre(p: Prepared) -> DataFrame:
    return geometry.vertex_centroids(fixtures.vertices(p.spark, p.sf_dir))


@query("g04_zone_centroids")
def zone_centroids(p: Prepared) -> DataFrame:
    return geometry.zone_centroids(p.features)


@query("g05_rings")
def rings(p: Prepared) -> DataFrame:
    listed = fixtures.table(p.spark, p.sf_dir, "supplier").selectExpr("CAST(s_nationkey * 2 + 1 AS BIGINT) AS feature_id")
    return geometry.ring_summary(fixtures.vertices(p.spark, p.sf_dir), listed)


@query("g06_reproject")
def reproject(p: Prepared) -> DataFrame:
    placed = geometry.reproject(fixtures.vertices(p.spark, p.sf_dir))
    return placed.withColumns({c: round_even(F.col(c), 6) for c in ("lon", "lat")})


@query("g07_location_count")
def location_count(p: Prepared) -> DataFrame:
    return geometry.count_location_ids(p.features)


def queries() -> dict[str, Query]:
    return dict(_queries)
