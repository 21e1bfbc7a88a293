"""The fifteen marts over the star schema.

Facts are pre-aggregated on the surrogate key wherever the mart is an aggregate, so joins see hours or
fare combinations and not trips.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.config import WEATHER_ATTRIBUTES, MartConfig
from tripmill.functions.columns import round_half_up
from tripmill.operators.keys import fits_broadcast
from tripmill.operators.star import Star
from tripmill.session import Stage
from tripmill.sources.warehouse import PARTITION

# Payment names by code.
PAYMENT_NAMES = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}
# The variables that are correlated.
CORRELATED = (
    "trip_duration_min",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "passenger_count",
    "temp",
    "precip",
    "hour",
)
# Fact columns that marts count by.
COUNTED = ("PULocationID", "DOLocationID", "payment_type")


class Marts:
    """Lazy marts. With a stage, one pass over the facts counts trips by hour, places and payment at once; the
    eleven marts that need no more than that share what it wrote."""

    def __init__(self, star: Star, config: MartConfig = MartConfig(), stage: Stage | None = None):
        self.star = star
        self.config = config
        self.stage = stage

    # -- shared parts ----------------------------------------------------------------------------

    @cached_property
    def facts(self) -> DataFrame:
        """Facts that can belong to the wanted years. The month filter prunes whole partitions; the year
        filter on the hours stays and decides."""
        fact = self.star.fact_trips
        if PARTITION in fact.columns:
            first_month = F.make_date(F.lit(self.config.year), F.lit(1), F.lit(1))
            fact = fact.filter(F.col(PARTITION) >= first_month).drop(PARTITION)
        return fact

    @cached_property
    def dim_weather(self) -> DataFrame:
        """The weather dimension; without one, an empty table, as a load without weather is a valid load."""
        if self.star.dim_weather is not None:
            return self.star.dim_weather
        kinds = {c: "string" if c == "conditions" else "double" for c in WEATHER_ATTRIBUTES}
        columns = ", ".join(f"{c} {kind}" for c, kind in kinds.items())
        return self.star.dim_datetime.sparkSession.createDataFrame([], f"datetime_id bigint, {columns}")

    @property
    def _wanted(self) -> Column:
        return F.col("year") >= self.config.year

    @staticmethod
    def _measures() -> list[Column]:
        duration = F.col("trip_duration_min")
        return [F.count("*").alias("trips"), F.sum(duration).alias("minutes"), F.count(duration).alias("timed")]

    @cached_property
    def shared_rollup(self) -> DataFrame:
        """Trips of the wanted years by hour, by each place and by payment: a grouping set each, in one scan.

        Rows are as many as hours, places and payment types together; ``grouped`` names the column they are by.
        """
        by = ["datetime_id", *[c for c in COUNTED if c in self.facts.columns]]
        wanted = self._in_years(self.facts.select(*by, "trip_duration_min"))
        # In grouping_id the first column is the highest bit, and a bit is 0 where rows are by that column.
        grouped = F.element_at(F.array(*[F.lit(c) for c in by]), F.array_position(
            F.array(*[F.shiftright("_set", len(by) - 1 - i).bitwiseAND(1) for i in range(len(by))]), F.lit(0)
        ).cast("int"))
        sets = wanted.groupingSets([[c] for c in by], *by).agg(F.grouping_id().cast("bigint").alias("_set"), *self._measures())
        return self.stage.save(sets.withColumn("grouped", grouped).drop("_set"), "rollup")

    @cached_property
    def hour_rollup(self) -> DataFrame:
        """Trips and duration sums per hour: as many rows as there are hours."""
        if self.stage:
            return self._by("datetime_id").select("datetime_id", "trips", "minutes", "timed")
        return self.facts.groupBy("datetime_id").agg(*self._measures())

    def _by(self, column: str) -> DataFrame:
        return self.shared_rollup.filter(F.col("grouped") == column)

    def _hours(self, *attributes: str) -> DataFrame:
        needed = dict.fromkeys(("year", *attributes))
        return self.star.with_hours(self.hour_rollup, *needed).filter(self._wanted)

    def _in_years(self, facts: DataFrame, *attributes: str) -> DataFrame:
        needed = dict.fromkeys(("year", *attributes))
        joined = self.star.with_hours(facts, *needed).filter(self._wanted)
        return joined if "year" in attributes else joined.drop("year")

    @staticmethod
    def _average_minutes() -> Column:
        return round_half_up(F.try_divide(F.sum("minutes"), F.sum("timed"))).alias("avg_duration")

    @staticmethod
    def _trips() -> Column:
        return F.sum("trips").alias("trip_count")

    # -- demand over time ------------------------------------------------------------------------

    def monthly(self) -> DataFrame:
        grouped = self._hours("month").groupBy("year", "month").agg(self._average_minutes(), self._trips())
        return grouped.orderBy("year", "month")

    def weekday(self) -> DataFrame:
        grouped = self._hours("day_of_week").groupBy("day_of_week").agg(self._average_minutes(), self._trips())
        return grouped.orderBy("day_of_week")

    def heatmap(self) -> DataFrame:
        """Years are merged, as the groups are month and day of week only."""
        return self._hours("month", "day_of_week").groupBy("month", "day_of_week").agg(self._trips())

    def hourly(self) -> DataFrame:
        return self._hours("hour").groupBy("hour").agg(self._trips(), self._average_minutes()).orderBy("hour")

    # -- revenue ---------------------------------------------------------------------------------

    def fare_weekday(self) -> DataFrame:
        """Three-table join. Trips shrink to one row per fare combination with seven day counters; that
        aggregate is already placed by ``fare_id``, so the join moves only the dimension."""
        facts = self._in_years(self.facts.select("datetime_id", "fare_id"), "day_of_week")
        days = [F.count_if(F.col("day_of_week") == d).alias(f"day{d}") for d in range(7)]
        per_fare = facts.groupBy("fare_id").agg(*days)
        money = {"total_revenue": "total_amount", "total_fare": "fare_amount", "total_tip": "tip_amount"}
        dim = self.star.dim_fare.select("fare_id", *money.values())
        priced = per_fare.join(F.broadcast(dim) if self.star.fares_are_small else dim, "fare_id")

        def total(d: int, column: str) -> Column:
            return F.sum(F.when(F.col(f"day{d}") > 0, F.col(f"day{d}") * F.col(column)))

        sums = priced.agg(
            *[F.sum(f"day{d}").alias(f"n{d}") for d in range(7)],
            *[total(d, c).alias(f"{c}{d}") for d in range(7) for c in money.values()],
        )
        rows = F.array(
            *[
                F.struct(
                    F.lit(d).alias("day_of_week"),
                    F.col(f"n{d}").alias("trips"),
                    *[round_half_up(F.col(f"{c}{d}")).alias(name) for name, c in money.items()],
                )
                for d in range(7)
            ]
        )
        return sums.select(F.inline(rows)).filter("trips > 0").drop("trips").orderBy("day_of_week")

    # -- places and payment ----------------------------------------------------------------------

    def _count_by(self, column: str) -> DataFrame:
        if self.stage:
            return self._by(column).select(column, F.col("trips").alias("trip_count"))
        facts = self._in_years(self.facts.select("datetime_id", column))
        return facts.groupBy(column).agg(F.count("*").alias("trip_count"))

    def top_pickup_locations(self, n: int = 10) -> DataFrame:
        counts = self._count_by("PULocationID").withColumnRenamed("PULocationID", "pulocationid")
        return counts.orderBy(F.desc("trip_count"), "pulocationid").limit(n)

    def payment_type_distribution(self) -> DataFrame:
        names = F.create_map(*[F.lit(x) for pair in PAYMENT_NAMES.items() for x in pair])
        name = F.coalesce(names[F.col("payment_type").cast("int")], F.lit("Other"))
        counts = self._count_by("payment_type")
        return counts.select("payment_type", name.alias("payment_name"), "trip_count").orderBy(
            F.desc("trip_count"), "payment_type"
        )

    def pickup_counts_all(self) -> DataFrame:
        return self._count_by("PULocationID").withColumnRenamed("PULocationID", "location_id")

    def dropoff_counts_all(self) -> DataFrame:
        return self._count_by("DOLocationID").withColumnRenamed("DOLocationID", "location_id")

    # -- weather ---------------------------------------------------------------------------------

    def _weather(self, *columns: str) -> DataFrame:
        """Weather hours with their trips, also hours without any.

        A weather row stands once per trip in averages, and once where there is no trip.
        """
        weather = self.dim_weather.select("datetime_id", *columns)
        trips = self.hour_rollup.select("datetime_id", "trips")
        joined = weather.join(trips, "datetime_id", "left").withColumns(
            {"weight": F.coalesce("trips", F.lit(1)), "trips": F.coalesce("trips", F.lit(0))}
        )
        return self.star.with_hours(joined, "year", "full_datetime").filter(self._wanted)

    def weather_monthly(self) -> DataFrame:
        def weighted(column: str) -> Column:
            value, weight = F.col(column), F.col("weight")
            known = F.sum(F.when(value.isNotNull(), weight))
            return round_half_up(F.try_divide(F.sum(value * weight), known)).alias(f"avg_{column}")

        month = F.trunc("full_datetime", "month").cast("timestamp_ntz").alias("year_month")
        grouped = self._weather("temp", "precip").groupBy(month)
        return grouped.agg(weighted("temp"), weighted("precip"), self._trips()).orderBy("year_month")

    def weather_conditions(self) -> DataFrame:
        grouped = self._weather("conditions").groupBy("conditions").agg(self._trips())
        return grouped.orderBy(F.desc("trip_count"), "conditions")

    def weather_scatter(self) -> DataFrame:
        return self._weather("temp").groupBy("temp").agg(self._trips()).orderBy("temp")

    # -- inputs of correlation and segmentation, one row per trip --------------------------------
    # ``also`` names further fact columns to carry, such as a row key for sampling.

    def correlation(self, *also: str) -> DataFrame:
        """Nine numeric columns per trip, all trips. Hours and weather are one small table."""
        facts = self.facts.filter("trip_duration_min IS NOT NULL AND trip_distance IS NOT NULL").select(
            "datetime_id", "fare_id", "trip_duration_min", "trip_distance", "passenger_count", *also
        )
        hours = self.star.dim_datetime.filter(self._wanted).select("datetime_id", "hour")
        weather = self.dim_weather.select("datetime_id", "temp", "precip")
        hours = hours.join(weather, "datetime_id", "left")
        small = fits_broadcast(self.star.hour_rows, hours.columns, self.star.broadcast_bytes)
        placed = facts.join(F.broadcast(hours) if small else hours, "datetime_id")
        priced = self.star.with_fares(placed, "fare_amount", "tip_amount", "total_amount")
        return priced.filter("fare_amount IS NOT NULL AND tip_amount IS NOT NULL").select(*CORRELATED, *also)

    def clustering(self, *also: str) -> DataFrame:
        duration, distance = F.col("trip_duration_min"), F.col("trip_distance")
        facts = self.facts.filter((duration > 0) & (duration < 180) & (distance > 0) & (distance < 100))
        placed = self._in_years(
            facts.select("datetime_id", "fare_id", "trip_duration_min", "trip_distance", *also), "hour", "day_of_week"
        )
        priced = self.star.with_fares(placed, "fare_amount", "total_amount", "tip_amount").filter("fare_amount > 0")
        return priced.select(
            "trip_duration_min",
            "trip_distance",
            "hour",
            "day_of_week",
            "fare_amount",
            "total_amount",
            "tip_amount",
            *also,
        )

    def cluster_data(self, *also: str) -> DataFrame:
        facts = self.facts.filter("trip_distance IS NOT NULL").select("datetime_id", "fare_id", "trip_distance", *also)
        priced = self.star.with_fares(self._in_years(facts), "tip_amount", "fare_amount")
        return priced.filter("tip_amount IS NOT NULL AND fare_amount IS NOT NULL").select(
            "tip_amount", "fare_amount", "trip_distance", *also
        )

    def tip_points(self) -> DataFrame:
        """``cluster_data`` as distinct fare and tip pairs with their weight."""
        facts = self.facts.filter("trip_distance IS NOT NULL").select("datetime_id", "fare_id")
        per_fare = self._in_years(facts).groupBy("fare_id").agg(F.count("*").alias("trips"))
        dim = self.star.dim_fare.select("fare_id", "fare_amount", "tip_amount")
        priced = per_fare.join(F.broadcast(dim) if self.star.fares_are_small else dim, "fare_id")
        return (
            priced.filter("tip_amount IS NOT NULL AND fare_amount IS NOT NULL")
            .groupBy("fare_amount", "tip_amount")
            .agg(F.sum("trips").cast("double").alias("weight"))
        )

    # -- all of them -----------------------------------------------------------------------------

    def all(self) -> dict[str, DataFrame]:
        names = (
            "monthly",
            "weekday",
            "heatmap",
            "fare_weekday",
            "hourly",
            "top_pickup_locations",
            "payment_type_distribution",
            "weather_monthly",
            "weather_conditions",
            "weather_scatter",
            "correlation",
            "clustering",
            "cluster_data",
            "pickup_counts_all",
            "dropoff_counts_all",
        )
        return {name: getattr(self, name)() for name in names}
