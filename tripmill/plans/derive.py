"""What is computed from marts: names, shares, pivots, labels, map markers, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.columns import MONTH_NAMES, day_name, is_weekend, round_even
from tripmill.plans.marts import CORRELATED

# Built-in zone names by location id.
ZONE_NAMES = {
    48: "Clinton East",
    68: "East Chelsea",
    79: "East Harlem North",
    90: "Financial District North",
    132: "JFK Airport",
    138: "LaGuardia Airport",
    140: "Lenox Hill West",
    141: "Lenox Hill East",
    142: "Lincoln Square East",
    161: "Midtown Center",
    162: "Midtown East",
    163: "Midtown North",
    164: "Midtown South",
    170: "Murray Hill",
    186: "Penn Station/Madison Sq West",
    230: "Times Sq/Theatre District",
    234: "Union Sq",
    236: "Upper East Side North",
    237: "Upper East Side South",
    239: "Upper West Side North",
}
# Display names of the correlated variables.
DISPLAY_NAMES = {
    "trip_duration_min": "Trip Duration",
    "trip_distance": "Trip Distance",
    "fare_amount": "Fare Amount",
    "tip_amount": "Tip Amount",
    "total_amount": "Total Amount",
    "passenger_count": "Passenger Count",
    "temp": "Temperature",
    "precip": "Precipitation",
    "hour": "Hour of Day",
}


def _lookup(names: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[key]


def month_start(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("year_month", F.make_date("year", "month", F.lit(1)))


def day_names(df: DataFrame) -> DataFrame:
    return df.withColumn("day_name", day_name(F.col("day_of_week"))).orderBy("day_of_week")


def weekend_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_weekend", is_weekend(F.col("day_of_week")))


def heatmap_pivot(heatmap: DataFrame, months: Sequence[int] | None = None) -> DataFrame:
    """Seven rows of days, one column per month, zero where nothing was counted.

    Without ``months`` those that occur are looked up, which costs a job for at most twelve values.
    """
    if months is None:
        months = sorted(r["month"] for r in heatmap.select("month").distinct().collect() if r["month"] is not None)
    names = {str(m): MONTH_NAMES[m - 1] for m in months}
    pivot = heatmap.groupBy("day_of_week").pivot("month", list(months)).sum("trip_count")
    spine = heatmap.sparkSession.range(7).select(F.col("id").cast("int").alias("day_of_week"))
    filled = spine.join(pivot, "day_of_week", "left").na.fill(0, list(names))
    return day_names(filled.withColumnsRenamed(names))


def average_or_default(value: Column, default: float = 0.0) -> Column:
    """Mean, or the default for no rows or only nulls."""
    return F.coalesce(F.avg(value), F.lit(default))


def kpis(monthly: DataFrame) -> DataFrame:
    """``avg_duration`` is the plain mean of the monthly means; the mean per trip stands beside it."""
    weighted = F.try_divide(
        F.sum(F.col("avg_duration") * F.col("trip_count")),
        F.sum(F.when(F.col("avg_duration").isNotNull(), F.col("trip_count"))),
    )
    return monthly.agg(
        average_or_default(F.col("avg_duration")).alias("avg_duration"),
        F.coalesce(weighted, F.lit(0.0)).alias("avg_duration_per_trip"),
        F.coalesce(F.sum("trip_count"), F.lit(0)).alias("total_trips"),
    )


def zone_labels(df: DataFrame, lookup: DataFrame | None, location: str = "location_id", name: str = "zone_label") -> DataFrame:
    """"Zone (Borough)", else the zone, else the built-in name, else "Zone <id>".

    No broadcast hint: both sides are small here and Spark knows or measures their size.
    """
    identifier = F.col(location)
    fallback = F.coalesce(
        _lookup(ZONE_NAMES, identifier.cast("int")), F.concat(F.lit("Zone "), identifier.cast("bigint").cast("string"))
    )
    if lookup is None:
        return df.withColumn(name, fallback)
    zones = lookup.select(
        F.col("LocationID").alias("_id"), F.nullif("Zone", F.lit("")).alias("_zone"), F.nullif("Borough", F.lit("")).alias("_borough")
    )
    joined = df.join(zones, identifier == F.col("_id"), "left")
    label = F.coalesce(F.concat("_zone", F.lit(" ("), "_borough", F.lit(")")), F.col("_zone"), fallback)
    return joined.withColumn(name, label).drop("_id", "_zone", "_borough")


def top_pickup_labels(top: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Labels for the top locations, ascending by trips; without a lookup the built-in names are used."""
    return zone_labels(top, lookup, "pulocationid", "zone_name").orderBy("trip_count", F.desc("pulocationid"))


def locate(counts: DataFrame, centroids: DataFrame) -> DataFrame:
    """Counts with the centroid of their zone; zones without centroid are dropped."""
    return counts.join(centroids, "location_id", "left").filter("lon IS NOT NULL AND lat IS NOT NULL")


def locate_report(counts: DataFrame, centroids: DataFrame) -> DataFrame:
    joined = counts.join(centroids, "location_id", "left")
    missing = F.col("lon").isNull() | F.col("lat").isNull()
    return joined.agg(
        F.count("*").alias("rows"), F.count_if(~missing).alias("kept"), F.count_if(missing).alias("dropped")
    )


def markers(located: DataFrame, label: str = "zone_label") -> DataFrame:
    """Marker size by the root of the count relative to the largest, and hover text."""
    largest = located.agg(F.max("trip_count")).scalar()
    share = F.col("trip_count") / largest
    text = F.concat(F.col(label), F.lit("<br>Trips: "), F.format_number("trip_count", 0))
    return located.withColumns({"size": F.lit(6.0) + F.lit(20.0) * F.sqrt(share), "text": text})


def shares(counts: DataFrame, column: str = "trip_count") -> DataFrame:
    """Share of each row in the total, in percent."""
    total = counts.agg(F.sum(column)).scalar()
    return counts.withColumn("percent", F.try_divide(F.col(column) * F.lit(100.0), total))


# Rows that are looked at for values near which moments are taken.
_NEAR_ROWS = 100
# A variance below this part of the mean square is rounding: the values are all the same.
_CONSTANT = 1e-13


def _near_values(numeric: DataFrame) -> list[float]:
    """Some known value of each column: moments about it do not cancel as moments about zero do. A constant column
    has its only value here, which makes its variance exactly zero."""
    rows = numeric.head(_NEAR_ROWS)
    return [next((float(r[i]) for r in rows if r[i] is not None), 0.0) for i in range(len(numeric.columns))]


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """``(row_no, col_no, variable, other, correlation, text)`` for every ordered pair, in one pass.

    Each pair uses the rows where both are known, and is null where it is undefined: the built-in ``corr``
    divides by zero on a constant column under ANSI rules. Rows are grouped by which columns they know, one
    set of counts, sums and products for each such pattern; a pair adds up the patterns that know both. There
    are at most 2 ** columns patterns, so after the one pass only they are combined.
    """
    numeric = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    near = _near_values(numeric)
    places = range(len(columns))
    pairs = [(i, j) for i in places for j in places if i <= j]
    pattern = reduce(add, [F.when(F.col(f"v{i}").isNotNull(), 1 << i).otherwise(0) for i in places])
    shifted = numeric.select(pattern.alias("known"), *[F.coalesce(F.col(f"v{i}") - near[i], F.lit(0.0)).alias(f"z{i}") for i in places])
    sums = [F.sum(f"z{i}").alias(f"s{i}") for i in places] + [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"p{i}_{j}") for i, j in pairs]
    patterns = shifted.groupBy("known").agg(F.count("*").cast("double").alias("n"), *sums)

    def moments(i: int, j: int) -> Column:
        values = {"n": "n", "x": f"s{i}", "y": f"s{j}", "xx": f"p{i}_{i}", "yy": f"p{j}_{j}", "xy": f"p{i}_{j}"}
        both = (F.col("known").bitwiseAND(1 << i) != 0) & (F.col("known").bitwiseAND(1 << j) != 0)
        return F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), *[F.when(both, F.col(c)).otherwise(0.0).alias(k) for k, c in values.items()])

    whole = patterns.select(F.inline(F.array(*[moments(i, j) for i, j in pairs]))).groupBy("i", "j")
    whole = whole.agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    mean = {c: F.try_divide(F.col(c), F.col("n")) for c in ("x", "y", "xx", "yy", "xy")}

    def variance(square: Column, value: Column) -> Column:
        spread = square - value * value
        return F.when(spread > square * _CONSTANT, spread)

    own, other = variance(mean["xx"], mean["x"]), variance(mean["yy"], mean["y"])
    value = F.when(F.col("i") == F.col("j"), F.when(own > 0, 1.0)).otherwise((mean["xy"] - mean["x"] * mean["y"]) / F.sqrt(own * other))
    halves = whole.select("i", "j", value.alias("correlation"))
    turned = "inline(IF(i = j, array(struct(i, j)), array(struct(i, j), struct(j AS i, i AS j)))) AS (i, j)"
    matrix = halves.selectExpr(turned, "correlation")
    names = F.array(*[F.lit(c) for c in columns])
    text = F.format_string("%.2f", round_even(F.col("correlation")))
    return matrix.select(
        (F.col("i") + 1).alias("row_no"),
        (F.col("j") + 1).alias("col_no"),
        names[F.col("i")].alias("variable"),
        names[F.col("j")].alias("other"),
        "correlation",
        F.when(F.col("correlation").isNotNull(), text).alias("text"),
    )


def display_names(matrix: DataFrame) -> DataFrame:
    return matrix.withColumns({c: F.coalesce(_lookup(DISPLAY_NAMES, F.col(c)), F.col(c)) for c in ("variable", "other")})
