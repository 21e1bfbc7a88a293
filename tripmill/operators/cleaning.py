"""Trip cleaning: row-local rules, one filter, removal counts in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.config import (
    CHARGE_COLUMNS,
    DROPOFF,
    NON_NEGATIVE_COLUMNS,
    PICKUP,
    RATE_CODE_COLUMNS,
    CleaningConfig,
)
from tripmill.functions.columns import as_number, as_timestamp, ntz, seconds_between


@dataclass(frozen=True)
class Rule:
    """A row is kept when ``keep`` is true; false and null both drop it."""

    name: str
    group: str
    keep: Column


class TripCleaner:
    """Rules for the columns that a frame has; rules on absent columns are left out."""

    def __init__(self, config: CleaningConfig = CleaningConfig()):
        self.config = config

    # -- rules -----------------------------------------------------------------------------------

    def rules(self, df: DataFrame) -> list[Rule]:
        """Rules in the order in which removals are attributed. Plain comparisons on scan columns come
        first, so they can be pushed into the Parquet reader."""
        return [
            *self.non_negative(df),
            *self.passengers(df),
            *self.pickup_range(df),
            *self.trip_shape(df),
            *self.charges(df),
            *self.payment_type(df),
            *self.rate_codes(df),
            *self.locations(df),
        ]

    def non_negative(self, df: DataFrame) -> list[Rule]:
        return [
            Rule(f"negative {name}", "non_negative", F.expr(f"`{name}` >= 0{_and_not_nan(df, name)}"))
            for name in NON_NEGATIVE_COLUMNS
            if name in df.columns
        ]

    def passengers(self, df: DataFrame) -> list[Rule]:
        if "passenger_count" not in df.columns:
            return []
        count = F.col("passenger_count")
        return [Rule("passenger count", "passengers", (count > 0) & (count <= self.config.max_passengers))]

    def pickup_range(self, df: DataFrame) -> list[Rule]:
        if PICKUP not in df.columns:
            return []
        pickup = as_timestamp(df, PICKUP)
        return [Rule("pickup date", "pickup_range", pickup.between(ntz(self.config.start), ntz(self.config.end)))]

    def distance(self) -> Column:
        return F.col("trip_distance").between(self.config.min_distance, self.config.max_distance)

    def duration(self, df: DataFrame) -> Column:
        return _hours(df).between(0.0, self.config.max_hours)

    def speed(self, df: DataFrame) -> Column:
        """A trip of zero duration has no speed and is dropped."""
        return F.col("trip_distance") / F.nullif(_hours(df), F.lit(0.0)) <= F.lit(self.config.max_mph)

    def trip_shape(self, df: DataFrame) -> list[Rule]:
        if not {"trip_distance", PICKUP, DROPOFF} <= set(df.columns):
            return []
        keep = self.distance() & self.duration(df) & self.speed(df)
        return [Rule("distance, duration or speed", "trip_shape", keep)]

    def charge_total(self, df: DataFrame) -> Column | None:
        """Sum of the charges that are present, or nothing to compare with."""
        present = [c for c in CHARGE_COLUMNS if c in df.columns]
        if "total_amount" not in df.columns or not present:
            return None
        return F.expr(" + ".join(f"coalesce(nanvl(`{c}`, 0D), 0D)" for c in present))

    def total_covers_charges(self, df: DataFrame) -> Column:
        total = F.expr(f"nanvl(`total_amount`, NULL) + {self.config.charge_tolerance}D")
        return total >= self.charge_total(df)

    def paid_fare(self, df: DataFrame) -> Column:
        """A zero fare beside positive charges is an error; a trip that is free altogether is kept."""
        free = (F.col("fare_amount") == 0) & (self.charge_total(df) > 0)
        return ~F.coalesce(free, F.lit(False))

    def charges(self, df: DataFrame) -> list[Rule]:
        if self.charge_total(df) is None:
            return []
        keep = self.total_covers_charges(df)
        if "fare_amount" in df.columns:
            keep = keep & self.paid_fare(df)
        return [Rule("charges", "charges", keep)]

    def payment_type(self, df: DataFrame) -> list[Rule]:
        if "payment_type" not in df.columns:
            return []
        keep = as_number(df, "payment_type").isin(*self.config.payment_types)
        return [Rule("payment type", "payment_type", keep)]

    def rate_codes(self, df: DataFrame) -> list[Rule]:
        return [
            Rule(f"rate code {name}", "rate_codes", as_number(df, name).isin(*self.config.rate_codes))
            for name in RATE_CODE_COLUMNS
            if name in df.columns
        ]

    def locations(self, df: DataFrame) -> list[Rule]:
        return [
            Rule(f"location {name}", "locations", as_number(df, name).between(1, self.config.max_location_id))
            for name in self.config.location_columns
            if name in df.columns
        ]

    # -- application -----------------------------------------------------------------------------

    def apply(self, df: DataFrame, rules: list[Rule]) -> DataFrame:
        return df.filter(reduce(and_, [rule.keep for rule in rules])) if rules else df

    def coerce(self, df: DataFrame) -> DataFrame:
        """Types after cleaning: zone-less timestamps and numeric codes."""
        changed = {c: as_timestamp(df, c) for c in (PICKUP, DROPOFF) if c in df.columns}
        for name in ("payment_type", *RATE_CODE_COLUMNS):
            if name in df.columns and _is_text(df, name):
                changed[name] = as_number(df, name).cast("bigint")
        for name in self.config.location_columns:
            if name in df.columns and _is_text(df, name):
                changed[name] = as_number(df, name).cast("bigint")
        return df.withColumns(changed) if changed else df

    def clean(self, df: DataFrame) -> DataFrame:
        return self.coerce(self.apply(df, self.rules(df)))

    def removals(self, df: DataFrame) -> DataFrame:
        """Rows removed by each rule when the rules run in order: ``(rule_no, rule, removed)``.

        Each row is attributed to the first rule it fails, so one scan and one small aggregate do.
        """
        rules = self.rules(df)
        if not rules:
            return df.sparkSession.createDataFrame([], "rule_no int, rule string, removed bigint")
        first_failed = F.coalesce(
            *[F.when(~F.coalesce(rule.keep, F.lit(False)), F.lit(i)) for i, rule in enumerate(rules)]
        )
        counts = df.select(first_failed.alias("failed")).where("failed IS NOT NULL").groupBy("failed").count()
        listed = df.sparkSession.createDataFrame([(i, r.name) for i, r in enumerate(rules)], "failed int, rule string")
        # One row per rule on either side.
        joined = listed.join(F.broadcast(counts), "failed", "left")
        return joined.select((F.col("failed") + 1).alias("rule_no"), "rule", F.coalesce("count", F.lit(0)).alias("removed"))


def _hours(df: DataFrame) -> Column:
    return seconds_between(as_timestamp(df, PICKUP), as_timestamp(df, DROPOFF)) / F.lit(3600.0)


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _and_not_nan(df: DataFrame, name: str) -> str:
    """Upper-bounded rules need no such guard: NaN sorts above every number."""
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return f" AND NOT isnan(`{name}`)" if floating else ""
