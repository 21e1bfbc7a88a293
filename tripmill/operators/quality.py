"""Integrity checks over input, dimensions and fact, as one report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.config import PICKUP, QualityConfig
from tripmill.functions.columns import hour_number, ntz
from tripmill.operators.star import Star, distinct_hours

PREVIEW_ROWS = 5
CHECKS = ("row_count", "non_negative", "hour_coverage", "input_range", "hour_range", "fact_range")


class QualityCheckError(AssertionError):
    pass


class StarChecker:
    """Every table is scanned once, whatever the number of checks on it.

    Each table gives a one-row frame of counts; the frames are united, summed and turned into one report
    row per check.
    """

    def __init__(self, trips: DataFrame, star: Star, config: QualityConfig = QualityConfig()):
        self.trips = trips
        self.star = star
        self.config = config

    def _outside(self, moment: Column) -> Column:
        return (moment < ntz(self.config.start)) | (moment > ntz(self.config.end))

    def _checked(self, df: DataFrame) -> list[str]:
        return [c for c in self.config.columns if c in df.columns]

    def missing_hours(self) -> DataFrame:
        hours = self.star.dim_datetime.select("full_datetime")
        return distinct_hours(self.trips).join(hours, "full_datetime", "left_anti")

    def _input_counts(self, with_hours: bool) -> DataFrame:
        measures = [F.count("*").alias("input_rows"), F.count_if(self._outside(F.col(PICKUP))).alias("input_outside")]
        if not with_hours:
            return self.trips.agg(*measures)
        by_hour = self.trips.groupBy(hour_number(F.col(PICKUP)).alias("hour")).agg(*measures)
        hours = self.star.dim_datetime.select(hour_number(F.col("full_datetime")).alias("hour"), F.lit(True).alias("known"))
        hours = F.broadcast(hours) if self.star.hours_are_small else hours
        missing = F.count_if(F.col("hour").isNotNull() & F.col("known").isNull())
        return by_hour.join(hours, "hour", "left").agg(
            F.sum("input_rows").alias("input_rows"),
            F.sum("input_outside").alias("input_outside"),
            missing.alias("hours_missing"),
        )

    def _fact_counts(self, with_range: bool) -> DataFrame:
        fact = self.star.fact_trips
        negatives = {f"fact_{c}": F.count_if(F.col(c) < 0) for c in self._checked(fact)}
        measures = {"fact_rows": F.count("*"), **negatives}
        if not with_range:
            return fact.agg(*[m.alias(n) for n, m in measures.items()])
        by_hour = fact.groupBy("datetime_id").agg(*[m.alias(n) for n, m in measures.items()])
        joined = self.star.with_hours(by_hour, "full_datetime", how="left")
        outside = F.sum(F.when(self._outside(F.col("full_datetime")), F.col("fact_rows")).otherwise(0))
        return joined.agg(*[F.sum(n).alias(n) for n in measures], outside.alias("fact_outside"))

    def _frames(self, checks: Sequence[str]) -> list[DataFrame]:
        """Counts per table. Rows are counted per hour before a join with the hours, so that the join sees
        hours and not trips."""
        star, frames = self.star, []
        if {"row_count", "input_range", "hour_coverage"} & set(checks):
            frames.append(self._input_counts("hour_coverage" in checks))
        if {"row_count", "non_negative", "fact_range"} & set(checks):
            frames.append(self._fact_counts("fact_range" in checks and "datetime_id" in star.fact_trips.columns))
        if "non_negative" in checks and self._checked(star.dim_fare):
            negatives = [F.count_if(F.col(c) < 0).alias(f"fare_{c}") for c in self._checked(star.dim_fare)]
            frames.append(star.dim_fare.agg(*negatives))
        if "hour_range" in checks:
            outside = F.count_if(self._outside(F.col("full_datetime")))
            frames.append(star.dim_datetime.agg(outside.alias("hours_outside")))
        return frames

    def _violations(self, checks: Sequence[str]) -> list[tuple[str, Column]]:
        found: list[tuple[str, Column]] = []
        if "row_count" in checks:
            found.append(("row_count", F.abs(F.col("input_rows") - F.col("fact_rows"))))
        if "non_negative" in checks:
            found += [(f"non_negative fact {c}", F.col(f"fact_{c}")) for c in self._checked(self.star.fact_trips)]
            found += [(f"non_negative fare {c}", F.col(f"fare_{c}")) for c in self._checked(self.star.dim_fare)]
        if "hour_coverage" in checks:
            found.append(("hour_coverage", F.col("hours_missing")))
        if "input_range" in checks:
            found.append(("input_range", F.col("input_outside")))
        if "hour_range" in checks:
            found.append(("hour_range", F.col("hours_outside")))
        if "fact_range" in checks and "datetime_id" in self.star.fact_trips.columns:
            found.append(("fact_range", F.col("fact_outside")))
        return found

    def report(self, checks: Sequence[str] = CHECKS) -> DataFrame:
        """``(check_no, check_name, passed, violations)`` in the order in which the checks are to be read."""
        united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), self._frames(checks))
        totals = united.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in united.columns])
        rows = [
            F.struct(
                F.lit(i + 1).alias("check_no"),
                F.lit(name).alias("check_name"),
                (count == 0).alias("passed"),
                count.cast("bigint").alias("violations"),
            )
            for i, (name, count) in enumerate(self._violations(checks))
        ]
        return totals.select(F.inline(F.array(*rows)))

    def preview(self, check: str) -> DataFrame:
        """A few offending rows for a failed check."""
        star = self.star
        if check == "hour_coverage":
            return self.missing_hours().orderBy("full_datetime").limit(10)
        if check == "input_range":
            return self.trips.filter(self._outside(F.col(PICKUP))).select(PICKUP).limit(PREVIEW_ROWS)
        if check == "hour_range":
            return star.dim_datetime.filter(self._outside(F.col("full_datetime"))).limit(PREVIEW_ROWS)
        if check == "fact_range":
            joined = star.with_hours(star.fact_trips, "full_datetime", how="left")
            return joined.filter(self._outside(F.col("full_datetime"))).select("full_datetime").limit(PREVIEW_ROWS)
        if check.startswith("non_negative "):
            _, table, column = check.split(" ")
            df = star.fact_trips if table == "fact" else star.dim_fare
            return df.filter(F.col(column) < 0).select(column).limit(PREVIEW_ROWS)
        return self.report(["row_count"])

    def raise_on_failure(self, checks: Sequence[str] = CHECKS) -> None:
        """Stop at the first failed check. The report has one row per check, so collecting it is safe."""
        for row in sorted(self.report(checks).collect(), key=lambda r: r["check_no"]):
            if not row["passed"]:
                shown = [tuple(r) for r in self.preview(row["check_name"]).collect()]
                raise QualityCheckError(f"{row['check_name']}: {row['violations']} violations, such as {shown}")
