"""k-means on weighted points whose result does not depend on partitions, retries or engine.

Points are held in whole units of ``1 / UNIT``. Sums of coordinates are exact decimals and a centroid is their
quotient in whole units, so the order in which rows meet changes nothing, and SQL on another engine gives the
same centroids.

Seeds are drawn with odds in proportion to weight times squared distance from the seeds so far: every point gets an
exponential key from a hash of itself, divided by its odds, and the least key wins. That is one aggregate for
each seed, for all restarts together.

A Lloyd round is one aggregate for all restarts that still move: a point's clusters in all of them make one code, and
sums are kept by code, so points are not multiplied. There are at most k ** restarts codes, and few in practice.

Settled points are skipped. Where a point's nearest centroid is nearer than the next one by more than twice what any
centroid may still move, the triangle inequality keeps its cluster. Such points are folded into their sums once;
rounds read the others alone, until some centroid has left its allowance and the fold is made anew.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 1 << 32
# Points are folded every so many rounds at most, with an allowance of so many times the last movement.
FOLD_ROUNDS = 3
FOLD_ALLOWANCE = 4.0

Centroid = tuple[int, ...]


@dataclass(frozen=True)
class Fit:
    centroids: list[list[float]]
    cost: float
    costs: list[float]


@dataclass
class Run:
    """One restart: centroids in units, and how far they last moved."""

    number: int
    centroids: list[Centroid]
    moved: float = math.inf


# Of a point ``x`` and the centroids of one run, ``run``. Distances are summed in the order of the features.
_SQUARES = "transform(run, m -> aggregate(zip_with(m, x, (a, b) -> (b - a) * (b - a)), 0D, (p, q) -> p + q))"
_NEAREST = f"transform(array({_SQUARES}), d -> array_position(d, array_min(d)) - 1)[0]"
# Far above what rounding does to the distances.
_SETTLED = f"""transform(array(array_sort(transform({_SQUARES}, d -> sqrt(d)))), d -> CASE WHEN size(d) < 2 THEN true
  ELSE d[1] - d[0] > 2 * allowed + 1 + 1e-9 * (d[0] + d[1]) END)[0]"""


def _in_units(points: DataFrame, features: Sequence[str]) -> DataFrame:
    """``x``, whole numbers of units as doubles, which hold them exactly, and ``weight``."""
    units = [F.floor(F.col(c) * float(UNIT) + 0.5).cast("double") for c in features]
    return points.select(F.array(*units).alias("x"), F.col("weight").cast("bigint").alias("weight"))


def _with_centroids(data: DataFrame, runs: Sequence[Run], allowed: Sequence[float] = ()) -> DataFrame:
    """The points with the centroids of all runs in ``c`` and their allowances in ``allowances``."""

    def numbers(values) -> str:
        return "array(" + ", ".join(numbers(v) if isinstance(v, (list, tuple)) else f"{float(v)!r}D" for v in values) + ")"

    kinds = "array<array<array<double>>>", "array<double>"
    given = F.expr(f"struct(cast({numbers([r.centroids for r in runs])} AS {kinds[0]}) AS c, cast({numbers(allowed)} AS {kinds[1]}) AS a)")
    # A subquery's value, so that plans of all rounds are the same but for it.
    value = data.sparkSession.range(1).select(given.alias("v")).scalar()
    return data.withColumn("v", value).select(*data.columns, F.col("v.c").alias("c"), F.col("v.a").alias("allowances"))


def _seeds(data: DataFrame, dims: int, k: int, numbers: Sequence[int]) -> list[Run]:
    runs = [Run(n, []) for n in numbers]
    whole = ", ".join(f"cast(x[{j}] AS bigint)" for j in range(dims))
    for i in range(k):
        keys = []
        for at, run in enumerate(runs):
            unit = f"(cast(conv(substring(md5(cast(concat_ws(':', {run.number}, {i}, {whole}) AS binary)), 1, 8), 16, 10) AS bigint) + 1) / {float(1 << 32)}D"
            far = f"far[{at}]" if i else "1D"
            keys.append(F.expr(f"min(CASE WHEN {far} > 0 THEN struct(-ln({unit}) / (cast(weight AS double) * {far}) AS key, x) END)").alias(f"r{at}"))
        placed = _with_centroids(data, runs).withColumn("far", F.expr(f"transform(c, run -> array_min({_SQUARES}))"))
        drawn = placed.agg(*keys).first()
        for run, seed in zip(runs, drawn):
            if seed is not None:
                run.centroids.append(tuple(int(x) for x in seed["x"]))
    return runs


def _sums(data: DataFrame, runs: Sequence[Run], dims: int, k: int) -> list[list[list[int]]]:
    """Weight and weighted coordinates of each cluster of each run."""
    code = F.expr(f"aggregate(c, 0L, (code, run) -> code * {k} + {_NEAREST})").alias("code")
    weight = F.col("weight").cast("decimal(18,0)")
    parts = [F.sum(weight)] + [F.sum(F.col("x")[j].cast("decimal(19,0)") * weight) for j in range(dims)]
    found = [[[0] * (dims + 1) for _ in range(k)] for _ in runs]
    for code, *sums in _with_centroids(data, runs).groupBy(code).agg(*parts).collect():
        for place in reversed(range(len(runs))):
            code, cluster = divmod(code, k)
            found[place][cluster] = [a + int(b) for a, b in zip(found[place][cluster], sums)]
    return found


def _quotient(total: int, weight: int) -> int:
    """Rounded towards zero, as SQL divides whole numbers."""
    return total // weight if total >= 0 else -(-total // weight)


def _distance(a: Centroid, b: Centroid) -> float:
    return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))


class _Fold:
    """Points that keep their cluster while no centroid leaves its allowance, as sums; the others as rows."""

    def __init__(self, data: DataFrame, runs: Sequence[Run], dims: int, k: int) -> None:
        self.from_centroids = {run.number: list(run.centroids) for run in runs}
        self.allowed = {run.number: FOLD_ALLOWANCE * run.moved for run in runs}
        settled = F.expr(f"forall(zip_with(c, allowances, (run, allowed) -> {_SETTLED}), t -> t)")
        placed = _with_centroids(data, runs, list(self.allowed.values())).withColumn("settled", settled)
        self.loose = placed.where("not settled").select(*data.columns).persist(StorageLevel.MEMORY_AND_DISK)
        sums = _sums(placed.where("settled").select(*data.columns), runs, dims, k)
        self.sums = {run.number: sums[i] for i, run in enumerate(runs)}

    def holds(self, runs: Sequence[Run]) -> bool:
        return all(
            _distance(now, then) <= self.allowed[run.number]
            for run in runs
            for now, then in zip(run.centroids, self.from_centroids[run.number])
        )

    def close(self) -> None:
        self.loose.unpersist()


def _lloyd(data: DataFrame, points: int, runs: list[Run], dims: int, k: int, rounds: int, tolerance: float) -> None:
    fold: _Fold | None = None
    since = 0
    try:
        for number in range(rounds):
            moving = [run for run in runs if run.moved > tolerance * UNIT]
            if not moving:
                return
            if fold and not fold.holds(moving):
                fold.close()
                fold = None
            if fold is None and number and since >= FOLD_ROUNDS:
                fold, since = _Fold(data, moving, dims, k), 0
                # While centroids move far, few points are settled and reading them all costs no more.
                if fold.loose.count() > points / 2:
                    fold.close()
                    fold = None
            since += 1
            sums = _sums(fold.loose if fold else data, moving, dims, k)
            for run, clusters in zip(moving, sums):
                if fold:
                    clusters = [[a + b for a, b in zip(x, y)] for x, y in zip(clusters, fold.sums[run.number])]
                new = [
                    tuple(_quotient(x, weight) for x in total) if weight else old
                    for old, (weight, *total) in zip(run.centroids, clusters)
                ]
                run.moved = max(abs(x - y) for a, b in zip(new, run.centroids) for x, y in zip(a, b))
                run.centroids = new
    finally:
        if fold:
            fold.close()


def fit(
    points: DataFrame,
    features: Sequence[str],
    k: int,
    seed: int = 42,
    restarts: int = 10,
    max_iterations: int = 300,
    tolerance: float = 1e-4,
) -> Fit:
    """Best of several runs on weighted points; a run ends when no coordinate of a centroid moves by more than the
    tolerance. Centroids are in the order of their coordinates. A cluster that loses all points stays where it is.

    Pass stored points: a lost executor re-reads them instead of repeating the joins behind them. Only
    centroids, sums by code and costs reach the driver. Fewer distinct points than ``k`` give as many
    centroids, none give none.
    """
    dims = len(features)
    data = _in_units(points, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not (distinct := data.count()):
            return Fit([], 0.0, [])
        runs = _seeds(data, dims, k, range(seed, seed + restarts))
        _lloyd(data, distinct, runs, dims, k, max_iterations, tolerance)

        placed = _with_centroids(data, runs).withColumn("far", F.expr(f"transform(c, run -> array_min({_SQUARES}))"))
        cost = [F.sum((F.col("far")[i] * F.col("weight")).cast("decimal(38,0)")).alias(f"r{i}") for i in range(restarts)]
        costs = [int(x) for x in placed.agg(*cost).first()]
    finally:
        data.unpersist()
    best = min(range(restarts), key=lambda i: (costs[i], i))
    centroids = [[x / UNIT for x in c] for c in sorted(runs[best].centroids)]
    return Fit(centroids, costs[best] / UNIT**2, [c / UNIT**2 for c in costs])
