"""Exact stratified sampling without replacement."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.keys import dense_key
from tripmill.session import Stage

SAMPLE_ROWS = 50_000
STRATUM_FLOOR = 100

# Rows that are looked at beyond those wanted: so many times the root of their number, and some.
SLACK = 6.0
SPARE = 20


def stratum_targets(sizes: Mapping, total: int = SAMPLE_ROWS, floor: int = STRATUM_FLOOR) -> dict:
    """Rows to take per stratum: proportional, at least ``floor``, at most what there is."""
    rows = sum(sizes.values())
    return {s: min(n, max(int(total * (n / rows)), floor)) for s, n in sizes.items()}


def hash_unit(key: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) that depends on the row key and the seed only: 52 bits of an MD5, which SQL engines share."""
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key], F.lit(str(seed)))
    digits = F.substring(F.md5(text.cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") * F.lit(2.0**-52)


def stratified_sample(
    df: DataFrame,
    stratum: str,
    key: Sequence[str],
    stage: Stage,
    total: int = SAMPLE_ROWS,
    floor: int = STRATUM_FLOOR,
    seed: int = 42,
) -> DataFrame:
    """The rows with the smallest hashes of each stratum, exactly as many as ``stratum_targets`` says.

    ``key`` should identify a row, and strata must be few, as their sizes come to the driver. The input is read
    twice: for the sizes, and for the candidates of each stratum, whose hash is below a bound that a few more
    rows than are wanted should pass. Tasks keep their own candidates, which merge by union and stay about as
    many as are wanted; only they are put in order. A stratum that comes out short, which chance alone all but
    rules out, is read again with twice its bound. Rows that share a key share a hash; which of them are taken
    when not all are wanted depends on their layout.
    """
    sizes = {r[0]: r[1] for r in df.groupBy(stratum).count().collect()}
    targets = stratum_targets(sizes, total, floor)
    if not targets:
        return df
    hashed = df.withColumn("_unit", hash_unit(key, seed))
    bounds = {s: min(1.0, (n + SLACK * math.sqrt(n) + SPARE) / sizes[s]) for s, n in targets.items()}
    while True:
        candidates = hashed.filter(F.col("_unit") < _by_stratum(stratum, bounds))
        candidates = stage.save(candidates.withColumn("_row", F.monotonically_increasing_id()), "candidates")
        found = {r[0]: r[1] for r in candidates.groupBy(stratum).count().collect()}
        short = [s for s, n in targets.items() if found.get(s, 0) < n]
        if not short:
            break
        bounds |= {s: max(2 * bounds[s], 1 / sizes[s]) for s in short}
    order = [stratum, "_unit", *[c for c in key if c != stratum], "_row"]
    numbered = stage.save(dense_key(candidates, order, "_at", stage), "numbered")
    # Few strata, so this is a small table: where each begins in the numbering.
    begins = numbered.groupBy(F.col(stratum).alias("_stratum")).agg(F.min("_at").alias("_begin"))
    placed = numbered.join(F.broadcast(begins), F.col(stratum).eqNullSafe(F.col("_stratum")))
    return placed.filter(F.col("_at") - F.col("_begin") < _by_stratum(stratum, targets)).select(*df.columns)


def sample_rows(df: DataFrame, rows: int, key: Sequence[str], stage: Stage, seed: int = 42) -> DataFrame:
    """Exactly ``rows`` rows, or all if there are fewer: the cap some reports put on their input."""
    whole = df.withColumn("_all", F.lit(1))
    return stratified_sample(whole, "_all", key, stage, rows, 0, seed).drop("_all")


def _by_stratum(stratum: str, values: Mapping) -> Column:
    cases = F.lit(None)
    for name, value in values.items():
        cases = F.when(F.col(stratum).eqNullSafe(F.lit(name)), F.lit(value)).otherwise(cases)
    return cases
