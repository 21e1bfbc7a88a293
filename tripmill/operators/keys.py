"""Surrogate keys and joins that hold when a key is hot or a dimension is large."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.session import Stage

BROADCAST_BYTES = 64 << 20
# A key is hot when it holds more than this share of all rows; there can be at most 1 / HOT_SHARE of them.
HOT_SHARE = 1e-5
# A hot key is spread over so many copies of its dimension row.
SALTS = 64
_ROW_BITS = 33


def row_bytes(columns: Sequence[str]) -> int:
    """Upper estimate of an in-memory row of fixed-width columns: header and null bits, 8 bytes each, hash slot."""
    return 32 + 16 * len(columns)


def fits_broadcast(rows: int, columns: Sequence[str], limit: int = BROADCAST_BYTES) -> bool:
    return rows * row_bytes(columns) <= limit


def dense_key(df: DataFrame, order: Sequence[str], key: str, stage: Stage) -> DataFrame:
    """Number rows 1..n in the order of ``order``, which must be distinct, without a global window.

    Rows are range-partitioned on all order columns. As no two rows are equal, every range can be split
    and none is hot. Inside a range the row keeps its position; the positions are written once, so that
    range sizes and rows come from the same layout, and each range is shifted by the rows before it.
    """
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    rows = stage.save(placed, key).withColumns(
        {
            "_range": F.shiftrightunsigned("_at", _ROW_BITS),
            "_row": F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1),
        }
    )
    # One row per range, so this window and broadcast grow with the number of tasks, not with the data.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    numbered = rows.join(F.broadcast(starts), "_range")
    return numbered.select(*df.columns, (F.col("_start") + F.col("_row") + 1).cast("bigint").alias(key))


def _matches(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool) -> Column:
    pairs = [(left[c], right[f"_dim_{c}"]) for c in on]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _renamed(df: DataFrame, on: Sequence[str], *others: str | Column) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_dim_{c}") for c in on], *others)


def salted_sides(
    facts: DataFrame, dimension: DataFrame, on: Sequence[str], hot: DataFrame, null_safe: bool, salts: int = SALTS
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: hot dimension rows stand once under each salt, a fact with a hot key has one.

    The salt of a fact comes from a hash of all its columns, so a task that is run again deals the same. Facts
    without a hot key have salt 0, as their dimension rows do.
    """
    hot_keys = F.broadcast(_renamed(hot, on, F.lit(salts).alias("_salts")))
    marked = facts.join(hot_keys, _matches(facts, hot_keys, on, null_safe), "left")
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*[facts[c] for c in facts.columns]), F.lit(salts)).cast("int"))
    salted = marked.select(*[facts[c] for c in facts.columns], F.coalesce(salt, F.lit(0)).alias("_salt"))
    repeated = dimension.join(hot_keys, _matches(dimension, hot_keys, on, True), "left")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_dim__salt")
    added = [c for c in dimension.columns if c not in on]
    return salted, repeated.select(*[dimension[c].alias(f"_dim_{c}") for c in on], *[dimension[c] for c in added], each)


def hot_split_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    hot: DataFrame | None,
    small: bool,
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Join facts to a dimension that holds every key once, reading the facts once.

    ``small`` says that the size of the dimension was checked: it is broadcast and the facts do not move.
    Otherwise both sides are shuffled by key and salt. The few hot keys are broadcast to mark their facts, which
    are spread over ``SALTS`` copies of the dimension row, so no task receives a hot key whole. Facts that are
    equal in all columns share a salt; beyond that, Spark can still split the join, as both sides are
    dealt for it. ``null_safe`` lets null keys equal each other; it stays an equi-join.
    """
    added = [c for c in dimension.columns if c not in on]
    if small or hot is None:
        renamed = _renamed(dimension, on, *added)
        renamed = F.broadcast(renamed) if small else renamed
        return facts.join(renamed, _matches(facts, renamed, on, null_safe), how).select(*facts.columns, *added)
    left, right = salted_sides(facts, dimension, on, hot, null_safe)
    matches = _matches(left, right, on, null_safe) & (left["_salt"] == right["_dim__salt"])
    return left.join(right, matches, how).select(*facts.columns, *added)
