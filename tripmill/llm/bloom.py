"""Bloom filters as DataFrame functions: built by an aggregation, read as a value of one row."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import checkpointed


@dataclass(frozen=True)
class Filter:
    """``words`` is a frame of one row; it joins nothing but is read as a value."""

    words: DataFrame
    bits: int
    hashes: int
    seed: int

    def holds(self, key: Column) -> Column:
        words = self.words.scalar()
        places = [_place(key, i, self.bits, self.seed) for i in range(self.hashes)]
        found = [F.getbit(F.get(words, (p / 64).cast("int")), (p % 64).cast("int")) == 1 for p in places]
        return reduce(lambda a, b: a & b, found)


@dataclass(frozen=True)
class HashedFilter:
    """A filter of values that are hashes themselves: high bits name a word, low bits four bits in it.

    One look-up and a few bit operations, so that the test stays within what the JVM compiles.
    """

    words: DataFrame
    log_words: int

    def holds(self, hashed: Column) -> Column:
        mask = _mask(hashed)
        word = F.get(self.words.scalar(), F.shiftrightunsigned(hashed, 64 - self.log_words).cast("int"))
        return word.bitwiseAND(mask) == mask


def _mask(hashed: Column) -> Column:
    one = lambda at: F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(hashed, at).bitwiseAND(63).cast("int")
    )
    return one(0).bitwiseOR(one(6)).bitwiseOR(one(12)).bitwiseOR(one(18))


def build_hashed(hashes: DataFrame, log_words: int) -> HashedFilter:
    """A filter of ``2 ** log_words`` words over 64-bit hashes (column key)."""
    key = F.col("key")
    word = F.shiftrightunsigned(key, 64 - log_words)
    return HashedFilter(_words(hashes.select(word.alias("word"), _mask(key).alias("bit")), 1 << log_words), log_words)


def _words(set_bits: DataFrame, words: int) -> DataFrame:
    """One row with all words in order; ``set_bits`` has rows (word, bit)."""
    empty = set_bits.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bit"))
    merged = set_bits.union(empty).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    listed = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return checkpointed(merged.agg(F.transform(listed, lambda x: x["bits"]).alias("words")))


def _place(key: Column, i: int, bits: int, seed: int) -> Column:
    first = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits))
    # An odd step visits all places before any twice, as the number of bits is a multiple of 64.
    step = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(bits)).bitwiseOR(1)
    return F.pmod(first + i * step, F.lit(bits)).cast("bigint")


def build(keys: DataFrame, words: int, hashes: int, seed: int) -> Filter:
    """A filter of ``words`` 64-bit words over ``keys`` (column key), which must not be null."""
    bits = 64 * words
    places = keys.select(F.explode(F.array(*[_place(F.col("key"), i, bits, seed) for i in range(hashes)])).alias("p"))
    set_bits = places.select((F.col("p") / 64).cast("bigint").alias("word"), F.expr("shiftleft(1L, int(p % 64))").alias("bit"))
    return Filter(_words(set_bits, words), bits, hashes, seed)
