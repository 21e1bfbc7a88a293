"""URL rules by a Bloom filter cascade over the corpus's own keys.

A rule is a host and a beginning of a path. The keys a URL could be listed under are its host's endings at
dots, each with the beginnings of its path, as far as rules of such a shape exist. All keys of the corpus
together are the universe. The first filter holds the listed keys; the second one the keys of the
universe that the first takes for listed, and so on in turn, until a filter has no false positive. For keys of the
universe the answer is then exact, and a page is judged without a join.

The first filter has about one false positive for two listed keys, whatever the size of the universe, so
the cascade grows with the list, times the logarithm of the corpus. All of it is DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.bloom import Filter, build
from tripmill.llm.common import checkpointed

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path

    @property
    def shape(self) -> tuple[int, int]:
        """Labels of the host and characters of the path."""
        return self.host.count(".") + 1, len(self.path)


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where there is no ``://``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def candidates(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> list[Column]:
    """Keys under which a page could be listed: one for each shape, null where host or path are too short for it."""
    labels = F.split(host, "\\.")
    return [
        F.when(
            (F.size(labels) >= n) & (F.length(path) >= p) & (host != ""),
            F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring(path, 1, p)),
        )
        for n, p in shapes
    ]


def _filter(keys: DataFrame, count: int, false_share: float, seed: int) -> Filter:
    """A filter of ``keys`` that takes about ``false_share`` of other keys for its own."""
    per_key = 1.4427 * math.log2(1 / false_share)
    return build(keys, max(4, math.ceil(count * per_key / 64)), max(1, round(per_key * 0.6931)), seed)


@dataclass(frozen=True)
class Cascade:
    filters: tuple[Filter, ...]

    def lists(self, key: Column) -> Column:
        """The first filter that lacks the key decides; behind the last one the key belongs to what that one holds."""
        answer = F.lit(len(self.filters) % 2 == 1)
        for level in reversed(range(len(self.filters))):
            answer = F.when(~self.filters[level].holds(key), F.lit(level % 2 == 1)).otherwise(answer)
        return answer


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Encode which keys of ``universe`` are ``listed``; both have one column key of distinct, non-null values."""
    inside = checkpointed(universe.join(listed, "key", "left_semi"))
    outside = universe.join(listed, "key", "left_anti")
    n_inside, n_all = inside.count(), universe.count()
    share = min(0.25, max(1, n_inside) / (2 * max(1, n_all)))
    filters: list[Filter] = []
    held, others, count = inside, outside, n_inside
    while count:
        filters.append(_filter(held, count, share, len(filters)))
        wrong = checkpointed(others.where(filters[-1].holds(F.col("key"))))
        held, others, count, share = wrong, held, wrong.count(), 0.25
    return Cascade(tuple(filters))


def judge(
    pages: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per page: the id, ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains where the path begins with the rule's. The longest rule that fits
    (host and path together; of equal ones that with the longer host) decides, and a key listed for both
    is blocked. Pages that no rule fits get ``default`` and a null rule. Null URLs and those without
    ``://`` have an empty host and path. Repeated pages are judged each; other columns are not read.
    """
    host, path = host_and_path(url)
    parsed = pages.select(pages[page_id].alias(page_id), host.alias("host"), path.alias("path"))
    shapes = sorted({r.shape for r in rules})
    if not shapes:
        return parsed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # Subqueries cannot stand in functions over arrays, so each shape has a column.
    names = [f"key{i}" for i in range(len(shapes))]
    found = candidates(F.col("host"), F.col("path"), shapes)
    keyed = parsed.select("*", *[c.alias(n) for c, n in zip(found, names)])
    # The whole corpus's keys; equal keys are merged within each task before they are sent.
    universe = keyed.select(F.explode(F.array(*names)).alias("key")).where("key is not null").distinct()
    universe = checkpointed(universe)
    by_verdict = {}
    for verdict in ("block", "allow"):
        keys = sorted({r.key for r in rules if r.verdict == verdict})
        listed = pages.sparkSession.createDataFrame([(k,) for k in keys], "key string")
        by_verdict[verdict] = cascade(listed, universe)

    def fit(name: str) -> Column:
        key = F.col(name)
        verdict = F.when(by_verdict["block"].lists(key), "block").when(by_verdict["allow"].lists(key), "allow")
        # A host has no slash, so the host of a key ends before its first one.
        host_length = F.length(F.substring_index(key, "/", 1))
        rank = F.struct(F.length(key).alias("length"), host_length.alias("host"), key.alias("key"), verdict.alias("verdict"))
        return F.when(key.isNotNull() & verdict.isNotNull(), rank)

    best = F.array_max(F.array(*[fit(n) for n in names]))
    return keyed.select("*", best.alias("best")).select(
        page_id,
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
