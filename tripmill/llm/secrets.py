"""Secrets in texts, and the weak parts of credentials that only count where their complements stand nearby.

Strong kinds are found by pattern and always reported. Weak kinds are parts of a credential: an account name,
a value under a vague name, an address. Alone each of them is ordinary text. A weak span is reported when, within
its scope, it meets what completes it: names and addresses need a secret, vague secrets need a name or an address.

Scopes join as intervals of the text: places fall into buckets as wide as a scope, and a span meets the buckets
beside its own. A bucket keeps the first and the last place of each part, which decide whether anything is near
enough, so the join has a row for a span and a bucket and never one for a pair of spans.

All is DataFrame functions. Places are code points: a text split by a pattern gives what lies between matches, and
running sums of lengths give the places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import checkpointed, text_of

# Patterns of the kinds that every scan must report.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]+)"


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that must have so many characters, and what part of a credential a match is.

    ``hint`` is a pattern without which no match can be long enough; texts without it are not searched.
    """

    name: str
    pattern: str
    group: int
    least: int
    hint: str
    part: str
    weak: bool = False


_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
KINDS = (
    Kind("assign", ASSIGN, 2, 8, "[:=]", "secret"),
    Kind("access", ACCESS, 1, 16, "AKIA[A-Z0-9]{12}", "name"),
    Kind("hex", HEX, 1, 32, "[0-9a-f]{32}", "secret"),
    Kind("user", r"\b((?i:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?))" + _VALUE + r"([A-Za-z0-9@._+-]+)", 2, 3, "[:=]", "name", True),
    Kind("value", r"\b((?i:pass|pwd|passphrase|credentials?|auth|private_?key|key))" + _VALUE + r"([A-Za-z0-9+/_.=-]+)", 2, 6, "[:=]", "secret", True),
    Kind("base64", r"([A-Za-z0-9+/]+)", 1, 40, "[A-Za-z0-9+/]{40}", "secret", True),
    Kind("url", r"\b([a-z][a-z0-9+.-]*://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+)", 1, 8, "://", "address", True),
    Kind("host", r"\b((?i:host(?:_?name)?|endpoint|server))" + _VALUE + r"([A-Za-z0-9._:-]+)", 2, 4, "[:=]", "address", True),
)
# What completes a weak part.
COMPLEMENTS = {"name": ("secret",), "address": ("secret",), "secret": ("name", "address")}


@dataclass(frozen=True)
class Settings:
    # Starts of two parts of one credential lie fewer than so many characters apart.
    scope: int = 400
    # Running sums are taken in runs of so many values, so that their cost stays far from the square of the matches.
    run: int = 64


def _running_sums(values: Column, run: int) -> Column:
    """Sums of all values up to each one."""
    total = lambda part: F.aggregate(part, F.lit(0).cast("bigint"), lambda s, x: s + x)
    runs = F.ceil(F.size(values) / run).cast("int")
    cut = F.when(F.size(values) > 0, F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.slice(values, i * run + 1, F.lit(run))))
    cut = F.coalesce(cut, F.array().cast("array<array<bigint>>"))

    def placed(cut: Column) -> Column:
        sums = F.transform(cut, total)
        return F.transform(cut, lambda part, i: F.transform(part, lambda _, j: total(F.slice(sums, F.lit(1), i)) + total(F.slice(part, F.lit(1), j + 1))))

    return F.flatten(F.transform(F.array(cut), placed)[0])


def _found(text: Column, number: int, kind: Kind, run: int) -> Column:
    """Spans (start, rank, end) of a text, leftmost and not overlapping. The rank is the kind's place in the list."""
    whole = F.regexp_extract_all(text, F.lit(f"({kind.pattern})"), F.lit(1))
    value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    gaps = F.split(text, kind.pattern, -1)
    length = lambda x: F.char_length(x).cast("bigint")
    ends = _running_sums(F.zip_with(F.slice(gaps, F.lit(1), F.size(whole)), whole, lambda g, m: length(g) + length(m)), run)
    span = lambda end, m: F.struct((end - length(m)).alias("start"), F.lit(number).alias("rank"), end.alias("end"))
    spans = F.zip_with(ends, whole, span)
    long = F.filter(F.arrays_zip(spans.alias("span"), value.alias("value")), lambda x: F.char_length(x["value"]) >= kind.least)
    searched = F.when(text.rlike(kind.hint), F.transform(long, lambda x: x["span"]))
    return F.coalesce(searched, F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>"))


def _spans(docs: DataFrame, doc_id: str, text: str, settings: Settings) -> DataFrame:
    """Spans of all kinds, by row; the key is a hash of the text, on which alone the spans depend."""
    body = F.col("body")
    read = docs.select(docs[doc_id].alias("doc_id"), text_of(text).alias("body"))
    kinds = [(i, k, _found(body, i, k, settings.run)) for i, k in enumerate(KINDS)]
    strong = F.concat(*[spans for _, k, spans in kinds if not k.weak])
    weak = F.concat(*[spans for _, k, spans in kinds if k.weak])
    key = F.struct(F.xxhash64("body").alias("a"), F.xxhash64(F.lit(1), "body").alias("b"))
    return read.select("doc_id", key.alias("key"), strong.alias("strong"), weak.alias("weak"))


def _of(column: Column, values: dict[int, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), column)


def linked(spans: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows (key, linked): the weak spans of a text that meet a complement in their scope, one row for each text
    that has any. ``spans`` has ``key`` and the arrays ``strong`` and ``weak``."""
    texts = spans.where("size(weak) > 0").dropDuplicates(["key"])
    placed = texts.select("key", F.explode(F.concat("strong", "weak")).alias("span"))
    placed = placed.withColumn("part", _of(F.col("span.rank"), {i: k.part for i, k in enumerate(KINDS)}))
    bucket = F.expr(f"span.start div {settings.scope}")
    there = placed.withColumn("bucket", bucket).groupBy("key", "bucket", "part")
    there = there.agg(F.min("span.start").alias("first"), F.max("span.start").alias("last"))
    # Characters of a strong span complete nothing, so weak spans that overlap one go.
    in_order = Window.partitionBy("key").orderBy("span.start", "span.rank")
    strong = ~F.col("span.rank").isin([i for i, k in enumerate(KINDS) if k.weak])
    before = F.max(F.when(strong, F.col("span.end"))).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(strong, F.col("span.start"))).over(in_order.rowsBetween(0, Window.unboundedFollowing))
    ordered = placed.select("key", "span", "part", strong.alias("strong"), before.alias("before"), after.alias("after"))
    free = "not strong and coalesce(before <= span.start, true) and coalesce(after >= span.end, true)"
    asking = ordered.where(free).withColumn("bucket", bucket)
    needs = F.lit(None).cast("array<string>")
    for name, others in COMPLEMENTS.items():
        needs = F.when(F.col("part") == name, F.array(*[F.lit(x) for x in others])).otherwise(needs)
    asking = asking.select("key", "span", F.explode(needs).alias("part"), "bucket")
    asking = asking.select("key", "span", "part", F.explode(F.array(*[F.col("bucket") + d for d in (-1, 0, 1)])).alias("bucket"))
    met = asking.join(there, ["key", "part", "bucket"])
    start = F.col("span.start")
    near = (F.abs(start - F.col("first")) < settings.scope) | (F.abs(start - F.col("last")) < settings.scope)
    return met.where(near).groupBy("key").agg(F.collect_set("span").alias("linked"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row: id and ``spans``, an array of (start, rank, kind, end, base) by start, then by kind as listed.

    ``start`` and ``end`` (exclusive) count code points; ``base`` marks the strong kinds. Matches of a kind are
    leftmost and do not overlap; those with too few characters are dropped. Null and empty texts have no spans.
    Equal texts have equal spans, whatever their ids. An empty table gives no rows; other columns are not read.
    """
    found = checkpointed(_spans(docs, doc_id, text, settings))
    # Written, so that the join deals both sides anew and a text that very many rows have can be split.
    more = checkpointed(linked(found, settings))
    plain = found.where("size(weak) = 0").select("doc_id", F.col("strong").alias("all"))
    asked = found.where("size(weak) > 0").join(more, "key", "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    asked = asked.select("doc_id", F.concat("strong", F.coalesce("linked", none)).alias("all"))
    names, weak = {i: k.name for i, k in enumerate(KINDS)}, [i for i, k in enumerate(KINDS) if k.weak]
    named = F.transform(
        F.array_sort("all"),
        lambda s: F.struct(s["start"], s["rank"], _of(s["rank"], names).alias("kind"), s["end"], (~s["rank"].isin(weak)).alias("base")),
    )
    return plain.union(asked).select(F.col("doc_id").alias(doc_id), named.alias("spans"))
