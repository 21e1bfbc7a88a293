"""Document quality by hierarchical empirical Bayes: text evidence, and what the site around it is like.

1. A logistic regression on counted properties of the text gives each document a probability and, against
   the prior of the training rows, its evidence as a log-likelihood ratio.
2. The probabilities are summed by host and by path (a part of a host). The share of a host is shrunk
   towards the global share, and the share of a path towards that of its host; how strongly follows from how
   much shares of sites differ beyond chance (method of moments), so sparse sites follow their parent.
3. A document's own probability is taken out of its path and host before it is judged. Its score joins
   its evidence and the log odds of its path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import blocks, checkpointed, text_of
from tripmill.llm.toxicity import held_out


@dataclass(frozen=True)
class Settings:
    # At most about so many labelled rows are learned from.
    rows: int = 50_000
    penalty: float = 1e-4
    # Bounds of the prior strength, in documents: a site of this many is half its own and half its parent.
    weakest: float = 2.0
    strongest: float = 1e6
    # Copies of the site statistics, among which the documents of a hot site are spread.
    salts: int = 16
    keep_from: float = 0.5


FEATURES = (
    "letters", "upper", "digits", "spaces", "lines", "commas", "stops", "marks", "brackets", "symbols", "bars", "other",
    "log_bytes", "word_bytes", "line_bytes", "words_repeated",
)


def _classes() -> np.ndarray:
    """The class of each byte; bytes of characters beyond ASCII count as letters."""
    table = np.full(256, 11, np.uint8)
    for name, members in (
        (0, b"abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))),
        (1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (2, b"0123456789"),
        (3, b" \t"),
        (4, b"\n"),
        (5, b",;:"),
        (6, b"."),
        (7, b"!?"),
        (8, b"()[]{}<>"),
        (9, b"#$%&*+=@^_~/\\"),
        (10, b"|"),
    ):
        table[list(members)] = name
    return table


_CLASSES = _classes()


def properties(raw: bytes) -> list[float]:
    """Shares of kinds of characters, and sizes of words and lines; an empty text has zeros."""
    if not raw:
        return [0.0] * len(FEATURES)
    counts = np.bincount(_CLASSES[np.frombuffer(raw, np.uint8)], minlength=12)
    words = raw.split()
    sizes = [np.log1p(len(raw)), len(raw) / max(1, len(words)), np.log1p(len(raw) / (1 + counts[4]))]
    repeated = 1 - len(set(words)) / len(words) if words else 0.0
    return [*(counts / len(raw)), *sizes, repeated]


def with_properties(docs: DataFrame, keys: list[Column], text: str = "text") -> DataFrame:
    """The key columns and ``features`` of each row, in place."""
    source = docs.select(*keys, text_of(text).cast("binary").alias("_text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array([properties(x.as_py()) for x in batch.columns[-1]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], rows], schema.names)

    return source.mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    intercept: float
    # Log odds of good documents among the training rows.
    prior: float

    def evidence(self, features: str = "features") -> Column:
        """Log-likelihood ratio of the text alone."""
        terms = [F.lit(w) * F.col(features)[i] for i, w in enumerate(self.weights)]
        return sum(terms, F.lit(self.intercept - self.prior))


def train(described: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings()) -> Model:
    """Learn from labelled rows of ``described`` (doc_id, features) that are not held out.

    Of repeated labels of an id the largest counts; null ids and labels are not used. With one class or none
    the text gives no evidence.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("_label").alias("_label"))
    )
    share = settings.rows / max(1, known.count())
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 20)) < share * (1 << 20))
    sample = described.select("doc_id", "features").join(F.broadcast(chosen), "doc_id")
    sample = checkpointed(sample.select("_label", array_to_vector("features").alias("features")))
    sizes = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    prior = float(np.log((sizes.get(1, 0) + 1) / (sizes.get(0, 0) + 1)))
    if len(sizes) < 2:
        return Model((0.0,) * len(FEATURES), prior, prior)
    fitted = LogisticRegression(featuresCol="features", labelCol="_label", regParam=settings.penalty).fit(sample)
    return Model(tuple(map(float, fitted.coefficients)), float(fitted.intercept), prior)


def _strength(sites: DataFrame, parent: str, settings: Settings) -> float:
    """Prior strength by moments: the less shares of sites differ beyond chance, the stronger their parent.

    ``sites`` has n, total and the share of the parent. Chance alone gives a squared difference of
    p (1 - p) / n; what is more is the variance between sites, weighted by documents.
    """
    p, share = F.col(parent), F.col("total") / F.col("n")
    row = sites.agg(
        F.sum(F.col("n") * (share - p) ** 2).alias("spread"),
        F.sum(p * (1 - p)).alias("chance"),
        F.sum(F.col("n") * p * (1 - p)).alias("binomial"),
        F.sum("n").alias("n"),
    ).first()
    between = (row["spread"] or 0.0) - (row["chance"] or 0.0)
    if between <= 0:
        return settings.strongest
    return float(min(settings.strongest, max(settings.weakest, row["binomial"] / between - 1)))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: Column | None = None,
    path: Column | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per input row: id, ``host``, ``path``, ``evidence``, ``site_prior``, ``score`` and ``kept``.

    ``host`` and ``path`` are columns of ``docs``: the source, and the language within it, unless given.
    Null hosts or paths are sites of their own, named by an empty text. ``site_prior`` is the posterior share
    of good documents in the path without the document itself; ``score`` (0 to 1) joins it with the evidence
    of the text, and rows from ``keep_from`` on are ``kept``. Empty texts have the evidence of a text
    without properties. Repeated rows count and are judged each; an empty table gives no rows.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    keys = [
        F.col(doc_id).alias("doc_id"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
    ]
    described = checkpointed(with_properties(docs, keys, text))
    model = train(described, labels, settings=settings)
    evidence = described.select("doc_id", "host", "path", model.evidence().alias("evidence"))
    logistic = lambda x: 1 / (1 + F.exp(-x))
    judged = evidence.withColumn("p", logistic(F.col("evidence") + model.prior))
    paths = judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("total"))
    paths = checkpointed(paths)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("total").alias("host_total"))
    whole = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_total").alias("total")).first()
    mean = float(whole["total"] / whole["n"]) if whole["n"] else 0.5
    of_hosts = hosts.select(F.col("host_n").alias("n"), F.col("host_total").alias("total"), F.lit(mean).alias("mean"))
    host_strength = _strength(of_hosts, "mean", settings)
    sites = paths.join(hosts, "host")
    host_share = (F.col("host_total") + host_strength * mean) / (F.col("host_n") + host_strength)
    path_strength = _strength(sites.withColumn("parent", host_share), "parent", settings)
    # A document of a hot site is sent to one of several copies of the site's row.
    salted = sites.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(settings.salts - 1))))
    salt = F.pmod(F.xxhash64("doc_id", "p"), F.lit(settings.salts)).cast("int")
    joined = judged.withColumn("salt", salt).join(salted, ["host", "path", "salt"])
    # Without the document itself, or it would be its own witness.
    parent = (F.col("host_total") - F.col("p") + host_strength * mean) / (F.col("host_n") - 1 + host_strength)
    site = (F.col("total") - F.col("p") + path_strength * parent) / (F.col("n") - 1 + path_strength)
    bounded = F.least(F.greatest(site, F.lit(1e-6)), F.lit(1 - 1e-6))
    with_site = joined.withColumn("site_prior", bounded)
    score = logistic(F.col("evidence") + F.log(F.col("site_prior") / (1 - F.col("site_prior"))))
    return with_site.select(
        F.col("doc_id").alias(doc_id),
        "host",
        "path",
        "evidence",
        "site_prior",
        score.alias("score"),
        (score >= settings.keep_from).alias("kept"),
    )
