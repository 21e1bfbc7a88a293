"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of an n-gram in the whole text, as a bucket of a fixed hash table. Each feature
is multiplied by its naive Bayes log-count ratio, and a logistic regression is trained on the scaled
features. Labelled rows are a bounded sample: at most about ``Settings.rows`` of each class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import blocks, checkpointed, text_of, utf8

_SEED = np.uint32(2166136261)
_PRIME = np.uint32(16777619)
_MIX = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Settings:
    sizes: tuple[int, ...] = (4, 6)
    bits: int = 19
    rows: int = 10_000
    features: int = 20_000
    least_documents: int = 5
    smoothing: float = 1.0
    penalty: float = 1e-4
    iterations: int = 100


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a block of UTF-8 texts, and the offsets of the texts in them."""
    starts = (data & 0xC0) != 0x80
    before = np.r_[0, np.cumsum(starts)]
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), before[offsets]


def present_buckets(texts: pa.Array, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """For each text, the buckets of the n-grams that occur in it, each once.

    Case makes no difference. A text stands between two spaces, so that words at its ends look as they do
    inside. Of the places of a bucket the last one written to a table counts, which needs no sorting and no
    clearing.
    """
    table = np.zeros(1 << bits, np.int64)
    shift = np.uint32(32 - bits)
    for first, last, _, _ in blocks(texts):
        lowered = pc.utf8_lower(texts.slice(first, last - first).fill_null(""))
        points, ends = characters(*utf8(lowered))
        for begin, end in zip(ends[:-1], ends[1:]):
            text = np.empty(end - begin + 2, np.uint32)
            text[0] = text[-1] = 0x20
            text[1:-1] = points[begin:end]
            found, grams = [], np.full(len(text), _SEED)
            for n in range(1, max(sizes) + 1):
                if n > len(text):
                    break
                grams = (grams[: len(text) - n + 1] ^ text[n - 1 :]) * _PRIME
                if n in sizes:
                    found.append((grams * _MIX) >> shift)
            if not found:
                yield np.zeros(0, np.int64)
                continue
            buckets = np.concatenate(found)
            places = np.arange(len(buckets))
            table[buckets] = places
            yield buckets[table[buckets] == places].astype(np.int64)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text is a multiple of 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


@dataclass(frozen=True)
class Model:
    """Buckets with their weights (ratio times coefficient), and the intercept for the classes as they are."""

    settings: Settings
    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        table = np.zeros(1 << self.settings.bits)
        table[self.buckets] = self.weights
        present = present_buckets(texts, self.settings.sizes, self.settings.bits)
        margins = np.fromiter((table[x].sum() for x in present), np.float64, len(texts))
        return 1 / (1 + np.exp(-np.clip(margins + self.intercept, -700, 700)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    settings: Settings = Settings(),
) -> Model:
    """Learn from labelled documents that are not held out.

    Rows without a label, with a null id or a null label are not used; of repeated labels of an id the
    largest counts. With one class or none, the model is the smoothed share of the classes alone.
    """
    known = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
    )
    sizes = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    total = {c: sizes.get(c, 0) for c in (0, 1)}
    truth = float(np.log((total[1] + 1) / (total[0] + 1)))
    empty = Model(settings, np.zeros(0, np.int64), np.zeros(0), truth)
    if not all(total.values()):
        return empty
    # Chosen by a hash of the id, so the choice does not depend on partitions; about ``rows`` of each class.
    unit = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.where(unit < F.when(F.col("_label") == 1, settings.rows / total[1]).otherwise(settings.rows / total[0]))
    texts = docs.select(F.col(doc_id).alias("_id"), text_of(text).alias("_text"))
    sample = texts.join(F.broadcast(chosen), "_id").select("_text", "_label")
    sample = checkpointed(sample).coalesce(max(4, docs.sparkSession.sparkContext.defaultParallelism))
    counts = _document_counts(sample, settings)
    seen = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    if len(seen) < 2:
        return empty
    picked = _ratios(counts, seen, settings)
    buckets = np.array([r["bucket"] for r in picked], np.int64)
    ratios = np.array([r["ratio"] for r in picked])
    if not len(buckets):
        return empty
    regression = LogisticRegression(
        featuresCol="features",
        labelCol="_label",
        regParam=settings.penalty,
        maxIter=settings.iterations,
        standardization=False,
    ).fit(_vectors(sample, buckets, ratios, settings))
    coefficients = regression.coefficients.toArray()
    # The sample holds the classes in another proportion than the labels do.
    intercept = regression.intercept + truth - float(np.log(seen[1] / seen[0]))
    return Model(settings, buckets, coefficients * ratios, intercept)


def _document_counts(sample: DataFrame, settings: Settings) -> DataFrame:
    """Documents of each class that hold a bucket: summed within a task before anything is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << settings.bits), np.int64)
        for batch in batches:
            marks = batch.column(1).to_pylist()
            for mark, found in zip(marks, present_buckets(batch.column(0), settings.sizes, settings.bits)):
                counts[mark, found] += 1
        there = np.flatnonzero(counts.sum(0))
        for begin in range(0, len(there), 50_000):
            part = there[begin : begin + 50_000]
            columns = [part, counts[0, part], counts[1, part]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "clean", "toxic"])

    per_task = sample.select("_text", "_label").mapInArrow(run, "bucket long, clean long, toxic long")
    return per_task.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _ratios(counts: DataFrame, seen: dict[int, int], settings: Settings) -> list:
    """Log-count ratios of the buckets that tell the classes apart best; their number is a setting."""
    a = settings.smoothing
    toxic, clean = (F.col("toxic") + a) / (seen[1] + 2 * a), (F.col("clean") + a) / (seen[0] + 2 * a)
    spread = F.sqrt(1 / (F.col("toxic") + a) + 1 / (F.col("clean") + a))
    return (
        counts.where(F.col("toxic") + F.col("clean") >= settings.least_documents)
        .select("bucket", F.log(toxic / clean).alias("ratio"), F.abs(F.log(toxic / clean) / spread).alias("strength"))
        .orderBy(F.desc("strength"), "bucket")
        .limit(settings.features)
        .collect()
    )


def _vectors(sample: DataFrame, buckets: np.ndarray, ratios: np.ndarray, settings: Settings) -> DataFrame:
    """Scaled features of the sampled documents as sparse vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = np.full(1 << settings.bits, -1, np.int64)
        column[buckets] = np.arange(len(buckets))
        for batch in batches:
            lists = []
            for found in present_buckets(batch.column(0), settings.sizes, settings.bits):
                at = column[found]
                lists.append(np.sort(at[at >= 0]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(lists, pa.list_(pa.int32()))], ["_label", "at"])

    listed = sample.select("_text", "_label").mapInArrow(run, "_label int, at array<int>")
    # Places become vectors in the JVM, so that a task needs one Python worker and not two.
    places = CountVectorizerModel.from_vocabulary([str(n) for n in range(len(buckets))], "at", "found")
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratios), inputCol="found", outputCol="features")
    vectors = places.transform(listed.select("_label", F.col("at").cast("array<string>").alias("at")))
    return scaled.transform(vectors).select("_label", "features")


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the score of the whole text in ``column`` (double, 0 to 1).

    Scored in place: nothing is shuffled. Null counts as empty; an empty text gets the score of a text with
    no known n-gram. A column of the same name, in any case, gives way to the score.
    """
    source = docs.select(*[docs[c] for c in docs.columns if c == text or c.lower() != column.lower()])
    at = source.columns.index(text)
    gone = text.lower() == column.lower()
    fields = [f for f in source.schema.fields if not (gone and f.name == text)]
    schema = T.StructType([*fields, T.StructField(column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c for i, c in enumerate(batch.columns) if not (gone and i == at)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(model.scores(batch.column(at)))], schema.names)

    return source.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with the columns of ``docs``."""
    schema = docs.schema
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Small parts, so that what is kept is never a second copy of a whole batch.
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                yield part.filter(pa.array(model.scores(part.column(at)) < threshold))

    return docs.mapInArrow(run, schema)
