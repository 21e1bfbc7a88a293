"""What the operators of this subpackage share: text buffers, checkpoints, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import shared_folder

# Documents are worked on in blocks of about so many bytes, so that temporary arrays stay small.
BLOCK_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder.

    The files stay unless ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, which removes them when the
    frame is no longer used.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def spread(df: DataFrame, each: int, rows: int = 1 << 20) -> DataFrame:
    """Deal a stored frame of narrow rows anew, so that tasks make about ``rows`` rows where a row becomes ``each``.

    No more partitions than a shuffle of the session has. Few bytes would else be read by few tasks.
    """
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(most, -(-df.count() * each // rows))))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one array, and the offsets at which each text starts; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    if not len(texts):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first and last row, bytes, offsets. A longer text stands alone."""
    data, offsets = utf8(texts)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, rows)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, root) per node, root being the smallest node.

    Alternates large-star and small-star steps until the set of edges no longer changes; it is then a star
    per component. A step is two joins or aggregates on edges. A node with many edges is pre-aggregated to
    its smallest neighbour, and its edges are joined back by key, which Spark splits when they are skewed.
    """
    current = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = None
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(nearest, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select("e.u", F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        current = checkpointed(small)
        # Order-free sums tell whether two sets of edges are the same.
        mark = current.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        if mark == seen:
            roots = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
        seen = mark
