"""Repeated passages by content-defined chunking with a gear rolling hash.

A chunk ends where the gear hash of the 16 bytes before is below a bound, so cuts depend on nearby bytes alone
and come back to the same places behind an insertion. Chunks are grouped by digest; all places of a digest
but the first (in order of document id, then place) are duplicates. Neighbouring duplicates of a document
form a run, and runs of at least ``Settings.least_bytes`` are reported as repeated spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import blocks, checkpointed, text_of


@dataclass(frozen=True)
class Settings:
    # A cut at one place in so many.
    spacing: int = 20
    shortest: int = 8
    # Shorter runs of repeated chunks are common turns of phrase. Cuts fall into step after 16 bytes and a
    # chunk, and the last chunk of a passage goes on behind it: of a repeated passage of 50 words, or about
    # 300 bytes, so much is left as a run in more than 99 of 100 cases.
    least_bytes: int = 64


# Gear values: fixed pseudo-random numbers, one for each byte.
_GEAR = np.frombuffer(
    b"".join(hashlib.blake2b(bytes([b]), digest_size=2).digest() for b in range(256)), "<u2"
).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash behind each byte: the sum of the values of the last 16 bytes, each shifted by its distance.

    Sums over 1, 2, 4, 8 and 16 bytes are built from each other, for all places at once.
    """
    value = _GEAR[data]
    for step in (1, 2, 4, 8):
        shifted = value[:-step] << np.uint16(step)
        value = value.copy()
        value[step:] += shifted
    return value


def cuts(data: np.ndarray, settings: Settings = Settings()) -> np.ndarray:
    """Ends of the chunks of one text, in bytes. A cut nearer than ``shortest`` to the one before is passed over."""
    if not len(data):
        return np.zeros(0, np.int64)
    places = np.flatnonzero(gear(data) < (1 << 16) // settings.spacing) + 1
    ends, last = [], 0
    for place in places.tolist():
        if place - last >= settings.shortest:
            ends.append(place)
            last = place
    if last < len(data):
        ends.append(len(data))
    return np.array(ends, np.int64)


def _row(doc_id: Column, text: Column) -> Column:
    return F.when(doc_id.isNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("bigint"))


def chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per chunk: ``doc_id``, ``row``, ``start`` and ``size`` in bytes of UTF-8, ``digest`` (64 bits: a run is
    several chunks). ``row`` tells rows without an id apart, by a hash of their text; it is 0 where there is an id."""
    source = docs.select(docs[doc_id].alias("doc_id"), text_of(text).alias("_text"), _row(docs[doc_id], text_of(text)).alias("row"))
    schema = T.StructType(
        [
            source.schema["doc_id"],
            T.StructField("row", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("size", T.LongType()),
            T.StructField("digest", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in blocks(batch.column(1)):
                rows, starts, ends = [], [], []
                for row in range(last - first):
                    stop = cuts(data[offsets[row] : offsets[row + 1]], settings)
                    rows.append(np.full(len(stop), first + row))
                    ends.append(stop + offsets[row])
                    starts.append(np.r_[0, stop[:-1]][: len(stop)] + offsets[row])
                row, start, end = map(np.concatenate, (rows, starts, ends))
                raw = data.tobytes()
                spans = zip(start.tolist(), end.tolist())
                digests = np.frombuffer(b"".join([hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in spans]), "<i8")
                columns = [batch.column(i).take(pa.array(row)) for i in (0, 2)] + [pa.array(start - offsets[row - first])]
                columns += [pa.array(end - start), pa.array(digests)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return source.mapInArrow(run, schema)


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """Spans that repeat an earlier place: rows (id, ``start``, ``size``, ``chunks``, ``source_id``).

    ``source_id`` is the document with the first place of the first chunk of the span; ``start`` and
    ``size`` are in bytes of UTF-8. The first place of a passage is not reported; places within the same
    document are. Null and empty texts have no chunks. Rows that repeat an id count as further places of the
    same document (the copy of a row repeats it only if its text is another place, which equal rows are not).
    Rows without an id come first, each text a document of its own, in the order of a hash; equal ones are one
    document. Other columns are not read.
    """
    return repeated_places(docs, doc_id, text, settings).drop("row")


def repeated_places(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``repeated_spans`` with ``row``, which tells rows without an id apart."""
    # Cut twice rather than stored: the chunks together take more room than the texts.
    pieces = chunks(docs, doc_id, text, settings)
    place = F.struct("doc_id", "row", "start")
    # Partial sums: a chunk that many documents share arrives as one row from each task.
    groups = pieces.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("places")).where("places > 1")
    # Written, so that the join deals both sides anew and Spark can split a digest that very many places have.
    groups = checkpointed(groups.select("digest", "first"))
    repeats = pieces.join(groups, "digest").where(F.col("first") != place)
    of_text = Window.partitionBy("doc_id", "row").orderBy("start")
    behind = F.lag(F.col("start") + F.col("size")).over(of_text)
    fresh = F.when(behind.isNull() | (F.col("start") > behind), F.col("start"))
    begun = repeats.select("doc_id", "row", "start", "size", F.col("first.doc_id").alias("source_id"), fresh.alias("fresh"))
    begin = F.last("fresh", ignorenulls=True).over(of_text.rowsBetween(Window.unboundedPreceding, 0))
    spans = (
        begun.select("*", begin.alias("begin"))
        .groupBy("doc_id", "row", "begin")
        .agg(
            F.max(F.col("start") + F.col("size")).alias("stop"),
            F.count_distinct("start").alias("chunks"),
            F.min_by("source_id", "start").alias("source_id"),
        )
    )
    size = F.col("stop") - F.col("begin")
    return spans.where(size >= settings.least_bytes).select(
        F.col("doc_id").alias(doc_id), "row", F.col("begin").alias("start"), size.alias("size"), "chunks", "source_id"
    )


def without_spans(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` with the spans cut out of the text.

    Bytes that are no whole character at the ends of a span go with it. Documents without a span, and
    null texts, stay as they are. Rows without an id need the spans of ``repeated_places``.
    """
    row = F.col("row") if "row" in spans.columns else F.lit(0).cast("bigint")
    listed = spans.groupBy(F.col(doc_id).alias("_span_id"), row.alias("_span_row")).agg(
        F.array_sort(F.collect_list(F.struct("start", "size"))).alias("_spans")
    )
    names = docs.columns
    own = _row(docs[doc_id], F.coalesce(docs[text].cast("string"), F.lit("")))
    same = docs[doc_id].eqNullSafe(listed["_span_id"]) & (own == listed["_span_row"])
    joined = docs.join(listed, same, "left").select(*[docs[c] for c in names], "_spans")
    schema = docs.schema
    at = names.index(text)

    def cut(value: str | None, parts: list | None) -> str | None:
        if value is None or not parts:
            return value
        raw, kept, last = value.encode(), [], 0
        for part in parts:
            kept.append(raw[last : part["start"]])
            last = max(last, part["start"] + part["size"])
        return b"".join([*kept, raw[last:]]).decode(errors="ignore")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[:-1])
            texts = [cut(t.as_py(), s.as_py()) for t, s in zip(batch.column(at), batch.columns[-1])]
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema)
