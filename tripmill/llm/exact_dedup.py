"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Fingerprints of all rows are written, and few bytes of them are read by each sender, which sorts its own and sends each
   owner (a range of fingerprints) the distinct ones as Golomb-coded differences.
2. Owners merge what they receive and answer each sender with a bitmap: which of its sorted fingerprints
   another sender has too. A sender knows by itself which fingerprints it has twice.
3. Rows whose bit is set are suspects. Only their texts are shuffled and grouped as whole bytes, with
   partial grouping on each task, so a large group of copies arrives as one row from each task.

Rows, ranks and messages of a sender are written together before owners read them, so a lost executor
cannot lead to bitmaps that belong to another order. What a sender and an owner hold grows with the root of
the rows, so the number of messages, one from each sender to each owner, grows with the rows and not their square.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import checkpointed, text_of


@dataclass(frozen=True)
class Settings:
    # Fingerprint bits: false suspects cost a byte comparison, so some bits above log2(rows) are enough.
    bits: int = 48
    # Rows of a sender and fingerprints of an owner, for so many rows in all that ``root`` times the root of
    # their number is less; beyond, both are ``root`` times that root.
    sender_rows: int = 50_000
    owner_rows: int = 1_000_000
    root: int = 20

    def sender_size(self, rows: int) -> int:
        return max(self.sender_rows, self.root * math.isqrt(rows))

    def owners(self, rows: int) -> int:
        return max(4, -(-rows // max(self.owner_rows, self.root * math.isqrt(rows))))


def golomb_encode(values: np.ndarray, span: int) -> tuple[int, bytes]:
    """Sorted distinct values below ``span`` as Rice-coded differences (Golomb codes for powers of two).

    Returns the parameter and the code: first all quotients in unary, then all remainders.
    """
    shift = max(0, int(span // max(1, len(values))).bit_length() - 1)
    gaps = np.diff(values, prepend=np.int64(-1)) - 1
    quotients = gaps >> shift
    unary = np.ones(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    rest = (gaps[:, None] >> np.arange(shift)) & 1
    return shift, np.packbits(np.r_[unary, rest.astype(np.uint8).ravel()]).tobytes()


def golomb_decode(code: bytes, count: int, shift: int) -> np.ndarray:
    if not count:
        return np.zeros(0, np.int64)
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    stops = np.flatnonzero(bits == 0)[:count]
    quotients = np.diff(stops, prepend=-1) - 1
    begin = int(stops[-1]) + 1
    rest = bits[begin : begin + count * shift].reshape(count, shift).astype(np.int64)
    gaps = (quotients << shift) + (rest << np.arange(shift)).sum(1)
    return np.cumsum(gaps + 1) - 1


_SENT = [("doc_id", None), ("fp", pa.int64()), ("digest", pa.binary(32)), ("sender", pa.int64()), ("owner", pa.int64())]
_SENT += [("rank", pa.int64()), ("twice", pa.bool_()), ("count", pa.int64()), ("shift", pa.int64()), ("code", pa.binary())]


def _send(hashed: DataFrame, rows: int, settings: Settings) -> DataFrame:
    """Rows with their rank, and messages (rank null) to owners.

    Written fingerprints lie in as many parts as the texts did. Parts are put together, without a shuffle,
    until a task has about as many rows as a sender should.
    """
    most, owners = settings.sender_size(rows), settings.owners(rows)
    tasks = max(hashed.sparkSession.sparkContext.defaultParallelism, -(-rows // most))
    span = (1 << settings.bits) // owners
    id_field = hashed.schema["doc_id"]
    long, binary = T.LongType(), T.BinaryType()
    kinds = [id_field.dataType, long, binary, long, long, long, T.BooleanType(), long, long, binary]
    schema = T.StructType([T.StructField(n, k) for (n, _), k in zip(_SENT, kinds)])

    def table(id_type: pa.DataType, columns: dict) -> pa.RecordBatch:
        size = len(columns["owner"])
        arrays = [
            pa.array(columns[name], kind or id_type) if name in columns else pa.nulls(size, kind or id_type)
            for name, kind in _SENT
        ]
        arrays[2] = arrays[2].cast(pa.binary())
        return pa.RecordBatch.from_arrays(arrays, [name for name, _ in _SENT])

    def flush(part: pa.Table, sender: int) -> Iterator[pa.RecordBatch]:
        fp = part.column("fp").to_numpy()
        order = np.argsort(fp, kind="stable")
        values, at, counts = np.unique(fp[order], return_inverse=True, return_counts=True)
        owner = values // span
        starts = np.searchsorted(owner, owner)
        columns = {"sender": np.full(len(fp), sender), "owner": owner[at], "rank": (np.arange(len(values)) - starts)[at]}
        columns |= {"fp": values[at], "twice": counts[at] > 1}
        sorted_part = part.take(pa.array(order))
        id_type = part.column("doc_id").type
        for name in ("doc_id", "digest"):
            columns[name] = sorted_part.column(name).combine_chunks()
        for begin in range(0, len(fp), 10_000):
            yield table(id_type, {k: v[begin : begin + 10_000] for k, v in columns.items()})
        for one in np.unique(owner):
            mine = values[owner == one] - one * span
            shift, code = golomb_encode(mine, span)
            message = {"sender": [sender], "owner": [one], "count": [len(mine)], "shift": [shift], "code": [code]}
            yield table(id_type, message)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows, sender = [], 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield from flush(pa.Table.from_batches(waiting), sender)
                waiting, rows, sender = [], 0, sender + 1
        if rows:
            yield from flush(pa.Table.from_batches(waiting), sender)

    return hashed.coalesce(tasks).mapInArrow(run, schema)


def _answers(messages: DataFrame) -> DataFrame:
    """Owners: for each sender a bitmap of the fingerprints that another sender has as well."""

    def own(received: pd.DataFrame) -> pd.DataFrame:
        lists = [golomb_decode(*x) for x in zip(received["code"], received["count"], received["shift"])]
        values, counts = np.unique(np.concatenate(lists), return_counts=True)
        several = values[counts > 1]
        bitmaps = [np.packbits(np.isin(x, several, assume_unique=True)).tobytes() for x in lists]
        return pd.DataFrame({"sender": received["sender"], "owner": received["owner"], "bitmap": bitmaps})

    return messages.groupBy("owner").applyInPandas(own, "sender long, owner long, bitmap binary")


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept`` and ``digest`` (SHA-256, binary).

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the largest id
    stays; a null id stays only where the group has no other. Rows that repeat an id with the same text
    count in ``group_size`` and share the verdict. An empty table gives no rows.
    """
    texts = docs.select(docs[doc_id].alias("doc_id"), text_of(text).alias("body"))
    digest = F.unhex(F.sha2("body", 256))
    mask = (1 << settings.bits) - 1
    hashed = texts.select("doc_id", F.xxhash64("body").bitwiseAND(mask).alias("fp"), digest.alias("digest"))
    rows = docs.select(F.lit(1)).count()
    sent = checkpointed(_send(checkpointed(hashed), rows, settings))
    messages = sent.where("rank is null").select("sender", "owner", "count", "shift", "code")
    answers = _answers(messages)
    ranked = sent.where("rank is not null")
    byte = F.conv(F.hex(F.substring("bitmap", (F.col("rank") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.shiftright(byte, 7).bitwiseAND(1)
    for i in range(1, 8):
        bit = F.when(F.col("rank") % 8 == i, F.shiftright(byte, 7 - i).bitwiseAND(1)).otherwise(bit)
    judged = ranked.join(answers, ["sender", "owner"], "left").select(
        "doc_id", "digest", (F.col("twice") | (bit == 1)).alias("suspect")
    )
    judged = checkpointed(judged)
    # Suspects' texts, compared as whole values: grouping by the text itself is the byte verification.
    wanted = judged.where("suspect").select(F.col("doc_id").alias("_id")).distinct()
    suspects = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    groups = (
        suspects.groupBy("body")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(digest.alias("digest"), "keep_id", "group_size")
    )
    found = judged.join(groups, "digest", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("doc_id").alias(doc_id),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "digest",
    )
