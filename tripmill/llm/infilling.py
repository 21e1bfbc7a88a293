"""Fill-in-the-middle rows as a pipeline of pyarrow.compute calls over batches of texts.

A text is cut into units: runs of ASCII letters, and all other characters one by one. Two drawn numbers say after
how many units the prefix and the middle end. For each batch the units become list arrays; flattened, each unit
knows its parent and its place in it, the place decides its role (prefix, middle or suffix), and the units of a
role are put into lists again and joined to one text each. What is drawn follows from the document's id alone.

Texts beyond a block are cut into pieces between units, so memory follows the size of a block and of the longest
output, not the number of units of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import BLOCK_BYTES, text_of, utf8

# Marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# A unit in UTF-8, byte by byte: letters, or one character of up to four bytes.
_UNIT = r"([A-Za-z]+|[\x00-@\[-`{-\x7f]|[\xc0-\xff][\x80-\xbf]*)"
# A byte that no text in UTF-8 has parts the units.
_GAP = b"\xff"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass(frozen=True)
class Settings:
    # Of 100 texts so many are rewritten, and of 100 rewritten ones so many have the suffix first.
    rewritten: int = 90
    suffix_first: int = 20
    block_bytes: int = BLOCK_BYTES


def draws(doc_id: str | Column) -> Column:
    """Four numbers of 32 bits from the SHA-256 of ``1:`` and the id; a null id is drawn for as an empty one."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(column.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)])


def _pieces(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and starts of pieces: one a text, more where a text is longer than ``size``; cut before a non-letter."""
    rows, starts = [], []
    for row, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        rows.append(row)
        starts.append(begin)
        while end - begin > size:
            at = begin + size
            # Forward to a byte that begins a character and is no letter.
            while at < end:
                window = data[at : at + 4096]
                fit = np.flatnonzero(~_LETTER[window] & ((window & 0xC0) != 0x80))
                at += int(fit[0]) if len(fit) else len(window)
                if len(fit):
                    break
            if at >= end:
                break
            rows.append(row)
            starts.append(at)
            begin = at
    return np.array(rows, np.int64), np.array(starts, np.int64)


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds - bounds[0])), pa.py_buffer(data[bounds[0] : bounds[-1]])]
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers)


def _lists(values: pa.Array, parents: np.ndarray, rows: int) -> pa.Array:
    """Sorted parents and their values as one list for each of so many rows."""
    offsets = np.searchsorted(parents, np.arange(rows + 1)).astype(np.int64)
    return pa.LargeListArray.from_arrays(pa.array(offsets), values)


def _joined(values: pa.Array, parents: np.ndarray, rows: int) -> pa.Array:
    return pc.binary_join(_lists(values, parents, rows), pa.scalar(b"", pa.large_binary()))


def _parts(pieces: pa.Array, base: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each piece, whose first unit is number ``base`` of its text."""
    marked = pc.replace_substring_regex(pieces, pattern=_UNIT, replacement=b"\\1" + _GAP)
    units = pc.split_pattern(marked, pattern=_GAP)
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units).to_numpy()
    begins = units.offsets.to_numpy()
    place = np.arange(len(flat)) - begins[parent] + base[parent]
    # Behind the last mark of a piece stands an empty unit, which joins as nothing in any part.
    roles = (place >= low[parent]).astype(np.int8) + (place >= high[parent])
    found = []
    for role in range(3):
        mine = roles == role
        found.append(_joined(flat.filter(pa.array(mine)), parent[mine], len(pieces)))
    return found


def _cut(texts: pa.Array, h1: np.ndarray, h2: np.ndarray, size: int) -> tuple[np.ndarray, list[pa.Array]]:
    """Numbers of units, and prefix, middle and suffix of all texts."""
    data, offsets = utf8(texts)
    rows, starts = _pieces(data, offsets, size)
    bounds = np.r_[starts, len(data)].astype(np.int64)
    pieces = _binary(data, bounds)
    counts = pc.count_substring_regex(pieces, pattern=_UNIT).to_numpy().astype(np.int64)
    before = np.cumsum(counts) - counts
    first = np.searchsorted(rows, np.arange(len(texts)))
    n = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
    ends = [np.sort([h1 % (n + 1), h2 % (n + 1)], axis=0)[i] for i in range(2)]
    base = before - before[first][rows]
    done: list[list[pa.Array]] = [[], [], []]
    at = 0
    while at < len(pieces):
        last = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        last = min(last, len(pieces))
        part = slice(at, last)
        for role, found in enumerate(_parts(pieces[part], base[part], ends[0][rows[part]], ends[1][rows[part]])):
            done[role].append(found)
        at = last
    empty = pa.array([], pa.large_binary())
    return n, [_joined(pa.concat_arrays(x) if x else empty, rows, len(texts)) for x in done]


def _rewrite(batch: pa.RecordBatch, settings: Settings) -> pa.RecordBatch:
    texts = batch.column("_text")
    h = batch.column("_draws").flatten().to_numpy().reshape(-1, 4)
    n, parts = _cut(texts, h[:, 0], h[:, 1], settings.block_bytes)
    whole = texts.cast(pa.large_string())
    plain = (n == 0) | (h[:, 2] % 100 >= settings.rewritten)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain |= pc.match_substring(whole, mark).to_numpy(zero_copy_only=False)
    suffix_first = h[:, 3] % 100 < settings.suffix_first
    prefix, middle, suffix = (x.cast(pa.large_string()) for x in parts)
    marks = [pa.scalar(x, pa.large_string()) for x in (PREFIX, SUFFIX, MIDDLE)]
    nothing = pa.scalar("", pa.large_string())
    psm = pc.binary_join_element_wise(marks[0], prefix, marks[1], suffix, marks[2], middle, nothing)
    spm = pc.binary_join_element_wise(marks[1], suffix, marks[0], prefix, marks[2], middle, nothing)
    form = np.where(plain, "plain", np.where(suffix_first, "spm", "psm"))
    output = pc.if_else(pa.array(plain), whole, pc.if_else(pa.array(suffix_first), spm, psm))
    sizes = [pc.if_else(pa.array(plain), pa.scalar(None, pa.int64()), pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    columns = {
        "n": pa.array(n, pa.int64()),
        "form": pa.array(form, pa.string()),
        "prefix_chars": sizes[0],
        "middle_chars": sizes[1],
        "output": output.cast(pa.string()),
    }
    return pa.RecordBatch.from_arrays([batch.column("_id"), *columns.values()], ["_id", *columns])


def rewrite(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row: id, ``n`` units, ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars``, ``output``.

    psm is prefix, suffix, middle behind their marks; spm has the suffix first; plain is the text as it is, with
    null sizes. Texts that are empty, null or hold a mark are plain. Rows that repeat an id are cut by the same
    numbers, each by its own text. An empty table gives no rows; further columns are not read.
    """
    chosen = docs.select(docs[doc_id].alias("_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"), draws(docs[doc_id]).alias("_draws"))
    kinds = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType())]
    kinds += [("middle_chars", T.LongType()), ("output", T.StringType())]
    schema = T.StructType([T.StructField("_id", docs.schema[doc_id].dataType), *[T.StructField(a, b) for a, b in kinds]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = utf8(batch.column("_text"))
            begin = 0
            # Small parts of a batch, so that text, parts and outputs of few rows stand side by side.
            while begin < batch.num_rows:
                end = int(np.searchsorted(offsets, offsets[begin] + 4 * settings.block_bytes, "right")) - 1
                end = min(max(begin + 1, end), batch.num_rows)
                yield _rewrite(batch.slice(begin, end - begin), settings)
                begin = end

    return chosen.mapInArrow(run, schema).withColumnRenamed("_id", doc_id)


def restore(output: str = "output", form: str = "form") -> Column:
    """The text that ``rewrite`` was given, from output and form. No text with a mark in it is rewritten, so the
    marks of an output are its own three."""
    parts = F.split(F.col(output), "<[PSM]>", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
