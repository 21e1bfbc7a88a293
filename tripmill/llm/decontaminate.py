"""Benchmark decontamination: q-gram lemma filtering in diagonal bands, and banded alignment.

An item of m characters that stands in a document with at most k edits shares at least m + 1 - q (k + 1)
of its q-grams with it, and all of them lie on k + 1 neighbouring diagonals (place in the document minus
place in the item). Hits are counted in bands of diagonals that overlap by k, so one band holds them all.
Bands that reach the bound are aligned inside the band; rows with at most k edits are results.

Short items get shorter q-grams, so that the bound is at least 1 for every item and its edits.

The texts of items travel to the tasks, which index them block by block; documents stay in place and are read
once for all blocks that fit a pass. No index is made by the driver.

A document may also hold an item in parts, as when a line was cut out of it. So pieces of items are looked for
in the same way, each with its own edits: the whole item, its lines, and overlapping windows. The characters
of an item that lie in a found piece, as a share of all its characters, are what a document covers of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import blocks, text_of
from tripmill.llm.toxicity import characters

_SEPARATOR = 0x110000
_SPACE = 0x20
_PRIME = 0x01000193
# Lower case and plain spaces for code points up to here, one to one so that places are kept.
_MAPPED = 0x2100
_HITS = 1 << 21
# Cells of a batch of alignments, and bytes of documents that wait for all blocks of items.
_CELLS = 1 << 22
_WAITING = 32 << 20
_COST = 32


@dataclass(frozen=True)
class Settings:
    # q-grams of long items; parts of items are looked for from so many characters on.
    q: int = 12
    # Edits allowed, as a share of the characters of an item; below 1.
    edits: float = 0.05
    # Items of fewer characters are not looked for.
    shortest: int = 1
    # Characters of pieces that a task indexes in one go.
    block_characters: int = 8_000_000
    # Characters of items that are sent to the tasks for one pass over the documents.
    pass_characters: int = 64_000_000
    # Windows of so many characters begin every so many characters of an item.
    window: int = 48
    step: int = 12
    # A document is contaminated if it covers this share of the characters of an item.
    covered: float = 0.5


def _simple_lower(code: int) -> int:
    c = chr(code)
    return _SPACE if c.isspace() else ord(c.lower()) if len(c.lower()) == 1 else code


_LOWER = np.array([_simple_lower(c) for c in range(_MAPPED)], np.uint32)


def normalise(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case, and one space for each run of white space; the place of each character that is left."""
    low = points < _MAPPED
    codes = np.where(low, _LOWER[np.where(low, points, 0)], points)
    codes = np.where(codes == 0x3000, np.uint32(_SPACE), codes).astype(np.uint32)
    space = codes == _SPACE
    keep = ~(space & np.r_[False, space[:-1]])
    return codes[keep], np.flatnonzero(keep)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of each q-gram, built by joining grams of half the length."""
    if len(codes) < q:
        return np.zeros(0, np.uint32)
    power, length, done = np.uint32(_PRIME), 1, None
    part = codes
    grams: np.ndarray | None = None
    rest = q
    while rest:
        if rest & 1:
            grams = part if grams is None else grams[: len(codes) - done - length + 1] * power + part[done:]
            done = length if done is None else done + length
        rest >>= 1
        if rest:
            part = part[: len(part) - length] * power + part[length:]
            power, length = np.uint32(int(power) ** 2 % 2**32), 2 * length
    return grams[: len(codes) - q + 1]


@dataclass
class Grams:
    """q-grams of the items that share a q, sorted by hash, with their places."""

    q: int
    members: np.ndarray
    codes: list[np.ndarray]

    def __post_init__(self) -> None:
        grams = [_grams(self.codes[i], self.q) for i in self.members]
        hashes = np.concatenate([np.zeros(0, np.uint32), *grams])
        order = np.argsort(hashes, kind="stable")
        self.item = np.repeat(self.members, [len(g) for g in grams])[order]
        self.at = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]])[order]
        self.keys, self.first, self.count = np.unique(hashes[order], return_index=True, return_counts=True)
        # A bit for each hash prefix, so that most places of a document need no search.
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.keys >> 12] = True

    def hits(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in ``codes``, item, place in the item) of equal hashes, a bounded number at a time."""
        grams = _grams(codes, self.q)
        places = np.flatnonzero(self.seen[grams >> 12])
        entry = np.searchsorted(self.keys, grams[places])
        there = self.keys[np.minimum(entry, len(self.keys) - 1)] == grams[places]
        places, entry = places[there], entry[there]
        ends = np.cumsum(self.count[entry])
        begin = 0
        while begin < len(places):
            before = ends[begin - 1] if begin else 0
            last = max(begin + 1, int(np.searchsorted(ends, before + _HITS, "right")))
            many = self.count[entry[begin:last]]
            stop = np.cumsum(many)
            hit = np.repeat(self.first[entry[begin:last]] - stop + many, many) + np.arange(stop[-1])
            yield np.repeat(places[begin:last], many), self.item[hit], self.at[hit]
            begin = last


class Index:
    """A block of items with their edits, bounds and q-grams."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings):
        codes = [normalise(np.frombuffer(t.encode("utf-32-le"), np.uint32))[0] for _, t in items]
        codes = [c[1:] if len(c) and c[0] == _SPACE else c for c in codes]
        codes = [c[:-1] if len(c) and c[-1] == _SPACE else c for c in codes]
        kept = [i for i, c in enumerate(codes) if len(c) >= max(1, settings.shortest)]
        self.ids = [items[i][0] for i in kept]
        self.codes = [codes[i] for i in kept]
        self.lengths = np.array([len(c) for c in self.codes], np.int64)
        self.edits = (settings.edits * self.lengths).astype(np.int64)
        # An item cut into one part more than it may have edits keeps a part whole: q-grams no longer than that.
        q = np.minimum(settings.q, self.lengths // (self.edits + 1))
        self.bound = self.lengths + 1 - q * (self.edits + 1)
        self.stride = np.maximum(16, 2 * self.edits)
        self.grams = [Grams(int(n), np.flatnonzero(q == n), self.codes) for n in np.unique(q)]

    def bands(self, codes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, band) that hold enough hits. ``doc`` numbers the document of each character."""
        none = np.zeros(0, np.int64)
        longest = int(self.lengths.max())
        n_bands = (len(codes) + 2 * longest) // 16 + 2
        found, counts = [none], [none]
        for grams in self.grams:
            for j, item, at in grams.hits(codes):
                diagonal = j - at + longest
                stride = self.stride[item]
                band, lower = diagonal // stride, (diagonal - self.edits[item]) // stride
                key = (doc[j] * len(self.ids) + item) * n_bands
                k, n = np.unique(np.r_[key + band, (key + lower)[lower != band]], return_counts=True)
                found.append(k)
                counts.append(n)
        keys, back = np.unique(np.concatenate(found), return_inverse=True)
        total = np.bincount(back, np.concatenate(counts), len(keys)).astype(np.int64)
        item = keys // n_bands % len(self.ids)
        enough = total >= self.bound[item]
        keys, item = keys[enough], item[enough]
        return keys // n_bands // len(self.ids), item, keys % n_bands

    def batches(self, items: np.ndarray) -> Iterator[np.ndarray]:
        """Rows to align together: of like lengths, so that a long item does not widen the rest, and bounded cells."""
        order = np.argsort(self.lengths[items], kind="stable")
        cells = np.maximum(self.lengths, self.stride + self.edits + 1)[items[order]]
        begin = 0
        while begin < len(order):
            size = np.arange(1, min(256, len(order) - begin) + 1) * cells[begin : begin + 256]
            last = begin + max(1, int(np.searchsorted(size, _CELLS, "right")))
            yield order[begin:last]
            begin = last

    def align(self, codes: np.ndarray, items: np.ndarray, bands: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Best alignment of each item inside its band: rows (edits, first place, place behind the last).

        ``spans`` has the first and the last place of the document of each row. All rows advance together,
        one character of their items at a time; a cell holds edits and the diagonal it began on, so that
        a minimum carries both. Cells outside the document cost too much.
        """
        longest = int(self.lengths.max())
        m, stride, edits = self.lengths[items], self.stride[items], self.edits[items]
        low = bands * stride - longest
        width = int((stride + edits).max()) + 1
        cells = np.arange(width)
        one, lots = 1 << _COST, 1 << 60
        steps = cells * one
        in_band = cells < (stride + edits + 1)[:, None]
        pattern = np.zeros((len(items), int(m.max())), np.uint32)
        for row, i in enumerate(items):
            pattern[row, : m[row]] = self.codes[i]
        row_cost = np.where(in_band, np.broadcast_to(cells, in_band.shape), lots)
        # Before the first character: an alignment begins anywhere between the ends of the document.
        begin = low[:, None] + cells
        row_cost = np.where((begin >= spans[:, :1]) & (begin <= spans[:, 1:]), row_cost, lots)
        best = np.full((len(items), 3), lots)
        for i in range(int(m.max())):
            place = begin + i
            inside = in_band & (place >= spans[:, :1]) & (place < spans[:, 1:])
            same = codes[np.where(inside, place, 0)] == pattern[:, i : i + 1]
            change = np.where(inside, row_cost + np.where(same, 0, one), lots)
            drop = np.full_like(row_cost, lots)
            drop[:, :-1] = row_cost[:, 1:] + one
            # A character of the document only: along the row, as a running minimum; behind it the place may be the end.
            reach = np.minimum(np.minimum(change, drop), lots)
            reach = np.minimum(np.minimum.accumulate(reach - steps, axis=1) + steps, lots)
            row_cost = np.where(in_band & (place + 1 >= spans[:, :1]) & (place + 1 <= spans[:, 1:]), reach, lots)
            for row in np.flatnonzero(m == i + 1):
                cell = int(row_cost[row].argmin())
                value = int(row_cost[row, cell])
                best[row] = value >> _COST, low[row] + (value & (one - 1)), low[row] + cell + i + 1
        return best

    def search(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, edits, start, end) of the best place of each item in each text; places in characters."""
        if not self.ids:
            return
        for first, _, data, offsets in blocks(texts):
            points, ends = characters(data, offsets)
            marked = np.insert(points, ends[1:], np.uint32(_SEPARATOR))
            codes, kept = normalise(marked)
            stops = np.flatnonzero(codes == _SEPARATOR)
            doc = np.repeat(np.arange(len(stops)), np.diff(stops, prepend=-1))
            docs, items, bands = self.bands(codes, doc)
            if not len(docs):
                continue
            starts = np.r_[0, stops[:-1] + 1]
            for part in self.batches(items):
                spans = np.c_[starts[docs[part]], stops[docs[part]]]
                best = self.align(codes, items[part], bands[part], spans)
                for d, i, (cost, a, b) in zip(docs[part], items[part], best):
                    if cost <= self.edits[i]:
                        # Back to places in the text as it is: without the texts and separators before it.
                        base = int(ends[d]) + int(d)
                        yield first + int(d), int(i), int(cost), int(kept[a]) - base, int(kept[b - 1]) + 1 - base


class Pieces:
    """Items of a block with an index of their pieces. Equal pieces are looked for once."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings):
        self.least = settings.covered
        self.ids = [i for i, _ in items]
        self.lengths: list[int] = []
        self.owners: dict[str, list[tuple[int, int, int]]] = {}
        for n, (_, text) in enumerate(items):
            self._add(n, text, settings)
        self.texts = list(self.owners)
        self.index = Index(list(enumerate(self.texts)), settings)

    def _add(self, item: int, text: str, settings: Settings) -> None:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        codes, kept = normalise(points)
        plain = codes.tobytes().decode("utf-32-le")
        left, right = len(plain) - len(plain.lstrip(" ")), len(plain.rstrip(" "))
        self.lengths.append(right - left)
        feeds = np.searchsorted(kept, np.flatnonzero(points == ord("\n"))).tolist()
        ranges = [(left, right), *zip([left, *feeds], [*feeds, right])]
        last = right - settings.window
        ranges += [(a, a + settings.window) for a in (*range(left, last, settings.step), last) if a >= left]
        for a, b in ranges:
            piece = plain[a:b]
            a, b = a + len(piece) - len(piece.lstrip(" ")), b - (len(piece) - len(piece.rstrip(" ")))
            least = 1 if b - a == right - left else settings.q
            if b - a >= least and (item, a - left, b - left) not in (owners := self.owners.setdefault(plain[a:b], [])):
                owners.append((item, a - left, b - left))

    def search(self, texts: pa.Array) -> Iterator[tuple[int, int, float, tuple[int, int, int] | None]]:
        """(row, item, covered share, best place of the whole item or None) where enough of an item is covered."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for row, piece, *match in self.index.search(texts):
            best[row, piece] = min(tuple(match), best.get((row, piece), tuple(match)))
        ranges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        whole: dict[tuple[int, int], tuple[int, int, int]] = {}
        for (row, piece), match in best.items():
            for item, a, b in self.owners[self.texts[self.index.ids[piece]]]:
                ranges.setdefault((row, item), []).append((a, b))
                if b - a == self.lengths[item]:
                    whole[row, item] = match
        for (row, item), found in sorted(ranges.items()):
            covered = reached = 0
            for a, b in sorted(found):
                covered += max(0, b - max(a, reached))
                reached = max(reached, b)
            if covered >= self.least * self.lengths[item]:
                yield row, item, covered / self.lengths[item], whole.get((row, item))


def _passes(
    items: DataFrame, item_id: str, text: str, settings: Settings, weight: int = 1
) -> Iterator[list[list[tuple[int, str]]]]:
    """The items of each pass over the documents, cut into blocks. A row is in a pass by its hash, so a pass is near its
    size. The characters of a block count ``weight`` times; an item that is longer than a block stands alone."""
    rows = items.select(F.col(item_id).alias("_id"), text_of(text).alias("_text")).where(F.length("_text") > 0)
    total = rows.agg(F.sum(F.length("_text"))).first()[0] or 0
    parts = -(-total // settings.pass_characters)
    for part in range(parts):
        mine = rows.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(parts)) == part)
        cut: list[list[tuple[int, str]]] = []
        room = 0
        for r in mine.toLocalIterator():
            size = weight * len(r["_text"])
            if not cut or size > room:
                cut.append([])
                room = settings.block_characters
            cut[-1].append((r["_id"], r["_text"]))
            room -= size
        if cut:
            yield cut


def _piece_weight(settings: Settings) -> int:
    # A character is in the whole item, in a line, and in the windows that overlap there.
    return 2 + -(-settings.window // settings.step)


def _waiting(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches joined to larger ones, so that a block of items is indexed seldom."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= _WAITING:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _matched(
    batches: Iterator[pa.RecordBatch], column: int, cut: list[list[tuple[int, str]]], kind: type, settings: Settings
) -> Iterator[tuple[pa.RecordBatch, Iterator["Index | Pieces"]]]:
    """Each batch with the indexes to look into. One block is indexed once for a task; of several, one at a time is held."""
    if len(cut) == 1:
        index = kind(cut[0], settings)
        for batch in batches:
            yield batch, iter([index])
    else:
        for batch in _waiting(batches, column):
            yield batch, (kind(block, settings) for block in cut)


def find(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Items that stand in documents, whole, up to the share of edits: one row per document and item.

    Columns: the ids, ``edits``, and the first place ``start`` and the place behind the last ``end``, in
    characters of the text; of several places the one with the fewest edits, then the first. Case and runs
    of white space make no difference. Null, empty and blank texts and items have no match, nor have items of fewer
    than ``Settings.shortest`` characters. Repeated rows of documents give repeated rows; rows of items that repeat an id are
    told apart by text. Other columns are not read.
    """
    source = docs.select(docs[doc_id].alias(doc_id), text_of(text).alias("_text"))
    item_field = items.schema[item_id]
    numbers = [T.StructField(n, T.LongType()) for n in ("edits", "start", "end")]
    schema = T.StructType([source.schema[doc_id], T.StructField(item_id, item_field.dataType), *numbers])
    result = docs.sparkSession.createDataFrame([], schema)
    for cut in _passes(items, item_id, text, settings):

        def run(batches: Iterator[pa.RecordBatch], cut: list = cut) -> Iterator[pa.RecordBatch]:
            for batch, indexes in _matched(batches, 1, cut, Index, settings):
                for index in indexes:
                    best: dict[tuple[int, int], tuple[int, int, int]] = {}
                    for row, item, *match in index.search(batch.column(1)):
                        best[row, item] = min(tuple(match), best.get((row, item), tuple(match)))
                    rows = sorted(best)
                    columns = [batch.column(0).take(pa.array([r for r, _ in rows], pa.int64()))]
                    columns.append(pa.array([index.ids[i] for _, i in rows]).cast(_arrow(item_field.dataType)))
                    columns += [pa.array([best[r][n] for r in rows], pa.int64()) for n in range(3)]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

        result = result.union(source.mapInArrow(run, schema))
    return result


def cover(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Items that documents hold whole or in parts: one row per document and item of which enough is covered.

    The columns of ``find`` and ``covered``, the share of the characters of the item, white space runs as one,
    that lie in a piece which stands in the document, anywhere, up to the share of edits of the piece. Rows
    have at least ``Settings.covered``; ``edits``, ``start`` and ``end`` are null unless the whole item stands
    there, which covers all of it. A rest of a line that is shorter than a window is not seen, and up to
    ``Settings.step`` characters at the ends of a longer one, nor a line of fewer than q characters alone. Null, short and repeated rows are as in ``find``.
    """
    source = docs.select(docs[doc_id].alias(doc_id), text_of(text).alias("_text"))
    item_field = items.schema[item_id]
    numbers = [T.StructField(n, T.LongType()) for n in ("edits", "start", "end")]
    share = T.StructField("covered", T.DoubleType())
    schema = T.StructType([source.schema[doc_id], T.StructField(item_id, item_field.dataType), *numbers, share])
    result = docs.sparkSession.createDataFrame([], schema)
    for cut in _passes(items, item_id, text, settings, _piece_weight(settings)):

        def run(batches: Iterator[pa.RecordBatch], cut: list = cut) -> Iterator[pa.RecordBatch]:
            for batch, indexes in _matched(batches, 1, cut, Pieces, settings):
                for pieces in indexes:
                    rows = list(pieces.search(batch.column(1)))
                    columns = [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))]
                    columns.append(pa.array([pieces.ids[r[1]] for r in rows]).cast(_arrow(item_field.dataType)))
                    columns += [pa.array([r[3] and r[3][n] for r in rows], pa.int64()) for n in range(3)]
                    columns.append(pa.array([r[2] for r in rows], pa.float64()))
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

        result = result.union(source.mapInArrow(run, schema))
    return result


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The rows of ``docs`` that ``cover`` has no row for, with the columns of ``docs``; nothing is shuffled."""
    schema = docs.schema
    at = docs.columns.index(text)
    for cut in _passes(items, item_id, text, settings, _piece_weight(settings)):

        def run(batches: Iterator[pa.RecordBatch], cut: list = cut) -> Iterator[pa.RecordBatch]:
            for batch, indexes in _matched(batches, at, cut, Pieces, settings):
                clean = np.ones(batch.num_rows, bool)
                for pieces in indexes:
                    clean[[row for row, *_ in pieces.search(batch.column(at))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, schema)
    return docs
