"""Byte-pair encoding and decoding with word ends, in batched numpy merge rounds.

The symbols of many words stand in one flat array. In each round every neighbouring pair of a word is
looked up by binary search among the sorted pair keys, the lowest rank of each word is merged at all its
places, and words without a known pair leave the array. Each distinct word is merged once per task and
cached, within a bound.

Text is prepared as the vocabulary file asks: special tokens are found first, the rest is NFC-normalised,
lower-cased and split into words. For texts below U+0300 these steps are plain string operations, as no
character there has another normal form; the file's own normaliser and splitter serve all other texts.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import text_of

# Distinct words that a task remembers, and bytes of new words merged at once.
CACHED_WORDS = 400_000
BATCH_BYTES = 1 << 20

_WIDE = regex.compile(r"[^\x00-˿]")
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+")


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class WordBpe:
    """A vocabulary file of the kind "BPE with word ends", read on each executor."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.path = path
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in self.symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in self.symbols], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        # A rank whose symbol takes part in an earlier merge can open a lower rank: merge one place a round.
        used = np.full(len(self.tokens), len(pairs), np.int64)
        np.minimum.at(used, left, np.arange(len(pairs)))
        np.minimum.at(used, right, np.arange(len(pairs)))
        self.single = used[self.made] < np.arange(len(pairs))
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._library = None
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts, self.lengths, self.pool = (np.zeros(1024, np.int64) for _ in range(3))
        self.used = 0

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each word has. No word is empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[data[ends]]
        owner = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = len(self.ranks)
        while len(symbols):
            pair = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.full(len(symbols), none, np.int64)
            rank[:-1] = np.where((self.keys[at] == pair) & (owner[:-1] == owner[1:]), self.ranks[at], none)
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, begins)
            each = np.repeat(best, np.diff(np.r_[begins, len(owner)]))
            finished = each == none
            if finished.any():
                done.append((owner[finished], symbols[finished]))
                keep = ~finished
                symbols, owner, rank, each = symbols[keep], owner[keep], rank[keep], each[keep]
                if not len(symbols):
                    break
            places = np.flatnonzero(rank == each)
            # Equal neighbours overlap: of a run of places, every second one is merged.
            new_run = np.r_[True, np.diff(places) != 1]
            offset = np.arange(len(places)) - np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
            first = np.r_[True, owner[places][1:] != owner[places][:-1]]
            places = places[(offset % 2 == 0) & (first | ~self.single[rank[places]])]
            symbols[places] = self.made[rank[places]]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        owners = np.concatenate([o for o, _ in done]) if done else np.zeros(0, np.int64)
        ids = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(owners, kind="stable")
        return ids[order], np.bincount(owners, minlength=len(words))

    def learn(self, words: Iterable[str]) -> None:
        """Merge the words that are not cached yet."""
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        while new:
            size, count = 0, 0
            while count < len(new) and (not count or size < BATCH_BYTES):
                size += len(new[count])
                count += 1
            batch, new = new[:count], new[count:]
            ids, lengths = self.merge([w.encode() for w in batch])
            known, used = len(self.index), self.used
            self.starts = _room(self.starts, known, count)
            self.lengths = _room(self.lengths, known, count)
            self.pool = _room(self.pool, used, len(ids))
            self.starts[known : known + count] = used + np.cumsum(lengths) - lengths
            self.lengths[known : known + count] = lengths
            self.pool[used : used + len(ids)] = ids
            self.used += len(ids)
            self.index.update(zip(batch, range(known, known + count)))

    def words(self, text: str) -> list[str]:
        if not _WIDE.search(text):
            return _WORD.findall(text.lower())
        if self._library is None:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(self.path)
            self._library = library.normalizer, library.pre_tokenizer
            self._byte = {s: b for b, s in enumerate(self.symbols)}
        normalizer, splitter = self._library
        pieces = splitter.pre_tokenize_str(normalizer.normalize_str(text))
        return [bytes(map(self._byte.__getitem__, piece)).decode() for piece, _ in pieces]

    def pieces(self, text: str) -> list[str]:
        """Words of a text in order; a special token is a piece of its own, marked by a space before it."""
        pieces, begin = [], 0
        for found in self.split.finditer(text):
            pieces += [*self.words(text[begin : found.start()]), f" {found[0]}"]
            begin = found.end()
        return pieces + self.words(text[begin:]) if begin else self.words(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has. New words of all texts are merged together."""
        if len(self.index) > CACHED_WORDS:
            self.clear()
        if not self.index:
            for token, i in self.special.items():
                known = len(self.index)
                self.starts[known], self.lengths[known], self.pool[self.used] = self.used, 1, i
                self.index[f" {token}"] = known
                self.used += 1
        pieces = [self.pieces(text) for text in texts]
        self.learn(chain.from_iterable(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(pieces)), np.int64, sizes.sum())
        counts = self.lengths[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(self.starts[at] - ends + counts, counts) + np.arange(total)]
        before = np.r_[0, ends][np.r_[0, np.cumsum(sizes)]]
        return ids.astype(np.int32), np.diff(before)

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder, so tokens are joined by one space."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array itself or, where ``more`` entries don't fit behind ``used``, a copy of at least twice its size."""
    if used + more <= len(array):
        return array
    larger = np.zeros(max(2 * len(array), used + more), array.dtype)
    larger[:used] = array[:used]
    return larger


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows whose texts have about BATCH_BYTES together, so that ids and decoded texts stay small."""
    begin = size = 0
    texts: list[str] = []
    for i, value in enumerate(batch.column(column)):
        texts.append(value.as_py())
        size += len(texts[-1])
        if size >= BATCH_BYTES or i + 1 == batch.num_rows:
            yield batch.slice(begin, len(texts)), texts
            begin, size, texts = i + 1, 0, []


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", decoded: bool = True) -> DataFrame:
    """Encode whole texts: the id column, ``ids`` array<int> and, if asked for, ``decoded`` text.

    One row per input row, in place: nothing is shuffled. Null and empty texts and white space give no ids
    and an empty decoded text. Repeated rows are encoded each. Other columns are not read.
    """
    source = docs.select(docs[doc_id].alias(doc_id), text_of(text).alias("_text"))
    fields = [source.schema[doc_id], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("decoded", T.StringType())] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            for part, texts in _slices(batch, 1):
                ids, counts = model.encode(texts)
                offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
                columns = [part.column(0), pa.ListArray.from_arrays(offsets, ids)]
                if decoded:
                    listed, ends = ids.tolist(), offsets.tolist()
                    columns.append(pa.array([model.decode(listed[a:b]) for a, b in zip(ends, ends[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])
        # The worker may live on with other work.
        model.clear()

    return source.mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Decode id arrays: the id column and ``decoded``; a null array decodes to an empty text."""
    source = encoded.select(encoded[doc_id].alias(doc_id), encoded[ids].cast("array<int>").alias("_ids"))
    fields = [source.schema[doc_id], T.StructField("decoded", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            texts = [model.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields))


def public_vocabulary() -> str:
    """Where the installed vocabulary "word_bpe_49k" is; it has to be in the same place on all executors."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, number of tokens, SHA-256 of the ids and of the decoded text."""
    return encode(docs, path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
