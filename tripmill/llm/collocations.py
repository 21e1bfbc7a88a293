"""The best collocations of each language, by best-first growth of phrases with bounds from their prefixes.

Texts are cut into pieces and words; a phrase is a run of words within a piece. A phrase with count a, cut into
a beginning with count l and a rest with count r, scores scale * a / (l + r) rounded down; its worst cut counts.

Growth. All frequent words are grown to pairs. From then on a phrase is grown by a word only where that can matter:
every longer phrase that begins with p has a <= f(p), and its rest behind the first word w counts at least a,
so it scores at most scale * f(p) / (f(w) + f(p)). That bound falls with each word, as counts of prefixes do.
For each language the best scores that are known so far give a threshold; phrases whose bound is below it are never
grown. Each length is grown in two blocks: first the bounds that reach the scores known so far, settled or not; what
this settles raises the threshold, and only bounds between the two are left for the second block.

A phrase falls if a longer one that contains it is nearly as frequent. As counts fall with length, it is enough to
look at phrases one word longer: those that begin or end with it are counted before it counts as settled. Phrases
none of whose words has a frequent enough neighbour are settled at once.

One round of growth is one pass over the texts, in which a task counts windows of words and sends its sums. What may
grow is told by Bloom filters, sized by their keys up to a limit; false positives cost rows and change nothing,
as all counts are of whole phrases. Only the filters' bits pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import checkpointed, text_of, utf8

# What parts words and what parts pieces.
_BLANK, _STOP = b" \t", b".,;:!?\n\x0b\x0c\r"
# Tables for bytes.translate: A-Z to lower case; 0 for a byte of a word, 1 for a blank, 2 for what ends a piece.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KIND = bytes(1 if b in _BLANK else 2 if b in _STOP else 0 for b in range(256))


@dataclass(frozen=True)
class Settings:
    # At most 4: the rests that longer phrases need are not looked ahead for.
    longest: int = 4
    least: int = 30
    best: int = 2000
    # A phrase falls if a longer one has at least so many hundredths of its count.
    covered: int = 80
    scale: int = 2_000_000
    # Thresholds are kept in steps of so much score; they are rounded down, which only grows a little more.
    step: int = 100
    block_bytes: int = 2 << 20
    # A filter has 16 bits a key, but at most 2 ** so many.
    filter_log_bits: int = 26
    # Parts of a language that are ranked side by side before the last ranking.
    salts: int = 16


# Words of texts ----------------------------------------------------------------------------------------------


@dataclass
class _Words:
    """Words of a block of texts in order: number in the dictionary, piece, language, and hashes of both."""

    ids: np.ndarray
    pieces: np.ndarray
    langs: np.ndarray
    dictionary: pa.Array
    lang_names: pa.Array
    word_hashes: np.ndarray
    lang_hashes: np.ndarray

    def starts(self, size: int) -> np.ndarray:
        """Where a window of so many words lies within one piece."""
        last = len(self.ids) - size + 1
        return np.flatnonzero(self.pieces[: max(last, 0)] == self.pieces[size - 1 :])

    def keys(self, at: np.ndarray, size: int) -> np.ndarray:
        return key_of(self.lang_hashes[self.langs[at]], *[self.word_hashes[self.ids[at + j]] for j in range(size)])

    def counted(self, at: np.ndarray, size: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Language, phrase and count of the distinct windows at the given places."""
        code, words = self.langs[at].astype(np.int64), len(self.dictionary)
        for j in range(size):
            if j:
                code = np.unique(code, return_inverse=True)[1]
            code = code * words + self.ids[at + j]
        _, first, counts = np.unique(code, return_index=True, return_counts=True)
        first = at[first]
        parts = [self.dictionary.take(pa.array(self.ids[first + j])) for j in range(size)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
        return self.lang_names.take(pa.array(self.langs[first])), _text(phrase), counts

    def counted_words(self) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """``counted`` for single words, without a sort."""
        words = len(self.dictionary)
        counts = np.bincount(self.langs.astype(np.int64) * words + self.ids)
        code = np.flatnonzero(counts)
        lang, word = np.divmod(code, words)
        return self.lang_names.take(pa.array(lang)), _text(self.dictionary.take(pa.array(word))), counts[code]


def _text(values: pa.Array) -> pa.Array:
    return values.cast(pa.large_string()).cast(pa.string())


def key_of(lang: np.ndarray, *words: np.ndarray) -> np.ndarray:
    """64 bits of a language and a phrase from the hashes of both."""
    key = lang.astype(np.uint64)
    for word in words:
        key = (key ^ word) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(32))


# An odd base of polynomials, and its inverse.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# Values are hashed in runs of about so many bytes, which bounds the tables of powers.
_HASHED = 1 << 20
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, size: int) -> np.ndarray:
    if len(_powers.get(base, ())) < size:
        values = np.full(max(size, 1 << 16), base, np.uint64)
        values[0] = 1
        _powers[base] = np.cumprod(values)
    return _powers[base]


def _hashes(values: pa.Array, seed: int) -> np.ndarray:
    """A hash of each value's bytes: the value of a polynomial at its place, moved back to the start."""
    data, offsets = utf8(values) if not pa.types.is_large_binary(values.type) else utf8(values.view(pa.large_string()))
    found = np.zeros(len(values), np.uint64)
    begin = 0
    while begin < len(values):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + _HASHED, "right")) - 1)
        part, at = data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        sums = np.r_[np.uint64(0), np.cumsum((part + np.uint64(1 + seed)) * _powers_of(_BASE, len(part))[: len(part)])]
        back = _powers_of(_INVERSE, len(part) + 1)[at[:-1]]
        found[begin:end] = (sums[at[1:]] - sums[at[:-1]]) * back
        begin = end
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(32))


def _kinds(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(_KIND), np.uint8)


def _blocks(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``size`` that end where a text or a piece does, so a long text is many ranges."""
    begin = 0
    while begin < len(data):
        end = begin + size
        if end < len(data):
            text_end = int(offsets[np.searchsorted(offsets, end)])
            while end < text_end:
                stop = np.flatnonzero(_kinds(data[end : min(end + 4096, text_end)]) == 2)
                if len(stop):
                    end += int(stop[0])
                    break
                end = min(end + 4096, text_end)
        yield begin, min(end, len(data))
        begin = min(end, len(data))


def _words(batch: pa.RecordBatch, size: int) -> Iterator[_Words]:
    data, offsets = utf8(batch.column("text"))
    coded = batch.column("lang").dictionary_encode()
    row_langs, lang_names = coded.indices.to_numpy(), coded.dictionary
    lang_hashes = _hashes(lang_names, 1)
    for begin, end in _blocks(data, offsets, size):
        block = np.frombuffer(data[begin:end].tobytes().translate(_LOWER), np.uint8)
        kind = _kinds(block)
        word = kind == 0
        # A text that begins here ends the word before it.
        inner = offsets[(offsets > begin) & (offsets < end)] - begin
        before, after = np.r_[False, word[:-1]], np.r_[word[1:], False]
        before[inner], after[inner - 1] = False, False
        starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        if not len(starts):
            continue
        first_row = int(np.searchsorted(offsets, begin, "right")) - 1
        changes = np.searchsorted(starts, np.r_[inner, len(block)])
        rows = np.repeat(np.arange(first_row, first_row + len(changes)), np.diff(changes, prepend=0))
        pieces = np.cumsum(kind == 2, dtype=np.int32)[starts] + rows
        bounds = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(block[word])]
        encoded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        ids = encoded.indices.to_numpy()
        yield _Words(ids, pieces, row_langs[rows], encoded.dictionary, lang_names, _hashes(encoded.dictionary, 0), lang_hashes)


def _scan(texts: DataFrame, schema: str, per_block: Callable[[_Words], list], size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in _words(batch, size):
                yield pa.RecordBatch.from_arrays(per_block(words), [c.split()[0] for c in schema.split(", ")])

    return texts.mapInArrow(run, schema)


# Filters -----------------------------------------------------------------------------------------------------


@dataclass
class Filter:
    """A Bloom filter over keys: one bit by their high bits, one by their low bits."""

    words: np.ndarray
    log_bits: int

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in (keys >> np.uint64(64 - self.log_bits), keys & np.uint64((1 << self.log_bits) - 1)):
            bit = self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))
            found &= (bit & np.uint64(1)).astype(bool)
        return found


def build_filter(keys: DataFrame, most: int) -> Filter:
    """Filter over the column ``key`` of a written frame. Its bits are gathered, at most 2 ** ``most`` of them."""
    log_bits = min(max(16, math.ceil(math.log2(16 * max(1, keys.count())))), most)
    places = F.array(F.shiftrightunsigned("key", 64 - log_bits), F.col("key").bitwiseAND((1 << log_bits) - 1))
    bits = keys.select(F.explode(places).alias("place")).select(
        F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit")
    )
    held = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(1 << (log_bits - 6), np.int64)
    words[held.column("word").to_numpy()] = held.column("bits").to_numpy()
    return Filter(words.view(np.uint64), log_bits)


def _keyed(phrases: DataFrame) -> DataFrame:
    """Keys of rows (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lang = _hashes(batch.column("lang"), 1)
            split = [p.encode().split(b" ") for p in batch.column("phrase").to_pylist()]
            keys = np.zeros(len(split), np.uint64)
            sizes = np.array([len(p) for p in split])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                words = [_hashes(pa.array([split[i][j] for i in at], pa.large_binary()), 0) for j in range(size)]
                keys[at] = key_of(lang[at], *words)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])

    return phrases.select("lang", "phrase").mapInArrow(run, "key bigint")


# Counts ------------------------------------------------------------------------------------------------------


def _phrases(texts: DataFrame, size: int, chosen: Callable[[_Words, np.ndarray], np.ndarray], settings: Settings) -> DataFrame:
    """Frequent phrases of so many words (lang, phrase, f) among the windows that are chosen."""

    def per_block(words: _Words) -> list:
        at = words.starts(size)
        lang, phrase, counts = words.counted(at[chosen(words, at)], size)
        return [lang, phrase, pa.array(counts.astype(np.int64))]

    found = _scan(texts, "lang string, phrase string, f bigint", per_block, settings.block_bytes)
    found = found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return checkpointed(found.where(F.col("f") >= settings.least))


def _single_words(texts: DataFrame, settings: Settings) -> DataFrame:
    """Frequent words (lang, phrase, f), and under the empty word the number of all words of a language."""

    def per_block(words: _Words) -> list:
        lang, phrase, counts = words.counted_words()
        total = np.bincount(words.langs, minlength=len(words.lang_names)).astype(np.int64)
        there = np.flatnonzero(total)
        lang = pa.concat_arrays([lang, words.lang_names.take(pa.array(there))])
        phrase = pa.concat_arrays([phrase, pa.array([""] * len(there), pa.string())])
        return [lang, phrase, pa.array(np.r_[counts, total[there]].astype(np.int64))]

    found = _scan(texts, "lang string, phrase string, f bigint", per_block, settings.block_bytes)
    found = found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return checkpointed(found.where((F.col("f") >= settings.least) | (F.col("phrase") == "")))


def _pairs(texts: DataFrame, words: DataFrame, settings: Settings) -> DataFrame:
    """Frequent pairs: first by keys alone, which are short, then those whose key is frequent by their words."""
    frequent = build_filter(checkpointed(_keyed(words)), settings.filter_log_bits)

    def per_block(words: _Words) -> list:
        at = words.starts(2)
        singles = [frequent.holds(words.keys(at + j, 1)) for j in range(2)]
        keys, counts = np.unique(words.keys(at[singles[0] & singles[1]], 2), return_counts=True)
        return [pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))]

    keys = _scan(texts, "key bigint, f bigint", per_block, settings.block_bytes)
    keys = keys.groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= settings.least)
    kept = build_filter(checkpointed(keys.select("key")), settings.filter_log_bits)
    return _phrases(texts, 2, lambda block, at: kept.holds(block.keys(at, 2)), settings)


# Scores, thresholds and growth -------------------------------------------------------------------------------


def _exact(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def _part(first: int, size: int, of: int) -> Column:
    """Words ``first`` to ``first + size`` of a phrase of so many words."""
    head = F.substring_index("phrase", " ", first + size)
    return F.substring_index(head, " ", -size) if first else head


def score_of(a: Column, both: Column, settings: Settings) -> Column:
    """scale * a / both rounded down, without overflow."""
    return F.call_function("div", _exact(a) * F.lit(settings.scale).cast("decimal(10,0)"), _exact(both)).cast("bigint")


def _scored(phrases: DataFrame, size: int, known: DataFrame, settings: Settings) -> DataFrame:
    """Rows (lang, phrase, size, a, score, l, r, first) of phrases all of whose parts have known counts."""
    cuts = [F.struct(F.lit(j).alias("cut"), F.lit(side).alias("side"), part.alias("part")) for j in range(1, size) for side, part in (("l", _part(0, j, size)), ("r", _part(j, size - j, size)))]
    parts = phrases.select("lang", "phrase", F.col("f").alias("a"), F.inline(F.array(*cuts)))
    counts = known.select("lang", F.col("phrase").alias("part"), F.col("f").alias("of"))
    sides = parts.join(counts, ["lang", "part"]).groupBy("lang", "phrase", "a", "cut")
    sides = sides.agg(F.max(F.when(F.col("side") == "l", F.col("of"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("of"))).alias("r"))
    worst = F.struct(score_of(F.col("a"), F.col("l") + F.col("r"), settings).alias("score"), "cut", "l", "r")
    first = F.max(F.when(F.col("cut") == 1, F.col("l"))).alias("first")
    best = sides.where("l is not null and r is not null").groupBy("lang", "phrase", "a")
    best = best.agg(F.min(worst).alias("worst"), first, F.count("*").alias("cuts")).where(F.col("cuts") == size - 1)
    return best.select("lang", "phrase", F.lit(size).alias("size"), "a", "worst.score", "worst.l", "worst.r", "first")


def _threshold(scores: DataFrame, settings: Settings) -> DataFrame:
    """(lang, floor): a score that so many phrases of a language reach; languages with fewer have no row.

    Scores are at most half of the scale, so a language has a bounded number of steps.
    """
    steps = scores.groupBy("lang", F.expr(f"score div {settings.step}").alias("bin")).count()
    reached = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("bin")))
    full = steps.withColumn("reached", reached).where(F.col("reached") >= settings.best)
    return full.groupBy("lang").agg((F.max("bin") * settings.step).alias("floor"))


def _small(by_language: DataFrame) -> DataFrame:
    """A written frame with a row for each language: broadcast while the languages are few, as they should be."""
    return F.broadcast(by_language) if by_language.count() <= 100_000 else by_language


def _from(rows: DataFrame, floors: DataFrame, value: Column, name: str = "floor") -> DataFrame:
    """Rows whose value reaches their language's floor."""
    floors = _small(floors.select("lang", F.col("floor").alias(name)))
    return rows.join(floors, "lang", "left").where(value >= F.coalesce(F.col(name), F.lit(0))).drop(name)


def _settled_at_once(scored: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """``scored`` with ``sure``: no frequent pair beside either end could make up a longer phrase that covers it."""
    before = pairs.groupBy("lang", _part(1, 1, 2).alias("head")).agg(F.max("f").alias("before"))
    behind = pairs.groupBy("lang", _part(0, 1, 2).alias("tail")).agg(F.max("f").alias("behind"))
    ends = scored.withColumns({"head": F.substring_index("phrase", " ", 1), "tail": F.substring_index("phrase", " ", -1)})
    beside = ends.join(before, ["lang", "head"], "left").join(behind, ["lang", "tail"], "left")
    most = F.coalesce(F.greatest("before", "behind"), F.lit(0))
    return beside.withColumn("sure", ~_covers(most, F.col("a"), settings)).select(*scored.columns, "sure")


def _covers(longer: Column, a: Column, settings: Settings) -> Column:
    return _exact(longer) * 100 >= _exact(a) * settings.covered


def _survivors(waiting: DataFrame, longer: DataFrame, size: int, settings: Settings) -> DataFrame:
    """Rows that no phrase of one word more covers."""
    inside = F.explode(F.array(_part(0, size, size + 1), _part(1, size, size + 1))).alias("phrase")
    most = longer.select("lang", inside, "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    joined = waiting.join(most, ["lang", "phrase"], "left")
    return joined.where(~_covers(F.coalesce("most", F.lit(0)), F.col("a"), settings)).drop("most")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The best phrases of each language: rows (lang, rank, phrase, a, l, r, n, score).

    A-Z is lower-cased; pieces end at ``. , ; : ! ?`` and at line ends, words at blanks and tabs. ``n`` counts all
    words of the language. Ranks go by score, then a, then the phrase's bytes, so ties have an order of their own.
    Rows without a language are of the language ``und``; null and empty texts have no words; repeated rows
    count as often as they stand there. An empty table gives no rows. Other columns are not read.
    """
    if not 2 <= settings.longest <= 4:
        raise ValueError("phrases have 2 to 4 words")
    texts = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    counted = _single_words(texts, settings)
    words, totals = counted.where("phrase <> ''"), counted.where("phrase = ''").select("lang", F.col("f").alias("n"))
    pairs = _pairs(texts, words, settings)
    neighbours = build_filter(checkpointed(_keyed(pairs)), settings.filter_log_bits)
    known = words.unionByName(pairs)
    scored = checkpointed(_settled_at_once(_scored(pairs, 2, known, settings), pairs, settings))
    settled: list[DataFrame] = []
    for size in range(3, settings.longest + 1):
        growth = _Growth(texts, size, scored, pairs, known, neighbours, settings)
        settled.append(scored.where("sure"))
        # First what reaches the scores that are known, settled or not; then what is left above the threshold.
        growth.grow(_union([*settled, growth.waiting]))
        growth.grow(_union([*settled, growth.survivors(), growth.scored().where("sure")]))
        settled.append(checkpointed(growth.survivors()))
        known = known.unionByName(growth.longer)
        scored = checkpointed(growth.scored())
    every = _union([*settled, scored])
    floors = checkpointed(_threshold(every.select("lang", "score"), settings))
    return _ranked(_from(every, floors, F.col("score")), totals, settings)


class _Growth:
    """Phrases of ``size`` words, grown from those that are a word shorter, in blocks."""

    def __init__(self, texts, size, shorter, pairs, known, neighbours, settings) -> None:
        self.texts, self.size, self.shorter, self.pairs = texts, size, shorter, pairs
        self.known, self.neighbours, self.settings = known, neighbours, settings
        self.waiting = shorter.where("not sure")
        none = shorter.select("lang", "phrase").limit(0)
        # What is grown already, what is settled by it, and the frequent phrases found.
        self.wanted, self.asked, self.longer = none, none, pairs.limit(0)

    def grow(self, candidates: DataFrame) -> None:
        """One pass over the texts for what may reach the threshold that the candidates' scores set."""
        floors = checkpointed(_threshold(candidates.select("lang", "score"), self.settings))
        bound = score_of(F.col("a"), F.col("first") + F.col("a"), self.settings)
        prefixes = _from(self.shorter, floors, bound)
        asked = _from(self.waiting, floors, F.col("score")).select("lang", "phrase")
        wanted = prefixes.select("lang", "phrase").unionByName(asked)
        if self.size < self.settings.longest:
            wanted = wanted.unionByName(_rests(self.shorter, prefixes, self.size - 1, floors, self.settings))
        both = ["lang", "phrase"]
        wanted = checkpointed(wanted.distinct().join(self.wanted, both, "left_anti"))
        asked = checkpointed(asked.join(self.asked, both, "left_anti"))
        if wanted.isEmpty() and asked.isEmpty():
            return
        found = _grown(self.texts, self.size, wanted, asked, self.neighbours, self.settings)
        self.wanted, self.asked = self.wanted.unionByName(wanted), self.asked.unionByName(asked)
        self.longer = checkpointed(self.longer.unionByName(found).dropDuplicates(both))

    def survivors(self) -> DataFrame:
        """The waiting phrases that no longer one covers, among those that were asked for."""
        settled = self.waiting.join(self.asked, ["lang", "phrase"], "left_semi")
        return _survivors(settled, self.longer, self.size - 1, self.settings)

    def scored(self) -> DataFrame:
        """The longer phrases with scores; the longest ones have nothing that could cover them."""
        scored = _scored(self.longer, self.size, self.known.unionByName(self.longer), self.settings)
        if self.size == self.settings.longest:
            return scored.withColumn("sure", F.lit(True))
        return _settled_at_once(scored, self.pairs, self.settings)


def _rests(scored: DataFrame, prefixes: DataFrame, size: int, floors: DataFrame, settings: Settings) -> DataFrame:
    """Phrases whose longer forms are wanted as the rest behind the first word of a phrase that is two words longer.

    Such a phrase begins with a prefix that is grown and goes on with this one, so it counts at most as
    often as this one does, and is bounded with the rarest first word of such a prefix.
    """
    joint = F.substring_index("phrase", " ", -(size - 1)).alias("joint")
    rarest = prefixes.select("lang", joint, "first").groupBy("lang", "joint").agg(F.min("first").alias("rarest"))
    begins = scored.select("lang", "phrase", "a", F.substring_index("phrase", " ", size - 1).alias("joint"))
    bound = score_of(F.col("a"), F.col("rarest") + F.col("a"), settings)
    return _from(begins.join(rarest, ["lang", "joint"]), floors, bound).select("lang", "phrase")


def _grown(texts: DataFrame, size: int, wanted: DataFrame, asked: DataFrame, neighbours: Filter, settings: Settings) -> DataFrame:
    """Frequent phrases that begin with a wanted one, or end with one that is asked for."""
    begins = build_filter(checkpointed(_keyed(wanted)), settings.filter_log_bits)
    ends = build_filter(checkpointed(_keyed(asked)), settings.filter_log_bits)

    def chosen(block: _Words, at: np.ndarray) -> np.ndarray:
        beside = neighbours.holds(block.keys(np.arange(max(len(block.ids) - 1, 0)), 2))
        near = reduce(np.logical_and, [beside[at + j] for j in range(size - 1)])
        found = np.zeros(len(at), bool)
        places = np.flatnonzero(near)
        left = at[places]
        found[places] = begins.holds(block.keys(left, size - 1)) | ends.holds(block.keys(left + 1, size - 1))
        return found

    return _phrases(texts, size, chosen, settings)


def _ranked(rows: DataFrame, totals: DataFrame, settings: Settings) -> DataFrame:
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(settings.salts)).alias("salt")
    salted = rows.select("*", salt).withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    ranked = salted.where(F.col("at") <= settings.best).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    kept = ranked.where(F.col("rank") <= settings.best).join(_small(totals), "lang")
    return kept.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
