"""Duplicate and near-duplicate lines by a segment-partition edit join, in DataFrame functions alone.

Two lines within k edits, cut into k + 1 segments, share a segment at almost the same place. Each line is
indexed under its own segments, with its length, and probes the segments that a line of its length or up
to k characters less could share with it; how far a segment may have moved follows from the edits that
are left on either side of it. Lines that meet in a segment are compared by a banded bit-parallel edit
distance.

A first pass over the segments keeps hashes alone, and finds the segments where different lines meet. They
fill a Bloom filter of bounded size, by which a second pass leaves all other segments where they are. In a
segment each line is first compared with its earliest line, which takes one row for each line; only lines
that this does not settle are compared with the others, and only where counts of frequent letters allow it.

Edits are of bytes of UTF-8 or of characters. Places in ASCII lines are the same in both, so these are cut as
bytes; only other lines are walked through when they are cut by characters. Two lines within k bytes are within
k characters, so counting characters finds all that counting bytes does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm import bloom
from tripmill.llm.common import checkpointed, text_of


# Letters whose counts are compared before texts are: frequent ones in many languages.
LETTERS = "aeiounrtshdl"


@dataclass(frozen=True)
class Settings:
    edits: int = 2
    # Count edits in characters, as the queries do, or in bytes, as levenshtein of DuckDB does.
    characters: bool = False
    # Lines of fewer bytes or characters, as edits are counted, are near to nothing: a few edits make most short
    # lines alike. Equal ones are found down to ``shortest_equal``; blank lines never are.
    shortest: int = 20
    shortest_equal: int = 1
    # The filters have 2 ** so many words of 64 bits. Very many entries let more pass, but lose nothing.
    filter_log_words: int = 18


def _lines(docs: DataFrame, doc_id: str, text: str, settings: Settings) -> DataFrame:
    """Lines that are compared: place (id, hash of the row's text, number from 0), text, size in the unit of edits, and a 128-bit hash of the text."""
    row = _hash(text_of(text)).alias("row")
    split = docs.select(docs[doc_id].alias("doc_id"), row, F.posexplode(F.split(text_of(text), "\n")).alias("line_no", "line"))
    size = F.char_length("line") if settings.characters else F.octet_length("line")
    sized = split.withColumn("size", size).where((F.col("size") >= settings.shortest_equal) & (F.trim("line") != ""))
    return sized.withColumn("h", _hash("line"))


def _hash(line: str | Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _probes(k: int) -> list[tuple[int, int, int]]:
    """(bytes less, segment, shift): the segments under which a line stands.

    For a line that is so many bytes shorter, at most i edits moved segment i from its start, and at most
    k - i from its end. With nothing less and no shift these are the line's own segments.
    """
    found = []
    for less in range(k + 1):
        for i in range(k + 1):
            low, high = max(-i, less - (k - i)), min(i, less + (k - i))
            found += [(less, i, shift) for shift in range(low, high + 1)]
    return found


def _keyed(lines: DataFrame, k: int, *columns: str, characters: bool = False) -> DataFrame:
    """The columns and ``key``, a hash of a segment with its number and the length of its line.

    Segments are of bytes, or of characters, as ``size`` is.

    The probes are spread over rows and not over columns: one small expression stays within what the JVM
    compiles, where one for each probe does not.
    """
    probes = F.array(*[F.struct(F.lit(a).alias("less"), F.lit(i).alias("i"), F.lit(m).alias("shift")) for a, i, m in _probes(k)])
    raw = F.col("line").cast("binary").alias("raw")
    spread = lines.select(*columns, "size", raw, *["line"] * characters, F.inline(probes))
    of = F.col("size") - F.col("less")
    base, longer = F.expr(f"(size - less) div {k + 1}").cast("int"), of % (k + 1)
    # The last segments are a byte longer, as many of them as bytes are left over.
    short = k + 1 - longer
    start = F.col("i") * base + F.greatest(F.lit(0), F.col("i") - short) + 1 + F.col("shift")
    length = base + F.when(F.col("i") >= short, 1).otherwise(0)
    kept = [*columns, "size", "raw", *["line"] * characters, "i"]
    placed = spread.select(*dict.fromkeys(kept), of.alias("of"), start.alias("start"), length.alias("length"))
    inside = placed.where("of > 0 and start >= 1 and start + length - 1 <= size")
    segment = F.expr("substring(raw, start, length)")
    if characters:
        walked = F.expr("cast(substring(line, start, length) as binary)")
        segment = F.when(F.octet_length("raw") == F.col("size"), segment).otherwise(walked)
    return inside.select(*columns, F.xxhash64("i", "of", segment).alias("key"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute a value once and use it several times."""
    return F.transform(F.array(value), use)[0]


def _without_equal_start(a: Column, b: Column) -> Column:
    """Both arrays from their first difference on."""
    first = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    # No difference at all leaves nothing.
    at = F.when(first == 0, F.size(a) + 1).otherwise(first).cast("int")
    return F.struct(F.slice(a, at, F.size(a)).alias("a"), F.slice(b, at, F.size(b)).alias("b"))


def within_edits(a: Column, b: Column, k: int) -> Column:
    """Whether two arrays differ by at most k edits: bit vectors on a diagonal band.

    Equal starts and ends are cut off; what is left goes through Hyyro's banded form of Myers' algorithm.
    """
    cut = lambda pair: _without_equal_start(pair["a"], pair["b"])
    turned = lambda pair: F.struct(F.reverse(pair["a"]).alias("a"), F.reverse(pair["b"]).alias("b"))
    pair = F.struct(a.alias("a"), b.alias("b"))
    return _let(pair, lambda p: _let(cut(p), lambda q: _let(turned(q), lambda r: _let(cut(r), lambda t: _near(t["a"], t["b"], k)))))


def _near(pattern: Column, chars: Column, k: int) -> Column:
    """The band holds 2 k + 1 rows around the diagonal, so one integer does for lines of any length.

    It moves down a row with each character. The distance is followed along the lowest diagonal of the
    band until that leaves the pattern, and then along the pattern's last row. It never falls on the diagonal
    and has at most 2 k steps on the row, so beyond 3 k nothing needs to be followed any more.
    """
    m, n = F.size(pattern), F.size(chars)
    mask, top = (1 << (2 * k + 1)) - 1, 1 << (2 * k)

    def inverse(bits: Column) -> Column:
        return F.lit(mask).bitwiseXOR(bits.bitwiseAND(mask))

    def equal_rows(i: Column) -> Column:
        """Bits of the rows i - k .. i + k of the pattern that hold character i."""
        c = F.get(chars, i)
        rows = [F.when(F.get(pattern, i + (d - k)) == c, 1 << d).otherwise(0) for d in range(2 * k + 1)]
        return reduce(lambda x, y: x + y, rows)

    def step(state: Column, i: Column) -> Column:
        vp, vn = state["vp"], state["vn"]

        def from_match(x: Column) -> Column:
            d0 = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(mask)
            return _let(d0, lambda d0: _let(vn.bitwiseOR(inverse(d0.bitwiseOR(vp))), lambda hp: following(d0, hp)))

        def following(d0: Column, hp: Column) -> Column:
            hn, down = d0.bitwiseAND(vp), F.shiftright(d0, 1)
            # The last row stands a bit lower with each character.
            row = m + (k - 1) - i
            bit = lambda bits: F.call_function("shiftright", bits, row).bitwiseAND(1)
            change = bit(hp) - bit(hn)
            on_diagonal = 1 - F.shiftright(d0, 2 * k).bitwiseAND(1)
            return F.struct(
                hn.bitwiseOR(inverse(down.bitwiseOR(hp))).alias("vp"),
                down.bitwiseAND(hp).alias("vn"),
                (state["score"] + F.when(i < m - k, on_diagonal).otherwise(change)).alias("score"),
            )

        return F.when(state["score"] > 3 * k, state).otherwise(_let(equal_rows(i), from_match))

    start = F.struct(
        F.lit(((1 << (k + 1)) - 1) << k).alias("vp"), F.lit(0).alias("vn"), F.least(m, F.lit(k)).alias("score")
    )
    score = F.aggregate(F.sequence(F.lit(0), n - 1), start, step, lambda s: s["score"])
    return F.when((m == 0) | (n == 0), F.greatest(m, n) <= k).when(F.abs(m - n) > k, False).otherwise(score <= k)


def _bytes(line: str) -> Column:
    """A text as an array of its bytes, each as one character of Latin-1."""
    return F.split(F.decode(F.col(line).cast("binary"), "ISO-8859-1"), "")


def _units(line: str, settings: Settings) -> Column:
    """A text as an array of what edits are counted in."""
    return F.split(line, "") if settings.characters else _bytes(line)


def _letters(line: str) -> Column:
    """Counts of frequent letters: an edit changes their sum of differences by two at most."""
    size = F.octet_length(line)
    return F.array(*[(size - F.octet_length(F.translate(F.col(line), c, ""))) for c in LETTERS])


def _verified(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Hashes u of the pairs (u, v) whose texts are within the edits."""
    a = texts.select(F.col("h").alias("u"), _units("line", settings).alias("chars_u"))
    b = texts.select(F.col("h").alias("v"), _units("line", settings).alias("chars_v"))
    joined = pairs.join(a, "u").join(b, "v")
    return joined.where(within_edits(F.col("chars_u"), F.col("chars_v"), settings.edits)).select(F.col("u").alias("h")).distinct()


def _near_lines(lines: DataFrame, settings: Settings) -> DataFrame:
    """Hashes of the lines that have an earlier line, by first place, within the edits."""
    k = settings.edits
    # Copies have equal hashes, so a segment that only copies share is none where lines meet.
    ends = [F.min("one").alias("low"), F.max("one").alias("high")]
    met = _keyed(lines.select("line", "size", F.col("h.a").alias("one")), k, "one", characters=settings.characters).groupBy("key").agg(*ends)
    met = checkpointed(met.where("low <> high").select("key"))
    there = bloom.build_hashed(met, settings.filter_log_words)
    # A filter that mentions the key several times would be pushed down and hash the segment as often; it
    # cannot pass the explode of one element.
    keyed = _keyed(lines, k, "h", "doc_id", "row", "line_no", characters=settings.characters)
    small = keyed.select("h", "doc_id", "row", "line_no", F.explode(F.array("key")).alias("key")).where(there.holds(F.col("key")))
    members = small.groupBy("key", "h").agg(F.min(F.struct("doc_id", "row", "line_no")).alias("place"))
    members = checkpointed(members)
    leaders = members.groupBy("key").agg(F.min(F.struct("place", "h")).alias("leader"), F.count("*").alias("n")).where("n > 1")
    led = checkpointed(members.join(leaders.select("key", F.col("leader.h").alias("leader")), "key"))
    first_pairs = led.where("h <> leader").select(F.col("h").alias("u"), F.col("leader").alias("v")).distinct()
    wanted = checkpointed(led.select("h").distinct())
    known = bloom.build_hashed(wanted.select(F.col("h.a").alias("key")), settings.filter_log_words)
    # Grouped before it is joined, so that a line that stands in very many places arrives once from each task.
    texts = lines.where(known.holds(F.col("h.a"))).groupBy("h").agg(F.first("line").alias("line"))
    texts = checkpointed(texts.join(wanted, "h", "left_semi"))
    settled = checkpointed(_verified(first_pairs, texts, settings))
    others = led.where("h <> leader").join(texts.select("h", "line", _letters("line").alias("letters")), "h")
    u = others.join(settled, "h", "left_anti").select(
        "key", "h", F.col("place").alias("at_u"), F.col("letters").alias("in_u"), F.col("line").alias("line_u")
    )
    v = others.select(
        F.col("key").alias("at"), F.col("place").alias("at_v"), F.col("letters").alias("in_v"), F.col("line").alias("line_v")
    )
    apart = sum((F.abs(F.col("in_u")[i] - F.col("in_v")[i]) for i in range(len(LETTERS))), F.lit(0))
    # The cheaper tests first; a pair that fails the last one is never a row.
    alike = (F.col("key") == F.col("at")) & (F.col("at_v") < F.col("at_u")) & (apart <= 2 * k)
    linked = u.join(v, alike & within_edits(_units("line_u", settings), _units("line_v", settings), k)).select("h").distinct()
    return settled.union(linked)


def duplicate_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The lines to remove: rows (id, ``line_no`` from 0, ``near``).

    A line goes where an earlier place (by id, then line number; a null id comes first) has the same line,
    or where its text has an earlier first place of another text within the edits (``near``). Lines are parted
    by line feeds; edits are of bytes of UTF-8, or of ``Settings.characters``. Lines shorter than ``Settings.shortest``
    in the same unit go for equal lines alone, and those below ``Settings.shortest_equal`` or of spaces alone stay. Null
    and empty texts have no line. A row is known by its id and its whole text: equal rows are one document, in which
    the same place twice is no duplicate; rows of one id with other texts are others, in the order of a hash.
    """
    return duplicate_places(docs, doc_id, text, settings).select(doc_id, "line_no", "near").distinct()


def duplicate_places(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``duplicate_lines`` with ``row``, a hash that tells rows of one id, or without any, apart by their texts."""
    lines = _lines(docs, doc_id, text, settings)
    near = _near_lines(lines.where(F.col("size") >= settings.shortest), settings).withColumn("near", F.lit(True))
    places = lines.select("h", F.struct("doc_id", "row", "line_no").alias("place"))
    firsts = places.groupBy("h").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    bad = firsts.join(near, "h", "left").where("near or first <> last")
    # Written, so that the join deals both sides anew and Spark can split a line that very many places have.
    bad = checkpointed(bad.select("h", "first", F.coalesce("near", F.lit(False)).alias("near")))
    found = places.join(bad, "h").where("near or place <> first")
    return found.select(F.col("place.doc_id").alias(doc_id), "place.row", "place.line_no", "near").distinct()


def without_lines(docs: DataFrame, lines: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` without the given lines. Texts that lose none stay as they are.

    Lines of ``duplicate_places`` go from their own rows; those of ``duplicate_lines`` from all rows of the id.
    """
    names = {doc_id: "_line_id"} | ({"row": "_line_row"} if "row" in lines.columns else {})
    listed = lines.groupBy(*[F.col(a).alias(b) for a, b in names.items()]).agg(F.collect_set("line_no").alias("_lines"))
    same = docs[doc_id].eqNullSafe(listed["_line_id"])
    if "row" in lines.columns:
        same &= _hash(F.coalesce(docs[text].cast("string"), F.lit(""))) == listed["_line_row"]
    joined = docs.join(listed, same, "left")
    split = F.split(docs[text], "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), listed["_lines"])
    kept = F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n")
    new = F.when(listed["_lines"].isNull(), docs[text]).otherwise(kept)
    return joined.select(*[new.alias(c) if c == text else docs[c] for c in docs.columns])
