"""Line deduplication against plain edit distances between all lines."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripmill.llm import line_dedup
from tripmill.llm.line_dedup import Settings
from tripmill.llm.queries import op7_line_dedup


def distance(a, b):
    a, b = a.encode(), b.encode()
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        before, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], min(before + (x != y), row[j] + 1, row[j + 1] + 1)
    return row[-1]


def edited(line, edits, rng):
    letters = list(line)
    for _ in range(edits):
        at, kind = rng.randrange(len(letters) or 1), rng.randrange(3)
        if kind == 0:
            letters.insert(at, rng.choice("abé👍"))
        elif letters and kind == 1:
            letters[at] = rng.choice("abé👍")
        elif letters:
            del letters[at]
    return "".join(letters)


def brute(rows, setting=Settings()):
    size = len if setting.characters else lambda x: len(x.encode())
    apart = points_apart if setting.characters else distance
    first = {}
    places = []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        for n, line in enumerate((text or "").split("\n")):
            if line.strip(" ") and size(line) >= setting.shortest_equal:
                places.append((doc, n, line))
                first.setdefault(line, (doc, n))
    near = set()
    lines = [x for x in first if size(x) >= setting.shortest]
    for at, line in enumerate(lines):
        close = (o for o in lines[:at] if abs(size(o) - size(line)) <= setting.edits)
        if any(apart(o, line) <= setting.edits for o in close):
            near.add(line)
    return sorted({(d, n, line in near) for d, n, line in places if line in near or first[line] != (d, n)}, key=str)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_banded_distance(spark, k):
    rng = random.Random(k)
    pairs = [("", ""), ("", "a"), ("ab", ""), ("a", "b"), ("abc", "cab"), ("aaaa", "aa")]
    for _ in range(600):
        a = "".join(rng.choice("abé👍") for _ in range(rng.randint(0, 14)))
        pairs.append((a, edited(a, rng.randint(0, k + 2), rng)))
    df = spark.createDataFrame(pairs, "a string, b string")
    near = line_dedup.within_edits(line_dedup._bytes("a"), line_dedup._bytes("b"), k)
    raw = line_dedup._near(line_dedup._bytes("a"), line_dedup._bytes("b"), k)
    for r in df.select("a", "b", near.alias("near"), raw.alias("raw")).collect():
        assert r["near"] == r["raw"] == (distance(r["a"], r["b"]) <= k), r


@pytest.mark.parametrize("k", [1, 2, 3])
def test_near_lines_share_a_key(spark, k):
    rng = random.Random(10 + k)
    pairs = []
    for _ in range(500):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(k + 1, 20)))
        pairs.append((a, edited(a, rng.randint(0, k), rng)))
    pairs = [(a, b) for a, b in pairs if len(b) > k and distance(a, b) <= k]
    df = spark.createDataFrame(pairs, "a string, b string")
    keys = lambda c: line_dedup._keyed(df.select("a", "b", F.col(c).alias("line"), F.octet_length(c).alias("size")), k, "a", "b")
    met = keys("a").join(keys("b"), ["a", "b", "key"]).select("a", "b").distinct()
    assert df.join(met, ["a", "b"], "left_anti").collect() == []


@pytest.mark.parametrize("k", [1, 2])
def test_families_of_lines(spark, k):
    rng = random.Random(20 + k)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(18, 60))) for _ in range(12)]
    rows = []
    for i in range(60):
        picked = [edited(rng.choice(base), rng.choice((0, 0, 1, 2, 3, 5)), rng) for _ in range(rng.randint(0, 5))]
        rows.append((i, "\n".join([*picked, "", "short"])))
    docs = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id long, text string, h string, near boolean")
    setting = Settings(edits=k, filter_log_words=6)
    found = line_dedup.duplicate_lines(docs, settings=setting)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, setting)
    left = {r["doc_id"]: r for r in line_dedup.without_lines(docs, found).collect()}
    gone = {(d, n) for d, n, _ in brute(rows, setting)}
    for d, text in rows:
        assert left[d]["text"] == "\n".join(x for n, x in enumerate(text.split("\n")) if (d, n) not in gone)
        assert left[d]["h"] == "x"


def test_null_empty_long_and_repeated(spark):
    long = "word " * 8_000
    line = "this line is long enough"
    rows = [(1, None), (2, ""), (3, long + "a"), (4, long + "b\n" + line), (4, long + "b\n" + line), (None, line), (5, f"{line}\n\n{line}\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.duplicate_lines(docs)
    assert sorted(map(tuple, found.collect())) == [(4, 0, True), (4, 1, False), (5, 0, False), (5, 2, False)]
    left = sorted((r["doc_id"] or 0, r["text"]) for r in line_dedup.without_lines(docs, found).where("text is not null").collect())
    assert left == [(0, line), (2, ""), (3, long + "a"), (4, ""), (4, ""), (5, "\n")]
    assert line_dedup.without_lines(docs, found).count() == len(rows)
    assert line_dedup.duplicate_lines(docs.limit(0)).count() == 0


def test_query_over_the_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    # Lines of nearly equal length are few, so all pairs can be tried.
    assert sorted(map(tuple, op7_line_dedup(spark, sf_dir).collect()), key=str) == brute(rows, Settings(characters=True))


def test_short_lines_are_found_where_they_are_equal(spark):
    """Floors count the unit of the edits: lines where bytes and characters differ, and short and blank ones."""
    rows = [(1, "ab\n \n\n漢字語漢字語漢"), (2, "ab\n \n\n漢字語漢字語漢"), (3, "漢字語漢字語漢字語\nac\nñandú y niño, el año"), (4, "é\né\nñandu y niño, el año")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for setting in (Settings(), Settings(characters=True), Settings(characters=True, shortest_equal=3), Settings(shortest=5, shortest_equal=5)):
        assert sorted(map(tuple, line_dedup.duplicate_lines(docs, settings=setting).collect()), key=str) == brute(rows, setting)
    found = line_dedup.duplicate_lines(docs, settings=Settings(characters=True))
    assert sorted(map(tuple, found.collect())) == [(2, 0, False), (2, 3, False), (4, 1, False), (4, 2, True)]
    # The pipeline leaves short lines where they are.
    kept = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert sorted(r["text"] for r in kept.where("doc_id < 4").collect()) == sorted(t for d, t in rows if d < 4)


def points_apart(a, b):
    """Edits of characters: the distance of texts whose characters are one byte each."""
    code = {c: chr(i) for i, c in enumerate(sorted(set(a + b)))}
    return distance("".join(map(code.get, a)), "".join(map(code.get, b)))


@pytest.mark.parametrize("k", [1, 2])
def test_edits_of_characters(spark, k):
    rng = random.Random(30 + k)
    base = ["".join(rng.choice("abcé漢字語👍ñ ") for _ in range(rng.randint(24, 40))) for _ in range(8)]
    lines = [edited(rng.choice(base), rng.choice((0, 1, 1, 2, 3)), rng) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = line_dedup.duplicate_lines(docs, settings=Settings(edits=k, filter_log_words=6, characters=True))
    first = {}
    for at, line in enumerate(lines):
        first.setdefault(line, at)
    near = {x for x in first if any(first[o] < first[x] and points_apart(o, x) <= k for o in first)}
    want = [(at, 0, x in near) for at, x in enumerate(lines) if x in near or first[x] != at]
    assert sorted(map(tuple, found.collect())) == want
    assert len(want) > line_dedup.duplicate_lines(docs, settings=Settings(edits=k, filter_log_words=6)).count()


def test_pipeline_counts_characters(spark):
    lines = ["これは十分に長い行であり二十字を超えています", "これは十分に長い行であリ二十字を超えていまず", "El niño pequeño come una manzana", "El nino pequeno come una manzana"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    left = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {0: lines[0], 1: "", 2: lines[2], 3: ""}


def test_rows_of_one_id_are_told_apart_by_text(spark):
    a, b, c = (f"{x} is a line that is long enough" for x in ("first thing", "another matter", "something else"))
    for key in (None, 5):
        rows = [(key, f"{a}\n{b}"), (key, f"{c}\n{a}"), (key, f"{c}\n{a}"), (9, "a line of its own, that stays")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        left = corpus_pipeline.drop_repeated_lines(spark, docs, "")
        texts = sorted(r["text"] for r in left.where("doc_id is null or doc_id = 5").collect())
        # Which of the rows keeps the line that they share follows a hash; nothing else goes.
        assert texts in (sorted([f"{a}\n{b}", c, c]), sorted([b, f"{c}\n{a}", f"{c}\n{a}"]))
        assert left.count() == 4
    # A repeat at the same line number of another row is one.
    docs = spark.createDataFrame([(5, f"{a}\n{b}"), (5, f"{a}\n{c}")], "doc_id long, text string")
    assert [tuple(r) for r in line_dedup.duplicate_lines(docs).collect()] == [(5, 0, False)]
