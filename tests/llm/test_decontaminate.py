"""Decontamination against a full alignment of every item with every document."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import decontaminate
from tripmill.llm.decontaminate import Index, Settings
from tripmill.llm.queries import op3_decontaminate


def plain(text):
    return re.sub(r"\s+", " ", text.lower())


def fewest_edits(item, text):
    """Edits of the item against any part of the text (semi-global alignment over the whole matrix)."""
    codes = np.array([ord(c) for c in text], np.int64)
    row = np.zeros(len(text) + 1, np.int64)
    for i, c in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (codes != ord(c)), row[1:] + 1)
        steps = np.arange(len(new))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def edited(text, edits, rng):
    letters = list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters) or 1)
        if not letters:
            break
        kind = rng.randrange(3)
        if kind == 0:
            letters[at] = rng.choice("xyz")
        elif kind == 1:
            letters.insert(at, rng.choice("xyz "))
        else:
            del letters[at]
    return "".join(letters)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_items_with_edits(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcd é") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    setting = Settings(q=rng.choice((4, 7, 12)), edits=rng.choice((0.05, 0.1, 0.2)))
    items = [(i, prose(rng.randint(1, 30))) for i in range(4)]
    docs = [prose(rng.randint(0, 60)) for _ in range(6)]
    for n in range(4):
        cut = rng.randrange(len(docs[n]) + 1)
        docs[n] = docs[n][:cut] + edited(items[n][1], rng.randrange(6), rng).upper() + docs[n][cut:]
    docs.append(edited(items[0][1], 2, rng))
    index = Index(items, setting)
    found = {}
    for row, item, cost, start, end in index.search(pa.array(docs)):
        found[row, item] = min(cost, found.get((row, item), cost))
        assert fewest_edits(plain(docs[row][start:end]).strip(), "".join(map(chr, index.codes[item]))) <= cost
        assert 0 <= start <= end <= len(docs[row])
    for row, text in enumerate(docs):
        for item, codes in enumerate(index.codes):
            best = fewest_edits("".join(map(chr, codes)), plain(text))
            assert found.get((row, item)) == (best if best <= index.edits[item] else None)


def test_gram_hashes_depend_on_the_gram_alone():
    codes = np.frombuffer(("ab" * 20 + "xyz" * 9).encode("utf-32-le"), np.uint32)
    for q in range(1, 17):
        grams = decontaminate._grams(codes, q)
        assert len(grams) == len(codes) - q + 1
        same = {}
        for i, h in enumerate(grams.tolist()):
            assert same.setdefault(codes[i : i + q].tobytes(), h) == h
        assert len(set(same.values())) == len(same)


def test_null_empty_long_repeated_and_extra_columns(spark):
    item = "the quick brown fox jumps over the lazy dog"
    rows = [(1, None, 0), (2, "", 0), (3, f"so {item.upper()}\n", 0), (3, f"so {item.upper()}\n", 0), (4, "a" * 150_000, 0), (None, item, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits int")
    items = spark.createDataFrame([(7, item, 1), (8, None, 1), (9, "short", 1), (7, item, 1), (10, "a" * 300, 1)], "item_id int, text string, doc_id int")
    found = decontaminate.find(docs, items)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(3, 7, 0, 3, 46)] * 4 + [(4, 10, 0, 0, 300)] + [(None, 7, 0, 0, 43)] * 2, key=str)
    small = Settings(block_characters=50)
    assert sorted(map(tuple, decontaminate.find(docs, items, settings=small).collect()), key=str) == sorted(map(tuple, found.collect()), key=str)
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1, 2]
    assert decontaminate.find(docs, items.limit(0)).count() == 0
    assert decontaminate.find(docs.limit(0), items).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == 6


def test_query_over_the_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in op3_decontaminate(spark, sf_dir).collect()}
    want = {}
    for d in docs:
        text = plain(d["text"])
        for i in items:
            item = plain(i["text"]).strip()
            # A document without a piece of the item cannot hold it with few edits.
            pieces = 1 + int(0.05 * len(item))
            size = len(item) // pieces
            if any(item[p * size : p * size + size] in text for p in range(pieces)):
                best = fewest_edits(item, text)
                if best <= int(0.05 * len(item)):
                    want[d["doc_id"], i["item_id"]] = best
    assert found == want and found


def test_item_that_lost_its_middle_line(spark):
    lines = ["What did the keeper of the old lighthouse write into his book that night?", "He wrote that no ship had passed.", "Which of the four answers below is the one that he would have given himself?"]
    item = "\n".join(lines)
    texts = [f"some text before\n{lines[0]}\n{lines[2]}\nand some text after", item, lines[1], f"so {lines[0][:60]} x", item.replace("\n", "\n\n "), lines[2] + " and " + lines[0].upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, "short")], "item_id int, text string")
    found = {(r["doc_id"], r["item_id"]): (r["edits"], r["covered"]) for r in decontaminate.cover(docs, items).collect()}
    share = (len(lines[0]) + len(lines[2])) / len(item)
    assert found == {(0, 7): (None, share), (1, 7): (0, 1.0), (4, 7): (0, 1.0), (5, 7): (None, share)}
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()) == [2, 3]
    assert decontaminate.cover(docs, items.limit(0)).count() == 0


def test_windows_see_parts_within_lines():
    rng = random.Random(5)
    item = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(60))
    half = len(item) * 6 // 10
    pieces = decontaminate.Pieces([(1, item)], Settings())
    docs = [item[:half], "x " + item[-half:], item[: len(item) // 3], item[: half // 2] + " " + item[-half // 2 :], item]
    found = {row: covered for row, _, covered, _ in pieces.search(pa.array(docs))}
    assert sorted(found) == [0, 1, 3, 4] and found[4] == 1
    assert all(0.5 <= found[row] <= 0.62 for row in (0, 1, 3))


def test_every_length_has_its_edits():
    """Items of 1 to 60 characters, with as many edits as 5 % of them are, and with one more."""
    rng = random.Random(11)
    for length in range(1, 61):
        item = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(length))
        edits = int(0.05 * length)
        index = Index([(0, item)], Settings())
        assert index.edits.tolist() == [edits] and index.bound[0] >= 1
        for changed in range(edits + 2):
            # Changed characters as far apart as can be, so that the parts between are as short as can be.
            places = {length * (n + 1) // (changed + 1) for n in range(changed)}
            text = "0" * 30 + "".join("#" if i in places else c for i, c in enumerate(item)) + "1" * 30
            best = fewest_edits(item, text)
            found = [cost for *_, cost, _, _ in index.search(pa.array([text]))]
            assert (min(found) if found else None) == (best if best <= edits else None), (length, changed)


def brute_cover(items, docs, setting):
    """Covered characters of each item by each document, piece by piece with full alignments."""
    result = {}
    for n, item in enumerate(items):
        lines, at = [], 0
        for line in item.split("\n"):
            lines.append((at, at + len(line)))
            at += len(line) + 1
        last = len(item) - setting.window
        windows = [(a, a + setting.window) for a in (*range(0, last, setting.step), last) if a >= 0]
        for row, doc in enumerate(docs):
            held = np.zeros(len(item), bool)
            for a, b in [(0, len(item)), *lines, *windows]:
                part = item[a:b].replace("\n", " ")
                a, b = a + len(part) - len(part.lstrip()), b - (len(part) - len(part.rstrip()))
                part = part.strip()
                if (b - a == len(item) or b - a >= setting.q) and fewest_edits(part, plain(doc)) <= int(setting.edits * len(part)):
                    held[a:b] = True
            if held.sum() >= setting.covered * len(item):
                result[row, n] = held.sum() / len(item)
    return result


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6))
def test_coverage_in_parts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    setting = Settings(q=rng.choice((5, 8, 12)), window=24, step=6, covered=rng.choice((0.3, 0.5, 0.8)))
    items = ["\n".join(prose(rng.randint(1, 8)) for _ in range(rng.randint(1, 4))) for _ in range(4)]
    docs = [prose(rng.randint(0, 20))]
    for item in items:
        a = rng.randrange(len(item))
        docs += [prose(3) + " " + item[a:] + " " + prose(3), edited(item, rng.randrange(3), rng).upper(), item[: len(item) // 2] + prose(4)]
    pieces = decontaminate.Pieces(list(enumerate(items)), setting)
    found = {(row, item): share for row, item, share, _ in pieces.search(pa.array(docs))}
    assert found == brute_cover(items, docs, setting)


def test_cover_on_odd_rows_and_in_blocks(spark):
    item = "the quick brown fox jumps over the lazy dog"
    rows = [(1, None, 0), (2, "", 0), (3, f"so {item.upper()}\n", 0), (3, f"so {item.upper()}\n", 0), (4, "a" * 150_000 + "?", 0), (None, item, 0), (5, " \n\t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, covered int").selectExpr("*", "covered AS item_id", "text AS edits")
    kinds = "item_id int, text string, doc_id int"
    items = spark.createDataFrame([(7, item, 1), (8, None, 1), (9, "what?", 1), (7, item, 1), (10, "a" * 300, 1), (11, "a?", 1), (12, "", 1), (13, " \n", 1)], kinds)
    want = [(3, 7, 0, 3, 46, 1.0)] * 4 + [(None, 7, 0, 0, 43, 1.0)] * 2 + [(4, 10, 0, 0, 300, 1.0), (4, 11, 0, 149_999, 150_001, 1.0)]
    for setting in (Settings(), Settings(block_characters=50), Settings(block_characters=50, pass_characters=100)):
        found = decontaminate.cover(docs, items, settings=setting)
        assert found.columns == ["doc_id", "item_id", "edits", "start", "end", "covered"]
        assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
        kept = decontaminate.drop_contaminated(docs, items, settings=setting)
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5]
    long_only = Settings(shortest=12)
    assert not decontaminate.cover(docs, items.where("item_id = 11"), settings=long_only).count()
    assert decontaminate.cover(docs.limit(0), items).count() == decontaminate.cover(docs, items.limit(0)).count() == 0


def test_blocks_share_one_pass_over_the_documents(spark):
    docs = spark.createDataFrame([(n, f"document {n} about nothing") for n in range(50)], "doc_id long, text string")
    items = spark.createDataFrame([(n, f"benchmark item number {n} in words") for n in range(40)], "item_id long, text string")
    cut = list(decontaminate._passes(items, "item_id", "text", Settings(block_characters=100), 6))
    assert len(cut) == 1 and len(cut[0]) == 40 and sorted(i for block in cut[0] for i, _ in block) == list(range(40))
    plan = decontaminate.drop_contaminated(docs, items, settings=Settings(block_characters=100))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("MapInArrow") == 1
