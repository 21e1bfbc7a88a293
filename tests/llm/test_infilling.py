"""Fill-in-the-middle: every row against a plain rewrite of its text, and back again."""

import hashlib
import re

from tripmill.llm import infilling
from tripmill.llm.infilling import Settings


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    parts = ["".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None))]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text, text
    prefix, middle, suffix = parts
    sizes = len(prefix), len(middle)
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", *sizes, f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, len(units), "psm", *sizes, f"<P>{prefix}<S>{suffix}<M>{middle}", text


ROWS = [(i, f"Text {i}: ça va, naïve 日本語 😀\n\ttabs<P <S<M> >" [: 5 + i % 40]) for i in range(120)]
ROWS += [(200 + i, x) for i, x in enumerate(["", None, "<P>", "a<S>b", "x<M>", "<", "<S", "a", "\n", "\x00", "ÿ", "ab" * 3000, "é" * 3000])]
ROWS += [(300 + i, "one two, three <P >\n" * 400) for i in range(12)]
ROWS += [(None, "no id"), (None, "no id either"), (7, "another text of seven"), (7, "another text of seven")]


def test_rows_equal_a_plain_rewrite_in_any_block_size(spark):
    docs = spark.createDataFrame([(*r, "a", 1) for r in ROWS], "doc_id long, text string, form string, n int")
    expected = sorted((brute(*r) for r in ROWS), key=str)
    for size in (1 << 20, 300, 7):
        found = infilling.rewrite(docs.repartition(3), settings=Settings(block_bytes=size))
        rows = found.select("*", infilling.restore()).collect()
        assert sorted((tuple(r) for r in rows), key=str) == expected
    assert {r[2] for r in expected} == {"plain", "psm", "spm"}


def test_empty_table_and_other_names(spark):
    empty = spark.createDataFrame([], "key string, body string, _id int, _text int")
    found = infilling.rewrite(empty, "key", "body")
    assert found.count() == 0 and found.columns == ["key", "n", "form", "prefix_chars", "middle_chars", "output"]
    one = spark.createDataFrame([("k", "some words", 1, 2)], "key string, body string, _id int, _text int")
    assert [tuple(r) for r in infilling.rewrite(one, "key", "body").collect()] == [brute("k", "some words")[:6]]
