"""Encoding against the tokenizers library, and the exact round trip."""

import hashlib

import public_tokenizers as P
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripmill.llm import bpe
from tripmill.llm.queries import op4_bpe

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
MODEL = bpe.vocabulary(PATH)


def encode(text):
    ids, counts = MODEL.encode([text])
    assert counts.tolist() == [len(ids)]
    return ids.tolist()


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text() | st.text(st.characters(max_codepoint=0x2FF)) | st.text("aabt<|>endofx' .\n9é", max_size=60))
@example("<|endoftext|>aaaaaaa<|startoftext|> it's we'll'S 123 ½²")
@example("İstanbul \x1c\x1d\x85\xa0 ǅ ŉ ʰ")
@example("ΑΣ ΟΔΟΣ é Å 漢字 👍🏽 ​　x")
def test_any_text(text):
    ids = encode(text)
    assert ids == expected(text)
    assert MODEL.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_every_character_below_the_plain_limit():
    for code in range(0x300):
        for text in (chr(code), f"a{chr(code)}b", f"1{chr(code)}{chr(code)}."):
            assert encode(text) == expected(text), hex(code)


def test_very_long_word_and_small_cache(monkeypatch):
    text = "the" * 3000 + " " + "ab" * 5000
    assert encode(text) == expected(text)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    for text in ("one two three four five", "six seven one two", "eight"):
        assert encode(text) == expected(text)


def test_fresh_model():
    for texts in (["a"], ["one two", "", "two three, it's"], ["x y z " * 400, "<|endoftext|> one"]):
        ids, counts = bpe.WordBpe(PATH).encode(texts)
        assert ids.tolist() == [i for t in texts for i in expected(t)] and counts.tolist() == [len(expected(t)) for t in texts]


def test_null_empty_repeated_extra_columns(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello, World", "x"), (3, "Hello, World", "x"), (None, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = sorted(map(tuple, bpe.encode(docs, PATH).collect()), key=str)
    hello = expected("Hello, World")
    assert found == sorted([(1, [], ""), (2, [], ""), (3, hello, LIBRARY.decode(hello)), (3, hello, LIBRARY.decode(hello)), (None, expected("a"), "a</w>")], key=str)
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    again = bpe.decode(bpe.encode(docs, PATH, decoded=False), PATH)
    assert sorted(r["decoded"] for r in again.collect()) == sorted(r[2] for r in found)


def test_query_over_the_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op4_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = expected(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
