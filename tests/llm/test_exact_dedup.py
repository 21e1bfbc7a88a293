"""Exact duplicates: codes by round trip, groups by brute force."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import exact_dedup
from tripmill.llm.exact_dedup import Settings


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**48 - 1) | st.integers(0, 50), max_size=60))
def test_golomb_round_trip(values):
    values = np.array(sorted(values), np.int64)
    shift, code = exact_dedup.golomb_encode(values, 2**48)
    assert exact_dedup.golomb_decode(code, len(values), shift).tolist() == values.tolist()


def test_golomb_is_near_the_bound():
    values = np.unique(np.random.default_rng(1).integers(0, 2**40, 10_000))
    _, code = exact_dedup.golomb_encode(values, 2**40)
    assert 8 * len(code) / len(values) < np.log2(2**40 / len(values)) + 2


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for d, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((d, keep, len(ids), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4]).hex()) for r in df.collect()), key=str)


ROWS = [(i, f"text {i % 37}" if i % 3 else f"own {i}") for i in range(400)]
ROWS += [(1000, None), (1001, ""), (1002, "x" * 200_000), (1003, "x" * 200_000), (7, "text 7"), (None, "text 1"), (None, "lone")]


def test_groups_with_few_bits_small_senders_and_extra_columns(spark):
    docs = spark.createDataFrame([(*r, "a", 1) for r in ROWS], "doc_id long, text string, keep_id string, rank int")
    for bits, sender_rows, owner_rows in ((48, 50_000, 1_000_000), (4, 7, 20), (16, 1, 1_000)):
        small = Settings(bits=bits, sender_rows=sender_rows, owner_rows=owner_rows, root=0)
        assert result(exact_dedup.exact_duplicates(docs.repartition(5), settings=small)) == brute(ROWS)
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_a_third_of_the_rows_without_an_id(spark):
    rows = [(None if i % 3 == 0 else i, f"text {i % 50}" if i % 2 else f"own {i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(exact_dedup.exact_duplicates(docs, settings=Settings(bits=12, sender_rows=40, owner_rows=90, root=0))) == brute(rows)
    assert result(exact_dedup.exact_duplicates(docs)) == brute(rows)


def test_messages_grow_with_the_rows_and_not_with_their_square():
    chosen = Settings()
    for rows in (10**6, 10**8, 10**9, 10**10, 10**11):
        senders, owners = -(-rows // chosen.sender_size(rows)), chosen.owners(rows)
        assert senders * owners <= max(100, rows / 300)
        assert chosen.sender_size(rows) <= max(50_000, 20 * rows**0.5)


def test_small_parts_become_few_senders(spark):
    """Rows in very many parts: a sender takes several, a large part is several senders, and no row is lost."""
    hashed = spark.range(0, 5000, 1, 400).selectExpr("id AS doc_id", "id * 7 AS fp", "unhex(sha2(string(id), 256)) AS digest")
    for sender_rows, most in ((100, 150), (1000, 16)):
        sent = exact_dedup._send(hashed, 5000, Settings(sender_rows=sender_rows, owner_rows=10_000, root=1)).cache()
        assert sent.where("rank is not null").count() == 5000
        assert 5000 / sender_rows / 2 <= sent.select("sender").distinct().count() <= most
        sent.unpersist()
