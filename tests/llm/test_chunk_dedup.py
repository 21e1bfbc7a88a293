"""Chunks by a rolling computation, spans by brute force, and planted passages."""

import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import chunk_dedup
from tripmill.llm.chunk_dedup import Settings
from tripmill.llm.queries import op8_chunk_dedup


def brute_cuts(raw, setting):
    ends, last, value = [], 0, 0
    for i, b in enumerate(raw):
        value = (value * 2 + int(chunk_dedup._GEAR[b])) % 2**16
        if value < 2**16 // setting.spacing and i + 1 - last >= setting.shortest:
            ends.append(i + 1)
            last = i + 1
    return ends + [len(raw)] * (last < len(raw))


def signed_hash(text):
    return int.from_bytes(xxhash.xxh64_digest(text.encode(), 42), "big", signed=True)


def brute_spans(rows, setting=Settings()):
    first, spans = {}, []
    keyed = {(d is not None, d or 0, signed_hash(t or "") if d is None else 0, t or "") for d, t in rows}
    for known, number, row, text in sorted(keyed):
        doc = (number if known else None, row)
        raw, last, run = text.encode(), 0, None
        for end in [*brute_cuts(raw, setting), None]:
            source = first.setdefault(raw[last:end], (doc, last)) if end is not None else (doc, last)
            if source == (doc, last):
                if run and run[2] >= setting.least_bytes:
                    spans.append((run[0][0], *run[1:4], run[4][0]))
                run = None
            elif run:
                run[2], run[3] = end - run[1], run[3] + 1
            else:
                run = [doc, last, end - last, 1, source[0]]
            last = end
    return sorted(spans, key=str)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=400), st.integers(1, 60), st.integers(1, 20))
def test_cuts(raw, spacing, shortest):
    setting = Settings(spacing=spacing, shortest=shortest)
    assert chunk_dedup.cuts(np.frombuffer(raw, np.uint8), setting).tolist() == brute_cuts(raw, setting)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijé") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_planted_passages_are_found_and_cut(spark):
    rng = random.Random(3)
    passages = [words(rng, 51) for _ in range(20)]
    rows = []
    for i in range(120):
        body = words(rng, rng.randint(0, 80))
        if i >= 60:
            cut = rng.randrange(len(body) + 1)
            body = body[:cut] + passages[i % 20] + body[cut:]
        rows.append((i, body))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, digest string")
    spans = chunk_dedup.repeated_spans(docs)
    found = sorted(map(tuple, spans.collect()), key=str)
    assert found == brute_spans(rows)
    # Repeats of a passage behind its first place are found, and nothing in the others.
    assert len({r[0] for r in found}) >= 39 and {r[0] for r in found} <= set(range(80, 120))
    left = {r["doc_id"]: r for r in chunk_dedup.without_spans(docs, spans).collect()}
    assert len(left) == 120 and left[0]["digest"] == "x"
    sizes = {d: sum(s[2] for s in found if s[0] == d) for d, _ in rows}
    for d, text in rows:
        lost = len(text.encode()) - len(left[d]["text"].encode())
        assert sizes[d] <= lost <= sizes[d] + 3


def test_null_empty_long_repeated_and_extra_columns(spark):
    rng = random.Random(5)
    long = words(rng, 20_000)
    rows = [(1, None), (2, ""), (3, long), (4, "x " + long), (4, "x " + long), (None, long), (5, "ab" * 3000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    found = sorted(map(tuple, chunk_dedup.repeated_spans(docs).collect()), key=str)
    assert found == brute_spans(rows) and {r[0] for r in found} == {3, 4}
    assert chunk_dedup.repeated_spans(docs.limit(0)).count() == 0
    assert chunk_dedup.without_spans(docs, chunk_dedup.repeated_spans(docs)).count() == len(rows)


def test_rows_without_an_id_are_compared_and_cut(spark):
    rng = random.Random(6)
    passages = [words(rng, 60) for _ in range(4)]
    rows = [(None, f"{words(rng, 20)} {passages[i % 4]} {words(rng, 20)}") for i in range(40)] + [(1, passages[0]), (2, passages[3])]
    rows += [rows[0]] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = chunk_dedup.repeated_places(docs)
    found = sorted(map(tuple, spans.drop("row").collect()), key=str)
    assert found == brute_spans(rows) and sum(r[0] is None for r in found) >= 36
    left = chunk_dedup.without_spans(docs, spans)
    gone = sum(r[2] for r in found) + 3 * sum(r["size"] for r in spans.collect() if r["row"] == signed_hash(rows[0][1]))
    assert left.count() == len(rows)
    lost = sum(len(t.encode()) for _, t in rows) - sum(len(r["text"].encode()) for r in left.collect())
    assert gone <= lost <= gone + 3 * len(rows)


def test_query_over_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = sorted(map(tuple, op8_chunk_dedup(spark, sf_dir).collect()), key=str)
    assert found == brute_spans(rows)
