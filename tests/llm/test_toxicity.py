"""The classifier by held-out accuracy, its features by brute force, and odd input."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill.llm import toxicity
from tripmill.llm.queries import op5_toxicity


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=12) | st.text("abé漢", max_size=30), min_size=1, max_size=5))
def test_buckets_are_the_distinct_grams(texts):
    def bucket(gram):
        value = 2166136261
        for c in gram:
            value = (value ^ ord(c)) * 16777619 % 2**32
        return (value * 0x9E3779B1 % 2**32) >> 22

    found = list(toxicity.present_buckets(pa.array(texts), (2, 3), 10))
    assert len(found) == len(texts)
    for text, buckets in zip(texts, found):
        padded = f" {pc.utf8_lower(pa.scalar(text)).as_py()} "
        want = {bucket(padded[i : i + n]) for n in (2, 3) for i in range(len(padded) - n + 1)}
        assert len(buckets) == len(want) and set(buckets.tolist()) == want


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = op5_toxicity(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    seen = Counter((r["toxic"], r["predicted"]) for r in rows if r["held_out"] and r["toxic"] is not None)
    assert seen[0, 1] <= 0.005 * (seen[0, 0] + seen[0, 1])
    assert seen[1, 1] >= 0.75 * (seen[1, 0] + seen[1, 1])


def test_one_class_no_labels_and_odd_rows(spark):
    rows = [(1, None, "x", 0.5), (2, "", "y", 0.5), (3, "a" * 100_000, "z", 0.5), (3, "a" * 100_000, "z", 0.5), (None, "b", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string, Score double")
    labels = spark.createDataFrame([(1, 0, 1), (2, None, 1), (None, 1, 1), (2, 0, 1), (2, 0, 1)], "doc_id long, toxic int, text int")
    for given_labels in (labels, labels.limit(0)):
        model = toxicity.train(docs, given_labels)
        scored = toxicity.score(docs, model)
        assert scored.columns == ["doc_id", "text", "toxic", "score"]
        assert scored.count() == 5 and scored.where("score < 0 or score > 0.5").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.keep_clean(docs, model, threshold=1.1).collect() == docs.collect()
    assert toxicity.keep_clean(docs, model, threshold=0.0).count() == 0


def test_nothing_but_text_counts(spark):
    texts = [(i, f"good words {i}" if i % 2 else f"bad idiot words {i}", f"src{i % 3}") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    labels = docs.select("doc_id", F.when(F.col("text").contains("idiot"), 1).otherwise(0).alias("toxic"))
    model = toxicity.train(docs, labels)
    scores = model.scores(pa.array(["some idiot here", "some friend here", ""]))
    assert scores[0] > 0.5 > scores[1] and scores[0] > scores[1] + 0.3
    # The order of rows and other columns make no difference.
    again = toxicity.train(docs.select("text", "doc_id").orderBy(F.desc("doc_id")), labels)
    assert np.allclose(again.scores(pa.array(["some idiot here"])), scores[:1], atol=1e-6)
