"""Quality by held-out accuracy, shrinkage by hand, and odd input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import quality
from tripmill.llm.queries import op1_quality
from tripmill.llm.quality import Settings
from tripmill.llm.toxicity import held_out


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = op1_quality(spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labelled = rows.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where(held_out())
    seen = {(r["quality"], r["kept"]): r["count"] for r in labelled.groupBy("quality", "kept").count().collect()}
    good, bad = seen.get((1, True), 0), seen.get((0, False), 0)
    assert good / (good + seen.get((1, False), 0)) > 0.95
    assert bad / (bad + seen.get((0, True), 0)) > 0.5


def test_posteriors_by_hand(spark):
    rows = [(i, f"h{i % 3}", f"p{i % 5}", "Some words, and more. " * (1 + i % 4) if i % 4 else "%%% ||| ###" * (i % 6)) for i in range(300)]
    rows += [(1000, "rare", "x", "Some words here."), (1001, None, None, None), (1001, None, None, None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, source string, lang string, text string, p double")
    labels = docs.where("doc_id < 200").select("doc_id", F.when(F.col("text").contains("words"), 1).otherwise(0).alias("quality"))
    found = quality.judge(docs, labels, settings=Settings(salts=3)).collect()
    assert len(found) == len(rows)
    described = quality.with_properties(docs, [F.col("doc_id")])
    model = quality.train(described, labels)
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    p = [sigmoid(r["evidence"] + model.prior) for r in found]
    mean = sum(p) / len(p)

    def groups(key):
        out = {}
        for r, x in zip(found, p):
            n, t = out.get(key(r), (0, 0.0))
            out[key(r)] = n + 1, t + x
        return out

    hosts, paths = groups(lambda r: r["host"]), groups(lambda r: (r["host"], r["path"]))

    def strength(sites):
        spread = sum(n * (t / n - q) ** 2 for n, t, q in sites)
        between = spread - sum(q * (1 - q) for _, _, q in sites)
        binomial = sum(n * q * (1 - q) for n, _, q in sites)
        return 1e6 if between <= 0 else min(1e6, max(2.0, binomial / between - 1))

    a = strength([(n, t, mean) for n, t in hosts.values()])
    share = {h: (t + a * mean) / (n + a) for h, (n, t) in hosts.items()}
    b = strength([(n, t, share[h]) for (h, _), (n, t) in paths.items()])
    for r, x in zip(found, p):
        n, t = hosts[r["host"]]
        parent = (t - x + a * mean) / (n - 1 + a)
        n, t = paths[r["host"], r["path"]]
        prior = (t - x + b * parent) / (n - 1 + b)
        assert r["site_prior"] == pytest.approx(prior, abs=1e-9)
        assert r["score"] == pytest.approx(sigmoid(r["evidence"] + math.log(prior / (1 - prior))), abs=1e-9)
        assert r["kept"] == (r["score"] >= 0.5)
    assert {r["host"] for r in found} == {"h0", "h1", "h2", "rare", ""}


def test_properties():
    values = dict(zip(quality.FEATURES, quality.properties(b"Ab 1,\n|%b b")))
    assert values["letters"] == pytest.approx(3 / 11) and values["upper"] == values["bars"] == pytest.approx(1 / 11)
    assert np.isfinite(quality.properties(b"x" * 200_000)).all() and quality.properties(b"") == [0.0] * len(quality.FEATURES)


def test_without_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "s", "l"), (2, None, "s", None)], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert {r["score"] for r in quality.judge(docs, labels).collect()} == {0.5}
    assert quality.judge(docs.limit(0), labels).count() == 0
