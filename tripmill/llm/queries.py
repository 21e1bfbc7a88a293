"""One query per operator of this subpackage, over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripmill.llm import bpe, chunk_dedup, collocations, decontaminate, exact_dedup, infilling, licenses, line_dedup
from tripmill.llm import quality, secrets, simhash, toxicity, url_filter
from tripmill.llm.common import checkpointed, read

# The rules that pages are judged by.
URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan(read(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["word"])
    base_labels = F.transform(base, lambda p: p["label"])
    all_labels = F.concat(F.transform("places", lambda p: p["label"]), "expression_labels")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(all_labels).alias("labels"),
        "score",
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.cover(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), bpe.public_vocabulary())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = checkpointed(simhash.fingerprints(read(spark, sf_dir, "documents")))
    found = simhash.near_duplicates(prints)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.duplicate_lines(read(spark, sf_dir, "documents"), settings=line_dedup.Settings(characters=True))


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_spans(read(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op11_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infilling.rewrite(read(spark, sf_dir, "documents"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha(F.col("output")).alias("output_sha256"),
        sha(infilling.restore()).alias("restored_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_quality": op1_quality,
        "op2_licenses": op2_licenses,
        "op3_decontaminate": op3_decontaminate,
        "op4_bpe": op4_bpe,
        "op5_toxicity": op5_toxicity,
        "op6_simhash": op6_simhash,
        "op7_line_dedup": op7_line_dedup,
        "op8_chunk_dedup": op8_chunk_dedup,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_url_filter": op10_url_filter,
        "op11_infilling": op11_infilling,
        "op12_collocations": op12_collocations,
        "op13_secrets": op13_secrets,
        "pipeline": corpus_pipeline.run,
    }
