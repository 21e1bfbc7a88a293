"""The pipeline against brute force, stage by stage, and on odd rows."""

import hashlib

import pyarrow as pa
import test_decontaminate
import test_line_dedup
import test_simhash
from test_bpe import LIBRARY, expected

import corpus_pipeline
from tripmill.llm import toxicity
from tripmill.llm.line_dedup import Settings
from tripmill.llm.queries import queries

SF_DIR = "/root/testdata/sf0.001"


def holds(item, text):
    """Whether the item stands in the text with few edits; a part of it must stand there without."""
    item, text = test_decontaminate.plain(item).strip(), test_decontaminate.plain(text)
    k = int(0.05 * len(item))
    size = len(item) // (k + 1)
    parts = (item[p * size : p * size + size] for p in range(k + 1))
    return any(p in text for p in parts) and test_decontaminate.fewest_edits(item, text) <= k


def test_run_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = toxicity.train(table, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    scores = model.scores(pa.array([t for _, t in rows]))
    rows = [r for r, s in zip(rows, scores) if s < 0.5]
    gone = {(d, n) for d, n, _ in test_line_dedup.brute(rows, Settings(characters=True, shortest_equal=20))}
    rows = [(d, "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone)) for d, t in rows]
    smallest = test_simhash.brute_components([(d, test_simhash.brute_print(t)) for d, t in rows])
    rows = [(d, t) for d, t in rows if smallest[d] == d]
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = [(d, t) for d, t in rows if not any(holds(i, t) for i in items)]
    want = {}
    for d, t in rows:
        ids = expected(t)
        digests = [" ".join(map(str, ids)), LIBRARY.decode(ids, skip_special_tokens=False)]
        want[d] = (len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in digests])
    found = queries()["pipeline"](spark, SF_DIR).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == want and len(found) == len(want)


def test_stages_keep_columns_and_survive_odd_rows(spark):
    line = "one line that is long enough to count"
    rows = [(1, None, "en", "s", 0), (2, "", "en", None, 0), (3, line, None, "s", 1), (3, line, None, "s", 1)]
    rows += [(4, line + "\nand more text here to stay", "en", "s", None), (None, "no id here", "en", "s", 3), (5, "w " * 60_000, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    wide = docs.selectExpr("*", "n_chars AS score", "lang AS fingerprint", "text AS line", "doc_id AS h", "lang AS _lines")
    for start in (docs, wide, docs.limit(0)):
        current = start
        for name, function in corpus_pipeline.STAGES:
            result = function(spark, current, SF_DIR)
            if name != "bpe":
                assert result.columns == start.columns and result.dtypes == start.dtypes, name
                current = result
        ids = sorted((r["doc_id"] or 0) for r in result.collect())
        # Documents 2 and 3 and the row without an id stay; 1 is the first of the empty ones.
        assert ids == ([] if start.isEmpty() else [0, 1, 3, 3, 4, 5])


def test_stage_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]
