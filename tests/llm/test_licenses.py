"""Licence scan against regular expressions, and the expression parser on cases."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripmill.llm import licenses
from tripmill.llm.queries import op2_licenses

SCANNER = licenses.Scanner(licenses.BASE_NOTICES, licenses.NOTICES)
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    """Word count and (word, label) of base phrases, by comparing words at every place."""
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    places = []
    for phrase, label in licenses.BASE_NOTICES.items():
        want = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return len(words), sorted(places)


WORDS = st.sampled_from(
    ["Under", "the", "MIT", "License", "Apache", "Version", "2.0", "CC", "BY-NC", "by", "nc", "é", "\n", ",", "cc by nc cc"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(WORDS, max_size=25).map(" ".join) | st.text())
def test_base_places(text):
    n, places, _, score = SCANNER.scan(text.encode())
    assert (n, [(w, k) for w, k, is_base in places if is_base]) == brute(text)
    assert 0 <= score <= 1


@pytest.mark.parametrize(
    ("text", "labels", "freedom"),
    [
        ("MIT", {"mit"}, 1.0),
        ("MIT OR GPL-3.0-only", {"mit", "gpl-3"}, 1.0),
        ("MIT AND GPL-3.0-only", {"mit", "gpl-3"}, 0.4),
        ("MIT or GPL-2.0+ and CC-BY-NC-4.0", {"mit", "gpl-2", "cc-by-nc"}, 1.0),
        ("(MIT OR GPL-2.0) AND CC-BY-NC-4.0", {"mit", "gpl-2", "cc-by-nc"}, 0.1),
        ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl-2"}, 0.7),
        ("GPL-2.0-only WITH Classpath-exception-2.0 AND LGPL-2.1", {"gpl-2", "lgpl"}, 0.6),
        ("Apache-2.0 WITH LLVM-exception OR MIT", {"apache-2", "mit"}, 1.0),
        ("MIT some other words", {"mit"}, 1.0),
        ("((MIT AND Foo-1.0", {"mit", "foo-1.0"}, 0.2),
        ("MIT AND", {"mit"}, 1.0),
        ("MIT OR ISC AND (", {"mit", "isc"}, 1.0),
        ("MIT) OR ISC", {"mit"}, 1.0),
        ("AND MIT", None, None),
        ("()", None, None),
        ("", None, None),
    ],
)
def test_expressions(text, labels, freedom):
    terms = licenses.evaluate(licenses.parse(text.encode()))
    assert (terms and set(terms.labels), terms and terms.freedom) == (labels, freedom)


def test_tag_in_text():
    text = "x é\n# SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-3.0\nunder the MIT license"
    n, places, labels, score = SCANNER.scan(text.encode())
    assert labels == ["apache-2", "gpl-3", "mit"] and score == 0.4
    assert places == [(14, "mit", True)]


def test_null_empty_repeated_extra_columns(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "cc by nc", 3), (3, "cc by nc", 3), (None, "x " * 200_000 + "CC-BY-NC", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels long")
    found = licenses.scan(docs).collect()
    assert sorted((r["n_words"], len(r["places"])) for r in found) == [(0, 0), (0, 0), (3, 1), (3, 1), (200_003, 1)]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_query_over_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op2_licenses(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        n, places = brute(texts[row["doc_id"]])
        assert (row["n_words"], row["n_base"]) == (n, len(places))
        assert row["first_word"] == min((w for w, _ in places), default=None)
        assert row["last_word"] == max((w for w, _ in places), default=None)
        assert row["base_labels"] == ",".join(sorted({k for _, k in places}))
        assert set(row["base_labels"].split(",")) <= set(row["labels"].split(",")) | {""}
    assert any("gpl-3" in r["labels"] for r in rows)


def test_each_byte_behind_a_tag_is_parsed_once(monkeypatch):
    """Texts of many tags, in lines of their own or in one line, cost steps in proportion to their length."""
    steps = []

    class Counted:
        def match(self, text, at, end):
            steps.append(end - at)
            return inner.match(text, at, end)

    inner = licenses._TOKEN
    monkeypatch.setattr(licenses, "_TOKEN", Counted())
    for form in ("SPDX-License-Identifier: MIT\n", "SPDX-License-Identifier: MIT ", "SPDX-License-Identifier:MIT AND ", "spdx license identifier (MIT or GPL-2.0) "):
        counts = []
        for n in (500, 1000):
            steps.clear()
            _, _, labels, score = SCANNER.scan((form * n).encode())
            assert "mit" in labels and score == 1.0
            counts.append((len(steps), sum(steps)))
        assert counts[1][0] <= 2.1 * counts[0][0] and counts[1][1] <= 2.1 * counts[0][1], form


def test_long_texts():
    notices = "under the MIT license. " * 45_000
    n, places, labels, score = SCANNER.scan(notices.encode())
    assert n == 180_000 and [w for w, _, _ in places] == list(range(0, 180_000, 4)) and (labels, score) == ([], 1.0)
    chain = "SPDX-License-Identifier: " + " AND ".join(f"Own-{i}" for i in range(60_000))
    assert len(SCANNER.scan(chain.encode())[2]) == 60_000
    assert SCANNER.scan(b"SPDX-License-Identifier: \n MIT")[2] == []
    assert SCANNER.scan(b"SPDX-License-Identifier")[2] == []
    assert SCANNER.scan(b"SPDX-License-Identifier: `ISC` SPDX-License-Identifier: 'MIT'")[2] == ["isc", "mit"]
