"""Collocations against plain counting, with thresholds that cut deep and blocks of few bytes."""

import random
import re
import string
from collections import Counter

import numpy as np
import pytest

from tripmill.llm import collocations
from tripmill.llm.collocations import Settings

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, s):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, s.longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    out = {}
    frequent = {x: f for x, f in counts.items() if f >= s.least}
    for (lang, p), a in frequent.items():
        if len(p) < 2:
            continue
        cuts = [(s.scale * a // (counts[lang, p[:j]] + counts[lang, p[j:]]), j) for j in range(1, len(p))]
        score, j = min(cuts)
        longer = [
            f
            for (other, q), f in frequent.items()
            if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        ]
        if any(100 * f >= s.covered * a for f in longer):
            continue
        row = (-score, -a, " ".join(p).encode(), counts[lang, p[:j]], counts[lang, p[j:]])
        out.setdefault(lang, []).append(row)
    found = []
    for lang, listed in out.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(listed)[: s.best], 1):
            found.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def corpus(seed):
    """Frequent and rare words, fixed phrases inside them, and phrases that nearly always stand in longer ones."""
    rng = random.Random(seed)
    common = ["the", "of", "A", "und", "é", "x\x00y", "日本", "-", "The"]
    rare = [f"w{i}" for i in range(40)]
    fixed = ["united states of America", "the foo bar", "state of the art", "new york", "Department of the Interior", "w1 w2 w3", "a b a b"]
    rows = []
    for _ in range(220):
        parts = [rng.choice(common) if rng.random() < 0.5 else rng.choice(fixed) if rng.random() < 0.4 else rng.choice(rare) for _ in range(rng.randint(0, 40))]
        marks = [rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " "]) for _ in parts]
        rows.append((rng.choice(["en", "en", "de", None]), "".join(x + y for x, y in zip(parts, marks))))
    rows += [("en", None), (None, ""), ("de", " .,\n "), ("fr", "one two")] + [("en", "copy of a copied text. the foo bar")] * 30
    rows += [("de", "la la la la la la " * 300 + "; " + "ta tum " * 200)]
    return rows


@pytest.mark.parametrize(
    ("seed", "settings"),
    [
        (1, Settings(least=3, best=8, block_bytes=100, step=1)),
        (2, Settings(least=2, best=40, block_bytes=5000, filter_log_bits=16, salts=3)),
        (3, Settings(least=4, best=3, covered=60)),
        (4, Settings(least=3, best=2000)),
        (5, Settings(least=3, best=5, longest=3)),
    ],
)
def test_equals_plain_counting(spark, seed, settings):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "lang string, text string, f int, phrase string").repartition(3)
    found = collocations.collocations(docs, settings=settings)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, settings)


def test_growth_leaves_out_what_cannot_matter(spark, monkeypatch):
    grown = []
    inner = collocations._grown

    def watched(texts, size, wanted, asked, *rest):
        grown.append((size, wanted.count()))
        return inner(texts, size, wanted, asked, *rest)

    monkeypatch.setattr(collocations, "_grown", watched)
    rows = corpus(6)
    docs = spark.createDataFrame(rows, "lang string, text string")
    tight, loose = Settings(least=3, best=2), Settings(least=3, best=2000)
    assert sorted(tuple(r) for r in collocations.collocations(docs, settings=tight).collect()) == brute(rows, tight)
    few = sum(n for _, n in grown)
    grown.clear()
    collocations.collocations(docs, settings=loose)
    assert 0 < few < sum(n for _, n in grown) / 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).collect() == []
    blank = spark.createDataFrame([("en", None), (None, " .. ")], "lang string, text string")
    assert collocations.collocations(blank).collect() == []


def test_filter_holds_its_keys_in_few_bits(spark):
    keys = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 5000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "key bigint")
    small, large = collocations.build_filter(frame, 12), collocations.build_filter(frame, 26)
    other = np.random.default_rng(4).integers(-(2**63), 2**63 - 1, 5000).view(np.uint64)
    assert small.holds(keys.view(np.uint64)).all() and large.holds(keys.view(np.uint64)).all()
    assert len(small.words) == 64 and large.holds(other).mean() < 0.05
