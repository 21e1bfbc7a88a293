"""Licence scan: notice phrases and identifier tags by Aho-Corasick, expressions by a shunting-yard parser.

One automaton holds all phrases as runs of words, so a text is read once however many phrases there are.
The identifier tag is one of these phrases; the licence expression behind it is taken from the original
text, as brackets and dots matter there, and is parsed with the precedence WITH, AND, OR.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripmill.llm.common import text_of

# Phrases and labels that every scan must report.
BASE_NOTICES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further phrases, in words as the scan sees them.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "cc by sa": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAG = "spdx license identifier"

# How freely a text under a licence may be used: 1 without conditions to speak of, 0 not at all.
FREEDOM = {
    "mit": 1.0,
    "apache-2": 1.0,
    "bsd": 1.0,
    "isc": 1.0,
    "public-domain": 1.0,
    "cc-by": 0.9,
    "mpl-2": 0.7,
    "lgpl": 0.6,
    "cc-by-sa": 0.5,
    "gpl-2": 0.4,
    "gpl-3": 0.4,
    "agpl-3": 0.3,
    "cc-by-nc": 0.1,
    "reserved": 0.0,
}
UNKNOWN_FREEDOM = 0.2

# Identifiers by how they begin; the longest that fits counts.
IDENTIFIERS = {
    "mit": "mit",
    "apache-2": "apache-2",
    "bsd-": "bsd",
    "0bsd": "bsd",
    "isc": "isc",
    "unlicense": "public-domain",
    "cc0-": "public-domain",
    "cc-by-": "cc-by",
    "cc-by-sa": "cc-by-sa",
    "cc-by-nc": "cc-by-nc",
    "mpl-2": "mpl-2",
    "lgpl-": "lgpl",
    "gpl-2": "gpl-2",
    "gpl-3": "gpl-3",
    "agpl-3": "agpl-3",
}

_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_BEFORE = re.compile(rb"[: \t\"'`]*")
# ASCII letters become lower case; all that is no part of a word becomes a space.
_WORDS = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)


def parse(expression: bytes, at: int = 0, end: int | None = None) -> list[str]:
    """Shunting-yard: the longest well-formed beginning of an expression in postfix order, in lower case.

    Reads ``expression`` from ``at`` to ``end``.

    Ends where an operand follows an operand or anything else follows that cannot. An operator without its
    right side is dropped and open brackets are closed. Nothing well-formed gives an empty list.
    """
    output: list[str] = []
    stack: list[str] = []
    operand, end = True, len(expression) if end is None else end
    while found := _TOKEN.match(expression, at, end):
        token = found[1].decode().lower().rstrip(".:")
        if operand:
            if token in _PRECEDENCE or token == ")":
                break
            if token == "(":
                stack.append(token)
            else:
                output.append(token)
                operand = False
        elif token == ")":
            if "(" not in stack:
                break
            while (top := stack.pop()) != "(":
                output.append(top)
        elif token in _PRECEDENCE:
            # WITH takes the licence just before it; all operators group to the left.
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[token]:
                output.append(stack.pop())
            stack.append(token)
            operand = True
        else:
            break
        at = found.end()
    while operand and stack:
        # What waits for a right side: brackets and one operator.
        if stack.pop() != "(":
            break
    output += [x for x in reversed(stack) if x != "("]
    return output


@dataclass(frozen=True)
class Terms:
    labels: frozenset[str]
    freedom: float


def licence(identifier: str) -> Terms:
    fits = [k for k in IDENTIFIERS if identifier.startswith(k)]
    label = IDENTIFIERS[max(fits, key=len)] if fits else identifier
    return Terms(frozenset([label]), FREEDOM.get(label, UNKNOWN_FREEDOM))


def evaluate(postfix: list[str]) -> Terms | None:
    """Labels of all licences; the freest choice of OR, the strictest part of AND; WITH lifts half of the limits."""
    stack: list[tuple[set[str], float] | str] = []
    for i, token in enumerate(postfix):
        if token not in _PRECEDENCE:
            # The exception of a WITH is no licence: it stands just before its operator.
            if postfix[i + 1 : i + 2] == ["with"] and stack:
                stack.append(token)
            else:
                terms = licence(token)
                stack.append((set(terms.labels), terms.freedom))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with" or isinstance(right, str):
            stack.append((left[0], (1 + left[1]) / 2))
        else:
            # The smaller set goes into the larger one, so that long chains stay cheap.
            small, large = sorted((left[0], right[0]), key=len)
            large |= small
            stack.append((large, (max if token == "or" else min)(left[1], right[1])))
    return Terms(frozenset(stack[0][0]), stack[0][1]) if stack and not isinstance(stack[0], str) else None


class Scanner:
    def __init__(self, base: Mapping[str, str], notices: Mapping[str, str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        entries = {k: (v, False) for k, v in notices.items()} | {k: (v, True) for k, v in base.items()}
        for phrase, (label, is_base) in entries.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, label, is_base))
        self.automaton.add_word(f" {TAG} ", (len(TAG) + 2, None, False))
        self.automaton.make_automaton()
        self.tag_words = len(TAG.split())

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, str, bool]], list[str], float]:
        """Number of words; places (word, label, base); labels of expressions; freedom of all together."""
        mapped = raw.translate(_WORDS)
        words = mapped.split()
        # One byte is one character here, so that positions stay simple.
        text = f" {b' '.join(words).decode('latin-1')} "
        hits = [(end + 1 - length, label, is_base) for end, (length, label, is_base) in self.automaton.iter(text)]
        if not hits:
            return len(words), [], [], 0.0
        # A hit begins at the space before its first word.
        spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 0x20)
        at = np.searchsorted(spaces, [start for start, _, _ in hits]).tolist()
        places, tags, labels, freedom = [], [], [], []
        for word, (_, label, is_base) in zip(at, hits):
            if label is None:
                tags.append(word)
            else:
                places.append((word, label, is_base))
                freedom.append(FREEDOM.get(label, UNKNOWN_FREEDOM))
        for begin, stop in self._behind(raw, mapped, tags):
            if terms := evaluate(parse(raw, begin, stop)):
                labels += terms.labels
                freedom.append(terms.freedom)
        return len(words), sorted(places), sorted(set(labels)), min(freedom, default=0.0)

    def _behind(self, raw: bytes, mapped: bytes, tags: list[int]) -> Iterator[tuple[int, int]]:
        """Of each tag, the place behind it, without the colon, and the end of its line or the next tag, if that is nearer.

        ``tags`` has the first words of the tags in order; the parts do not overlap, so all are read once.
        """
        if not tags:
            return
        inside = np.frombuffer(mapped, np.uint8) != 0x20
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        following = [*starts[tags[1:]].tolist(), len(raw)]
        for word, limit in zip(tags, following):
            begin = int(ends[word + self.tag_words - 1])
            feed = raw.find(b"\n", begin, limit)
            yield _BEFORE.match(raw, begin).end(), limit if feed < 0 else feed


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    base: Mapping[str, str] = BASE_NOTICES,
    notices: Mapping[str, str] = NOTICES,
) -> DataFrame:
    """Scan whole texts in place; nothing is shuffled.

    Per input row: the id, ``n_words``, ``places`` (word, label, base) of all phrases in order of words,
    ``expression_labels``, and ``score``: how freely the text may be used, as the strictest of all notices
    and expressions says, and 0 where nothing is found. An expression ends with its line or before the next tag. Null and empty texts have no words. Repeated rows
    are scanned each; other columns are not read.
    """
    source = docs.select(docs[doc_id].alias(doc_id), text_of(text).cast("binary").alias("_text"))
    place = T.StructType(
        [T.StructField("word", T.LongType()), T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType())]
    )
    schema = T.StructType(
        [
            source.schema[doc_id],
            T.StructField("n_words", T.LongType()),
            T.StructField("places", T.ArrayType(place)),
            T.StructField("expression_labels", T.ArrayType(T.StringType())),
            T.StructField("score", T.DoubleType()),
        ]
    )
    kinds = [
        pa.int64(),
        pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string()), ("base", pa.bool_())])),
        pa.list_(pa.string()),
        pa.float64(),
    ]
    base, notices = dict(base), dict(notices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for batch in batches:
            found = [scanner.scan(x.as_py()) for x in batch.column(1)]
            named = [(n, [{"word": w, "label": k, "base": b} for w, k, b in p], e, s) for n, p, e, s in found]
            columns = [pa.array([row[i] for row in named], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return source.mapInArrow(run, schema)
