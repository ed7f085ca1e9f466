"""License scan: an Aho-Corasick automaton finds identifier tags and notice phrases, and a shunting-yard
parser evaluates the licence expression behind each tag.

A text is reduced to its words joined by single spaces; phrases are padded with spaces, so a hit is a run of
whole words and its first word's number is the count of spaces before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import in_small_batches, row_batches

# Phrase -> label of the base scan.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Further notices -> label.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "licensed under the apache license": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
}
TAG = "spdx license identifier"
# How much a licence binds whoever reuses the text, from 0 (nothing) to 1 (no reuse).
BINDS = {
    "public-domain": 0.0, "cc0": 0.0, "unlicense": 0.0, "0bsd": 0.0,
    "mit": 0.1, "bsd": 0.1, "isc": 0.1, "apache": 0.15, "zlib": 0.1, "cc-by": 0.2,
    "mpl": 0.4, "lgpl": 0.5, "epl": 0.5, "cc-by-sa": 0.6, "gpl": 0.7, "agpl": 0.8,
    "cc-by-nc": 0.85, "cc-by-nd": 0.9, "reserved": 1.0,
}
UNKNOWN = 0.5
#: an exception after WITH loosens a copyleft licence by this much
EXCEPTION = 0.2

_LOWER_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TAG_IN_TEXT = re.compile(rb"spdx[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+license[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+identifier[ \t]*:?[ \t]*([^\r\n]*)", re.I)
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")
_RANK = {"or": 1, "and": 2, "with": 3}


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {**NOTICES, **BASE, TAG: ""}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def family(licence: str) -> str:
    """The known family a licence id belongs to: gpl-3.0-or-later -> gpl."""
    name = licence.lower()
    parts = name.split("-")
    for n in range(len(parts), 0, -1):
        if "-".join(parts[:n]) in BINDS:
            return "-".join(parts[:n])
    return name


def parse_expression(text: str) -> list[str]:
    """Reverse Polish form of the expression at the start of ``text``, by shunting-yard.

    Reading ends where no operand or operator can follow; an expression that breaks off gives what was whole.
    """
    out: list[str] = []
    operators: list[str] = []
    wants_operand, depth = True, 0
    for token in _TOKEN.findall(text):
        word = token.lower()
        if wants_operand:
            if token == "(":
                operators.append(token)
                depth += 1
            elif token == ")" or word in _RANK:
                break
            else:
                out.append(word)
                wants_operand = False
        elif word in _RANK:
            while operators and operators[-1] != "(" and _RANK[operators[-1]] >= _RANK[word]:
                out.append(operators.pop())
            operators.append(word)
            wants_operand = True
        elif token == ")" and depth:
            while operators[-1] != "(":
                out.append(operators.pop())
            operators.pop()
            depth -= 1
        else:
            break
    if wants_operand and operators and operators[-1] != "(":
        operators.pop()  # an operator without its second operand
    out += [op for op in reversed(operators) if op != "("]
    return out


def evaluate(rpn: list[str]) -> tuple[set[str], float]:
    """Licences named, and how much the expression binds: OR leaves the choice, AND takes both."""
    stack: list[tuple[set[str], float]] = []
    for token in rpn:
        if token not in _RANK:
            name = family(token)
            stack.append(({name}, BINDS.get(name, UNKNOWN)))
            continue
        if len(stack) < 2:
            break
        (right, r), (left, l) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left, max(0.0, l - EXCEPTION)))
        else:
            stack.append((left | right, min(l, r) if token == "or" else max(l, r)))
    return stack[-1] if stack else (set(), 0.0)


def scan(text: bytes) -> tuple:
    """(words, base places, first word, last word, base labels, labels, score, spans) of one text in UTF-8."""
    words = text.translate(_LOWER_WORDS).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    places, spans, labels, binds = [], [], set(), 0.0
    at, seen = 0, 0
    for end, phrase in _automaton().iter(line):
        start = end - len(phrase) - 1
        # hits come by their end; spaces are counted on from the last start, back where a longer phrase began earlier
        seen = seen + line.count(" ", at, start) if start >= at else seen - line.count(" ", start, at)
        at = start
        spans.append((phrase, seen, seen + phrase.count(" ") + 1))
        label = BASE.get(phrase) or NOTICES.get(phrase)
        if phrase in BASE:
            places.append((seen, label))
        if label:
            labels.add(label)
            binds = max(binds, BINDS[label])
    if any(phrase == TAG for phrase, *_ in spans):
        for tag in _TAG_IN_TEXT.finditer(text):
            named, bound = evaluate(parse_expression(tag[1].decode("utf-8", "replace")))
            labels |= named
            binds = max(binds, bound)
    base = {label for _, label in places}
    first = min((p for p, _ in places), default=None)
    last = max((p for p, _ in places), default=None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), binds, spans


_FIELDS = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("phrase", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))),
]


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in row_batches(batches):
        rows = [scan(t) for t in batch.column("text").to_pylist()]
        columns = list(zip(*rows, strict=True))
        spans = [[{"phrase": p, "start": s, "stop": e} for p, s, e in row] for row in columns[-1]]
        arrays = [pa.array(c, kind) for c, (_, kind) in zip([*columns[:-1], spans], _FIELDS, strict=True)]
        yield pa.record_batch([batch.column("id"), *arrays], names=["id", *[n for n, _ in _FIELDS]])


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Words are runs of digits, letters a-z (A-Z lowered) and non-ASCII characters.  ``spans`` lists every phrase
    found with its first word and the word after its last; overlapping phrases all count.  ``score`` is how much
    the strictest notice or tag binds reuse (0: none found).  A null text is an empty one: no words, empty
    labels, null places.  Texts of any length are read whole, one batch of rows in memory at a time; repeated
    rows, null ids and an empty table come through as they are; other columns play no part.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = (f"id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
              "labels string, score double, spans array<struct<phrase: string, start: bigint, stop: bigint>>")
    text = F.encode(F.coalesce(F.col(text_column).cast("string"), F.lit("")), "UTF-8")
    return in_small_batches(docs).select(F.col(id_column).alias("id"), text.alias("text")).mapInArrow(_scan_batches, schema)
