"""Byte-level BPE against the public library that reads the same file."""

import hashlib
import random

import numpy as np
import pytest
from helpers_llm import LONG, awkward, frame
from tokenizers import Tokenizer

from graphloom.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.MODEL)


def texts():
    rng = random.Random(5)
    parts = ["a", "b", "l", "'", "s", "re", " ", "  ", "\n", "\t", "<|endoftext|>", "1", "23", "é", "梦", "😀", "\xa0", "\x85", "\x1c",
             "the", "'ll", "'S", "!", "...", "́", "\x00", "\U00011390", "qz", "-", "　", "ing"]
    parts += [chr(rng.randrange(0x20, 0xD7FF)) for _ in range(30)] + [chr(rng.randrange(0xE000, 0x110000)) for _ in range(30)]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(4000)]
    return [*made, "a" * 3000, "ab" * 1500, "x" * 257, " " * 999 + "a", "the" * 400, "word qz " * 300]


def test_ids_and_texts_equal_the_librarys(library):
    encoder, data = bpe.Encoder(bpe.MODEL), texts()
    want = [e.ids for e in library.encode_batch(data, add_special_tokens=False)]
    assert [np.frombuffer(i, "<i4").tolist() for i in encoder.encode(data)] == want
    assert [encoder.decode(np.array(i, np.int64)) for i in want] == [library.decode(i, skip_special_tokens=False) for i in want]
    rng = random.Random(6)
    loose = [[rng.randrange(50_257) for _ in range(rng.randrange(8))] for _ in range(2000)]
    assert [encoder.decode(np.array(i, np.int64)) for i in loose] == [library.decode(i, skip_special_tokens=False) for i in loose]


def test_cuts_are_certain(library):
    """No token holds a byte pair at which fragments are cut."""
    encoder = bpe.Encoder(bpe.MODEL)
    tokens = [encoder.flat[p:p + w].tobytes() for p, w in zip(encoder.place, encoder.width, strict=True)]
    inside = {t[k:k + 2] for i, t in enumerate(tokens) if i not in encoder.specials.values() for k in range(len(t) - 1)}
    assert {bytes([a, b]) for a, b in np.argwhere(encoder.inside)} == inside


def test_parts_of_long_texts_and_full_caches(library, monkeypatch):
    monkeypatch.setattr(bpe, "TOGETHER", 64)
    monkeypatch.setattr(bpe, "CACHE", 20)
    encoder = bpe.Encoder(bpe.MODEL)
    data = [t * 3 for t in texts()[:400]] + [LONG[:5000]]
    want = [e.ids for e in library.encode_batch(data, add_special_tokens=False)]
    assert [np.frombuffer(i, "<i4").tolist() for i in encoder.encode(data)] == want


def test_round_trip_of_awkward_rows(spark, library):
    docs = frame(spark, awkward())
    got = bpe.round_trip(docs).collect()
    assert len(got) == docs.count() and all(r["exact"] for r in got)
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t, *_ in awkward()]
    want = sorted((str(i), len(n), hashlib.sha256(np.array(n, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                  for (i, t, *_), n in zip(awkward(), ids, strict=True))
    assert sorted((str(r["id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    again = bpe.decode(bpe.encode(docs)).collect()
    assert sorted((str(r["id"]), r["text"]) for r in again) == sorted((str(i), t or "") for i, t, *_ in awkward())
    assert bpe.encode(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 72, -1, 10**6]), (None, [50256])], "id long, ids array<int>")
    assert {r["id"]: r["text"] for r in bpe.decode(odd).collect()} == {1: "", 2: "", 3: library.decode([72]), None: "<|endoftext|>"}
