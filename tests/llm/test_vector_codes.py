"""Vector codes against plain integer clustering in memory, and the bounds against exact distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from graphloom.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, id string, v string, codes string, error string, of string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[math.floor(4096 * x) for x in r[1]] for r in kept]
    width = len(ints[0]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for v in ints] for p in range(parts)]
    books = [list(vs[:entries]) for vs in cut]

    def nearest(book, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(books[p], v)[1] for v in cut[p]]
            for k in range(len(books[p])):
                mine = [v for v, c in zip(cut[p], of, strict=True) if c == k]
                if mine:
                    books[p][k] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    found = [[nearest(books[p], cut[p][i]) for p in range(parts)] for i in range(len(kept))]
    error = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for r, e in zip(kept, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], r[2], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]], digest) for r, f, e in zip(kept, found, error, strict=True)), key=str)


def result(df):
    assert df.columns == ["id", "label", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def some(seed, n, size=16, spread=1.0):
    rng = random.Random(seed)
    return [(i, [round(rng.gauss(rng.choice((-1, 0, 1)), 0.2) * spread, 3) for _ in range(size)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize(("n", "spread"), [(300, 1.0), (40, 1000.0), (5, 1.0), (1, 1.0)])
def test_against_plain_clustering(spark, n, spread):
    rows = some(n, n, spread=spread)
    assert result(vector_codes.compress(table(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    rows = some(3, 60)
    rows += [(100, None, 1), (101, [None] * 16, 1), (102, [float("nan")] * 16, 1), (103, [1.0] * 15 + [float("-inf")], None)]
    rows += [(None, [0.5] * 16, None), (7, rows[7][1], 1), (7, [0.25] * 16, 2), (8, [-0.0] * 16, 2)] + [(200 + i, [0.125] * 16, 1) for i in range(30)]
    random.Random(4).shuffle(rows)
    assert result(vector_codes.compress(table(spark, rows))) == brute(rows)
    alike = [(i, [0.5] * 8, None) for i in range(40)]
    assert result(vector_codes.compress(table(spark, alike))) == brute(alike)
    for none in ([], rows[60:60] + [(1, None, None)]):
        assert vector_codes.compress(table(spark, none)).count() == 0
    empty = [(i, [], 1) for i in range(3)]
    assert result(vector_codes.compress(table(spark, empty))) == brute(empty)
    for bad in ([(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], [(1, [0.0] * 9, 1)], [(1, [1e30] * 8, 1)]):
        with pytest.raises(ValueError):
            vector_codes.compress(table(spark, bad))


def test_other_shapes_and_vectors_from_codes(spark):
    rows = some(5, 80, size=12)
    for options in ({"parts": 4, "entries": 5, "rounds": 3}, {"parts": 2, "entries": 40, "rounds": 2}, {"parts": 3, "entries": 16, "rounds": 0}):
        assert result(vector_codes.compress(table(spark, rows), **options)) == brute(rows, **options)
    books, coded = vector_codes.fit_codes(table(spark, rows), parts=4, entries=5)
    vectors = {r["id"]: r["vector"] for r in vector_codes.approximate(coded, books).collect()}
    for r in coded.collect():
        ints = [math.floor(4096 * x) for x in rows[r["id"]][1]]
        assert r["error"] == sum((a - round(4096 * b)) ** 2 for a, b in zip(ints, vectors[r["id"]], strict=True))


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_while_entries_move(seed):
    rng = np.random.default_rng(seed)
    part, book = rng.integers(-50, 50, (400, 3)), rng.integers(-50, 50, (16, 3))
    b = 4
    held = vector_codes._closest(vector_codes._squares(part, book[None]), np.arange(16), b)
    compared = 0
    for _ in range(12):
        after = book + rng.integers(-3, 4, book.shape)
        drift = np.array([vector_codes._up(int(((x - y) ** 2).sum())) for x, y in zip(book, after, strict=True)])
        book, new_b = after, int(rng.integers(2, 9))
        held, need = vector_codes.reassign(part, book, drift, held, new_b)
        compared += (need > 0).sum()
        squares = vector_codes._squares(part, book[None])
        assert (held.code == squares.argmin(axis=1)).all()
        away = np.sqrt(squares)
        rows = np.arange(400)
        assert (held.up >= away[rows, held.code]).all()
        assert (held.low <= np.take_along_axis(away, held.near, 1)).all() and (np.diff(held.low, axis=1) >= 0).all()
        rest = away.copy()
        rest[rows, held.code] = np.inf
        np.put_along_axis(rest, held.near, np.inf, 1)
        assert (held.outer <= rest.min(axis=1)).all()
        assert (np.sort(np.concatenate((held.code[:, None], held.near), 1))[:, 1:] != np.sort(np.concatenate((held.code[:, None], held.near), 1))[:, :-1]).all()
    assert compared < 12 * 400  # some were certain
