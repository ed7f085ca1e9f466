"""Exact dedup, substring dedup and the similarity join against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from helpers_llm import awkward, frame, rows, words

from graphloom.llm import exact_dedup, ngram_join, substring_dedup

BLANK = re.compile(r"[\x20\x09-\x0D]")


def saved(spark, tmp_path, data):
    """Operators that tell rows apart by their place read tables from files."""
    path = str(tmp_path / "docs")
    frame(spark, data).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def check_exact(got, data):
    groups = {}
    for i, t, *_ in data:
        groups.setdefault(BLANK.sub("", t or ""), []).append((i, len(t or "")))
    assert len(got) == len(data)
    for body, members in groups.items():
        found = [r for r in got if r["text_sha256"] == hashlib.sha256(body.encode()).hexdigest()]
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        assert len(found) == len(members)
        assert all(r["keep_id"] == best and r["group_size"] == len(members) for r in found)
        assert [r["id"] for r in found if r["kept"]] == [best]


def test_exact_groups_with_awkward_rows(spark, tmp_path):
    docs = saved(spark, tmp_path, awkward())
    check_exact(exact_dedup.exact_duplicates(docs).collect(), awkward())
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({BLANK.sub("", r[1] or "") for r in awkward()})


def test_exact_hot_group_and_shared_prefixes(spark, tmp_path):
    base = " ".join(words(1, 300))
    data = rows([(i, base, "en") for i in range(150)] + [(1000 + i, base + f" {i % 40}", "en") for i in range(150)]
                + [(2000 + i, base[:10 + i], "en") for i in range(60)] + [(3000, "", "en"), (3001, None, "en")])
    check_exact(exact_dedup.exact_duplicates(saved(spark, tmp_path, data)).collect(), data)


def test_exact_empty_table(spark, tmp_path):
    assert exact_dedup.exact_duplicates(saved(spark, tmp_path, [])).count() == 0
    assert exact_dedup.drop_duplicates(saved(spark, tmp_path / "b", [])).count() == 0


@pytest.mark.parametrize("texts", [[b"", b"", b"a"], [b"x" * 16, b"x" * 16, b"x" * 17], [b"y" * 5000, b"y" * 5000, b"y" * 5001]])
def test_radix_groups(texts):
    got = sorted(sorted(g) for g in exact_dedup.radix_groups(texts))
    assert got == [[0, 1], [2]]


def brute_repeats(data):
    docs = sorted({(i, t or "") for i, t, *_ in data}, key=lambda d: (d[0] is not None, d[0] or 0))
    seen, gone = {}, {}
    for i, t in docs:
        w = t.split()
        for s in range(len(w) - 19):
            key = tuple(w[s:s + 20])
            if seen.setdefault(key, (i, t, s)) != (i, t, s):
                gone.setdefault((i, t), set()).update(range(s, s + 20))
    return {(i, t): [w for k, w in enumerate(t.split()) if k not in gone.get((i, t), ())] for i, t in docs}


def test_substring_removal(spark):
    rng = random.Random(3)
    shared, line = words(5, 60), words(6, 25)
    data = []
    for i in range(80):
        t = words(100 + i, rng.randrange(0, 120))
        if i % 3 == 0:
            at = rng.randrange(len(t) + 1)
            t[at:at] = shared[rng.randrange(20):40 + rng.randrange(20)]
        if i % 4 == 0:
            t += line
        if i % 10 == 0:
            t = t + ["la"] * 70 + t
        data.append((i, " ".join(t), "en"))
    data += [(200 + i, " ".join(words(7, 90)), "en") for i in range(15)]
    data = rows(data) + [r for r in awkward() if r[0] not in (3, 9)]
    want = brute_repeats(data)
    got = substring_dedup.remove_repeats(frame(spark, data)).collect()
    assert len(got) == len(data)
    texts = {}
    for i, t, *_ in data:
        texts.setdefault(i, []).append(t or "")
    for r in got:
        options = [" ".join(want[(r["id"], t)]) for t in texts[r["id"]]]
        assert r["kept_text"] in options
        assert r["kept_sha256"] == hashlib.sha256(r["kept_text"].encode()).hexdigest()
        assert r["n_words"] - r["n_removed"] == len(r["kept_text"].split())


def test_substring_repeated_rows_are_one_document(spark):
    text = " ".join(words(8, 50))
    got = substring_dedup.remove_repeats(frame(spark, rows([(1, text, "en"), (1, text, "en"), (2, text, "en")]))).collect()
    assert sorted((r["id"], r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, 50)]
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


def brute_classes(data):
    sets = [set(ngram_join.shingles(t or "").tolist()) for _, t, *_ in data]
    n, links, name = len(data), [0] * len(data), list(range(len(data)))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a in range(n):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 5 * both >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                name[find(a)] = find(b)
    out = []
    for a in range(n):
        ids = [data[b][0] for b in range(n) if find(b) == find(a)]
        out.append((data[a][0], min(ids, key=lambda i: (i is None, i or 0)), links[a]))
    return sorted(out, key=repr)


def test_similarity_classes(spark):
    rng = random.Random(4)
    data = []
    for c in range(12):
        base = words(300 + c, rng.randrange(3, 90))
        for k in range(rng.randrange(1, 9)):
            t = list(base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = f"z{rng.randrange(99)}"
            data.append((len(data), " ".join(t), "en"))
    data = rows(data) + rows([(100 + i, t, "en") for i, (_, t, *_) in enumerate(awkward())]) + rows([(None, None, None), (None, "a b c d e f g", "en")])
    docs = frame(spark, data)
    got = sorted(((r["id"], r["class_id"], r["n_links"]) for r in ngram_join.similar_documents(docs).collect()), key=repr)
    assert got == brute_classes(data)
    left = ngram_join.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert ngram_join.similar_documents(frame(spark, [])).count() == 0


def test_similarity_group_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    base = words(9, 120)
    data = rows([(i, " ".join([*base[:60], f"v{i}", *base[61:]] if i % 2 else [*base[:30], f"u{i}", *base[31:]]), "en") for i in range(45)])
    got = sorted(((r["id"], r["class_id"], r["n_links"]) for r in ngram_join.similar_documents(frame(spark, data)).collect()), key=repr)
    assert got == brute_classes(data)


def test_pairs_at_the_threshold_survive():
    rng = np.random.default_rng(1)
    lost = 0
    for _ in range(300):
        grams = rng.integers(0, 1 << 62, 90, dtype=np.uint64)
        values = np.array([ngram_join.minhash(np.unique(grams[:80])), ngram_join.minhash(np.unique(grams[10:]))]) >> np.uint64(48)
        pair = np.array([0, 1])
        a, _ = ngram_join.surviving(values, np.array([80, 80]), pair, pair)
        lost += not len(a)
    assert lost == 0  # similarity 70/90, just under the threshold
