"""Decontamination and sharding."""

import random
from collections import Counter

from helpers_llm import awkward, frame, rows, words

from graphloom.llm import decontaminate, sharding


def bench(spark):
    items = [(k, " ".join(words(500 + k, 15 + 5 * k))) for k in range(8)]
    items += [(20, "one two three four five six"), (21, "too short"), (22, None), (None, " ".join(words(590, 30))), (0, items[0][1])]
    return items, spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")


def test_overlaps_tolerate_substitutions(spark):
    items, table = bench(spark)
    rng = random.Random(11)
    data, want = [], set()
    for i in range(120):
        t = words(700 + i, 80)
        if i % 3 == 0:
            number, text = items[rng.randrange(8)]
            part = text.split()
            for k in range(4, len(part), 8):  # one in eight differs
                part[k] = "other"
            t[30:30] = part
            want.add((i, number))
        data.append((i, " ".join(t).upper() if i % 2 else " ".join(t), "en"))
    data.append((500, "so ONE, two; three four five six and on", "en"))
    data.append((501, items[-2][1], "en"))
    data.append((502, " ".join(items[3][1].split()[:8]), "en"))  # too little of an item
    want |= {(500, 20), (501, None)}
    docs = frame(spark, rows(data) + awkward())
    got = decontaminate.contaminated(docs, table)
    assert {(r["id"], r["item"]) for r in got.collect()} == want
    left = decontaminate.drop_contaminated(docs, table)
    assert left.columns == docs.columns
    assert left.count() == docs.count() - len({i for i, _ in want})
    assert decontaminate.contaminated(docs.limit(0), table).count() == 0
    assert decontaminate.drop_contaminated(docs, table.limit(0)).count() == docs.count()


def least_unhit(masks, upto):
    """Fewest differing words among n that no mask hits, for n = 0 .. upto."""
    span = max(map(len, masks))
    bits = [int(m, 2) for m in masks]
    states, found = {0: 0}, [0]
    for _ in range(upto):
        after = {}
        for seen, cost in states.items():
            for equal in (0, 1):
                window = seen << 1 | equal
                if not any(window & b == b for b in bits):
                    key = window & (1 << span - 1) - 1
                    after[key] = min(after.get(key, upto), cost + 1 - equal)
        states = after
        found.append(min(states.values()))
    return found


def test_masks_hit_every_overlap_that_counts():
    """Up to a fifth of n words differ.  Beyond 60 words, cut off 15: both parts have more than a fifth, so the whole has."""
    kinds = sorted(decontaminate.MASKS)
    for kind, after in zip(kinds, [*kinds[1:], 61], strict=True):
        found = least_unhit(decontaminate.MASKS[kind], 60)
        assert all(found[n] > n // 5 for n in range(kind, after)), kind
    assert kinds[0] == decontaminate.SHORTEST_ITEM


def brute_overlap(here, there):
    """Whether any diagonal counts."""
    whole = -(-4 * len(there) // 5)
    for shift in range(1 - len(there), len(here)):
        equal = [here[shift + i] == w for i, w in enumerate(there) if 0 <= shift + i < len(here)]
        if sum(equal) >= whole:
            return True
        for i in range(len(equal)):
            same = 0
            for j in range(i, len(equal)):
                same += equal[j]
                if same >= min(13, whole) and 5 * same >= 4 * (j - i + 1):
                    return True
    return False


def test_overlaps_equal_a_scan_of_all_diagonals(spark):
    rng = random.Random(5)
    sizes = [*range(5, 18), 20, 25, 40, 59]
    items = {n: words(900 + n, n) for n in sizes}
    table = spark.createDataFrame([(n, " ".join(t)) for n, t in items.items()], "item_id long, text string")
    texts = []
    for n in sizes:
        parts = [[i for i in range(n) if i % 5 == phase] for phase in range(5)]  # every fifth word
        parts += [rng.sample(range(n), n // 5) for _ in range(8)] + [rng.sample(range(n), n // 5 + 1) for _ in range(2)]
        for gone in parts:
            copy = [f"x{i}" if i in gone else w for i, w in enumerate(items[n])]
            texts.append(words(rng.random(), 9, 9999) + copy[:rng.choice([n, n, max(5, n - 7)])] + words(rng.random(), 9, 9999))
    # twelve words in one piece, and apart from them thirteen of sixteen
    texts.append([w if i < 12 or i >= 40 and i not in (44, 49, 53) else f"y{i}" for i, w in enumerate(items[59][:56])])
    got = {(r["id"], r["item"]) for r in decontaminate.contaminated(frame(spark, rows([(i, " ".join(t), "en") for i, t in enumerate(texts)])), table).collect()}
    want = {(i, n) for i, t in enumerate(texts) for n in sizes if brute_overlap(t, items[n])}
    assert got == want and len(want) > 150


def test_large_benchmarks_give_the_same(spark, monkeypatch):
    items, table = bench(spark)
    docs = frame(spark, rows([(1, "a b " + items[2][1], "en"), (1, "a b " + items[2][1], "en"), (None, items[4][1] + " z", "en"), (3, "clean", "en")]))
    small = sorted(map(tuple, decontaminate.contaminated(docs, table).collect()), key=repr)
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert sorted(map(tuple, decontaminate.contaminated(docs, table).collect()), key=repr) == small
    assert {(r[0], r[2]) for r in small} == {(1, 2), (None, 4)}


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    return not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_main_path_has_no_python(spark, tmp_path):
    _, table = bench(spark)
    docs = frame(spark, rows([(i, f"text {i}", "en") for i in range(50)]))
    assert no_python(decontaminate.contaminated(docs, table))
    assert no_python(sharding.write_shards(docs, str(tmp_path / "s")))


def test_shards_hold_every_record_once(spark, tmp_path):
    data = rows([(i, f"text {i}", "en") for i in range(997)]) + awkward()
    docs = frame(spark, data)
    out = sharding.write_shards(docs, str(tmp_path / "a"), shards=16)
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in data)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(counts[shard]))
    assert {r["input_shard"] for r in got} == {"x"}  # the input's own column of that name
    again = sharding.write_shards(docs.repartition(7), str(tmp_path / "b"), shards=16).collect()
    assert {(r["doc_id"], r["text"], r["shard"], r["slot"]) for r in got if r["doc_id"] not in (3, None)} == \
        {(r["doc_id"], r["text"], r["shard"], r["slot"]) for r in again if r["doc_id"] not in (3, None)}
    other = sharding.write_shards(docs, str(tmp_path / "c"), shards=16, seed=18).collect()
    moved = {r["doc_id"]: r["shard"] for r in got}
    assert sum(moved[r["doc_id"]] != r["shard"] for r in other) > 800
    # neighbours in the input end up anywhere
    order = sorted((r["shard"], r["slot"], r["doc_id"]) for r in got if r["doc_id"] is not None)
    assert sum(abs(a[2] - b[2]) == 1 for a, b in zip(order, order[1:], strict=False)) < 20
    assert sharding.write_shards(docs.limit(0), str(tmp_path / "d")).count() == 0
    digest = sharding.shard_digest(docs)
    assert {r["size"] for r in digest.filter("doc_id = 4").collect()} >= {1}


def test_shards_keep_all_columns_and_do_not_depend_on_the_partitioning(spark, tmp_path):
    names = "_crc _bucket _row _before _order _position _n _upto".split()
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id % 90) AS text", *[f"concat('{n}', id) AS {n}" for n in names])
    first = sharding.write_shards(docs, str(tmp_path / "a"), 5, bucket_bytes=1000)
    assert {c for c in first.columns} == {*docs.columns, "shard", "slot"}
    rows = {r["doc_id"]: r for r in first.collect()}
    assert len(rows) == 400 and all(rows[i][n] == f"{n}{i}" for i in range(400) for n in names)
    again = sharding.write_shards(docs.repartition(7), str(tmp_path / "b"), 5, bucket_bytes=1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        third = sharding.write_shards(docs.coalesce(1), str(tmp_path / "c"), 5, bucket_bytes=1000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for other in (again, third):
        assert {r["doc_id"]: (r["shard"], r["slot"]) for r in other.collect()} == {i: (r["shard"], r["slot"]) for i, r in rows.items()}
    places = [i for i, _ in sorted(rows.items(), key=lambda x: (x[1]["shard"], x[1]["slot"]))]
    assert sum(p == k for k, p in enumerate(places)) < 20


def test_large_benchmarks_are_joined_without_broadcasting_their_texts(spark, monkeypatch):
    items, table = bench(spark)
    docs = frame(spark, rows([(i, " ".join(words(900 + i, 30)) + " " + text, "en") for i, (_, text, *_) in enumerate(items[:8])]) + awkward())
    want = {(r["id"], r["item"], r["matched"], r["overlap"]) for r in decontaminate.contaminated(docs, table).collect()}
    assert len(want) >= 8
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 10)
    assert {(r["id"], r["item"], r["matched"], r["overlap"]) for r in decontaminate.contaminated(docs, table).collect()} == want
