"""Samples, walks and neighbours against brute force on small inputs."""

import math
import random

from pyspark.sql import functions as F

from graphloom.operators import embedding, linkpred, neighbors, sampling

LINKS = [(i, (i * 7 + 3) % 40) for i in range(40)] + [(i, (i * 3 + 1) % 40) for i in range(40)]


def test_radius_join_is_exact_in_small_blocks(spark):
    rng = random.Random(5)
    # a third of the points crowd around one place
    points = [(i, [rng.gauss(0, 0.01) if i % 3 == 0 else rng.random() for _ in range(3)]) for i in range(150)]
    df = spark.createDataFrame(points, "id bigint, vector array<double>")
    found = {(r.a, r.b) for r in neighbors.radius_neighbors(df, 0.3, block=16).collect()}
    want = {(a, b) for a, x in points for b, y in points if a < b and math.dist(x, y) <= 0.3}
    assert found == want


def test_dbscan_against_brute_force(spark):
    rng = random.Random(7)
    points = [(i, rng.gauss(0, 0.05), rng.gauss(0, 0.05)) for i in range(80)]
    points += [(100 + i, rng.gauss(1, 0.2), rng.gauss(0, 0.2)) for i in range(60)]
    eps, least = 0.1, 5
    near = {a: [b for b, u, v in points if math.hypot(x - u, y - v) <= eps] for a, x, y in points}
    core = {a for a in near if len(near[a]) >= least}
    cluster = {}
    for a in sorted(core):
        stack = [a] if a not in cluster else []
        while stack:
            b = stack.pop()
            if b not in cluster:
                cluster[b] = a
                stack += [c for c in near[b] if c in core]
    for a in near:
        if a not in core:
            cluster[a] = min([cluster[b] for b in near[a] if b in core], default=-1)
    df = spark.createDataFrame(points, "id bigint, x double, y double")
    assert {r.id: r.cluster for r in neighbors.dbscan(df, eps, least).collect()} == cluster


def test_walks_follow_links_and_repeat(make):
    graph = make(LINKS)
    linked = {(a, b) for p in LINKS for a, b in (p, p[::-1]) if a != b}
    for walks in (sampling.random_walks(graph, 4), sampling.biased_walks(graph, 4, p=0.5, q=2.0),
                  sampling.random_walks(graph, 4, backtrack=False)):
        rows = {(r.walk, r.step): r.node for r in walks.collect()}
        assert len(rows) == 4 * 40
        assert all((rows[w, s - 1], n) in linked for (w, s), n in rows.items() if s)
    again = {(r.walk, r.step): r.node for r in sampling.random_walks(graph, 4, backtrack=False).collect()}
    assert again == rows


def test_negatives_are_no_edges(make):
    graph = make(LINKS)
    found = {(r.src, r.dst) for r in linkpred.negative_sampling(graph, 300, 1).collect()}
    assert len(found) == 300 and not found & set(LINKS) and all(a != b for a, b in found)


def test_weighted_sample_prefers_heavy_rows(spark):
    weights = spark.range(200).select("id", F.when(F.col("id") < 20, 100.0).otherwise(1.0).alias("weight"))
    picked = [r.id for r in sampling.weighted_nodes(weights, 20, 3).collect()]
    assert len(set(picked)) == 20 and sum(i < 20 for i in picked) >= 12


def test_spectral_columns_are_orthonormal(make):
    table = embedding.spectral_embedding(make(LINKS), 2, 5)
    row = table.agg(F.sum(F.col("v0") * F.col("v0")), F.sum(F.col("v0") * F.col("v1")), F.sum(F.col("v1") * F.col("v1"))).first()
    assert abs(row[0] - 1) < 1e-9 and abs(row[1]) < 1e-9 and abs(row[2] - 1) < 1e-9


def test_descent_finds_nine_in_ten(spark):
    rng = random.Random(11)
    # a third of the points in one crowd, repeated vectors among them
    points = [(i, [rng.gauss(0, 0.01) if i % 3 == 0 else rng.random() for _ in range(8)]) for i in range(900)]
    points += [(1000 + i, points[0][1]) for i in range(30)]
    df = spark.createDataFrame(points, "id bigint, vector array<double>")
    found = neighbors.nearest_descent(df, 8)
    rows = found.collect()
    where = dict(points)
    assert len(rows) == 8 * len(points) == len({(r.id, r.neighbour) for r in rows})
    assert all(r.id != r.neighbour and abs(r.distance - math.dist(where[r.id], where[r.neighbour])) < 1e-9 for r in rows)
    exact = neighbors.exact_nearest(df, 8, queries=60)
    for r in exact.limit(40).collect():
        near = sorted(math.dist(where[r.id], v) for i, v in points if i != r.id)[:8]
        assert r.distance <= near[-1] + 1e-12
    share = neighbors.recall(found, exact).first()
    assert share.queries == 60 and share.recall >= 0.9


def test_descent_of_few_points(spark):
    schema = "id bigint, vector array<double>"
    assert neighbors.nearest_descent(spark.createDataFrame([], schema)).count() == 0
    assert neighbors.nearest_descent(spark.createDataFrame([(1, [0.0])], schema)).count() == 0
    few = neighbors.nearest_descent(spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [5.0])], schema), 10)
    assert {(r.id, r.neighbour): r.distance for r in few.collect()} == {
        (1, 2): 1.0, (2, 1): 1.0, (1, 3): 5.0, (3, 1): 5.0, (2, 3): 4.0, (3, 2): 4.0}


def test_single_precision_vectors_travel_as_they_are(spark):
    points = spark.createDataFrame([(i, [float(i % 7) / 3, float(i * i % 11)]) for i in range(60)], "id bigint, vector array<float>")
    wide = points.withColumn("vector", F.col("vector").cast("array<double>"))
    assert neighbors._numbers(points).schema["vector"].dataType.simpleString() == "array<float>"
    for found in (lambda p: neighbors.radius_neighbors(p, 1.5), lambda p: neighbors.lsh_pairs(p, 1.5, 2.0), lambda p: neighbors.nearest_descent(p, 4)):
        assert sorted(found(points).collect()) == sorted(found(wide).collect())
