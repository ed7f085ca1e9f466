"""Vectors, neighbours, clusterings and classifiers."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from graphloom.functions.vectors import cosine_similarity
from graphloom.operators import embedding, linkpred, models, neighbors, structure, tabular
from graphloom.plans import fixtures as fx
from graphloom.plans import sampling_queries
from graphloom.plans.fixtures import COPURCHASE, table
from graphloom.plans.learning_queries import doubles, shown, walk_vectors
from graphloom.plans.registry import query
from graphloom.plans.sampling_queries import FILLED, vectors
from graphloom.plans.structure_queries import DEGREES, rounded
from graphloom.session import cut

_NEAR = """near AS (SELECT u.vec_id AS a, v.vec_id AS b, list_distance(u.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS distance
FROM embeddings u JOIN embeddings v ON u.vec_id < v.vec_id WHERE list_distance(u.embedding::DOUBLE[], v.embedding::DOUBLE[]) <= 1.2)"""


@query("B20_cosine_similarity", f"""WITH {COPURCHASE}, {FILLED} SELECT src, dst, round(coalesce(list_dot_product(a.v, b.v)
  / nullif(sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)), 0), 0), 6) AS cosine
FROM edges JOIN emb a ON a.id = src JOIN emb b ON b.id = dst""")
def cosine(spark, sf):
    from graphloom.operators.linkpred import pair_vectors

    pairs = pair_vectors(fx.copurchase(spark, sf).edges, doubles(spark, sf))
    return rounded(pairs.select("src", "dst", F.coalesce(cosine_similarity("u", "v"), F.lit(0.0)).alias("cosine")), "cosine")


@query("B21_text_embedding")
def text_embedding(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return shown(models.text_embedding(docs, "text"))


@query("B22_assemble_features", f"""{DEGREES} SELECT id, 4 AS width, degree + in_degree + out_degree + size AS total FROM degrees JOIN vertices USING (id)""")
def assemble_features(spark, sf):
    graph = fx.copurchase(spark, sf)
    wide = structure.degrees(graph).join(graph.vertices.select("id", "size"), "id")
    packed = models.assemble_features(wide, ["degree", "in_degree", "out_degree", "size"]).withColumn("v", vector_to_array("features"))
    return packed.select("id", F.size("v").alias("width"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("total"))


@query("C15_radius_neighbors_join", f"""WITH {_NEAR} SELECT a AS src, b AS dst, round(distance, 6) AS distance FROM near
UNION ALL SELECT b, a, round(distance, 6) FROM near UNION ALL SELECT vec_id, vec_id, 0.0::DOUBLE FROM embeddings""")
def radius_neighbors_join(spark, sf):
    points = vectors(spark, sf)
    pairs = neighbors.radius_neighbors(points, 1.2)
    return rounded(neighbors.neighbour_lists(pairs, points), "distance")


@query("G10_knn_graph", f"""WITH {_NEAR} SELECT a AS src, b AS dst, round(distance, 6) AS weight, u.label AS src_label, v.label AS dst_label
FROM near JOIN embeddings u ON u.vec_id = a JOIN embeddings v ON v.vec_id = b""")
def knn_graph(spark, sf):
    points = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    graph = neighbors.knn_graph(points, neighbors.radius_neighbors(points.select("id", "vector"), 1.2))
    props = graph.vertices
    return rounded(
        graph.edges.join(props.select(F.col("id").alias("src"), F.col("label").alias("src_label")), "src")
        .join(props.select(F.col("id").alias("dst"), F.col("label").alias("dst_label")), "dst"), "weight")


@query("G11_lsh_knn_graph")
def lsh_knn_graph(spark, sf):
    return rounded(neighbors.lsh_pairs(vectors(spark, sf), 1.2, bucket=0.4), "distance")


@query("G11_nearest_descent")
def nearest_descent(spark, sf):
    """About the ten nearest vectors of each, by neighbour descent."""
    return rounded(neighbors.nearest_descent(vectors(spark, sf)), "distance")


@query("G11_descent_recall")
def descent_recall(spark, sf):
    """The share of true neighbours that the descent finds, over 200 vectors compared with all."""
    points = vectors(spark, sf)
    return rounded(neighbors.recall(neighbors.nearest_descent(points), neighbors.exact_nearest(points, 10)), "recall")


EPS, MIN_POINTS = 0.02, 5
AXIS_ROUNDS = 600  # of the SQL's power iteration, by when the axes stand still


def _axis_sql(name: str, matrix: str) -> str:
    """CTEs of the leading eigenvector of a table (i, line) of a symmetric matrix."""
    return f"""{name}_steps AS (SELECT 0 AS k, list_transform(range(64), lambda i: 1.0::DOUBLE + i % 7) AS v
  UNION ALL SELECT k + 1, list_transform(l, lambda x: x / sqrt(list_dot_product(l, l))) FROM (
    SELECT k, list(list_dot_product(line, v) ORDER BY i) AS l FROM {name}_steps, {matrix} WHERE k < {AXIS_ROUNDS} GROUP BY k)),
{name} AS MATERIALIZED (SELECT v FROM {name}_steps WHERE k = {AXIS_ROUNDS})"""


DBSCAN_SQL = f"""WITH RECURSIVE vec AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings),
cell AS (SELECT id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM vec),
centred AS MATERIALIZED (SELECT id, i, x - avg(x) OVER (PARTITION BY i) AS x FROM cell),
cov AS MATERIALIZED (SELECT i, list(s ORDER BY j) AS line FROM (
  SELECT a.i, b.i AS j, sum(a.x * b.x) AS s FROM centred a JOIN centred b USING (id) GROUP BY ALL) GROUP BY i),
{_axis_sql("first_axis", "cov")},
rest AS MATERIALIZED (SELECT i, list_transform(list_zip(line, f.v), lambda z: z[1] - f.v[i] * z[2] * list_dot_product(f.v, f.image)) AS line
  FROM cov, (SELECT any_value(v) AS v, list(list_dot_product(line, v) ORDER BY i) AS image FROM first_axis, cov) f),
{_axis_sql("second_axis", "rest")},
p AS MATERIALIZED (SELECT id, list_dot_product(c, f.v) AS x, list_dot_product(c, g.v) AS y
  FROM (SELECT id, list(x ORDER BY i) AS c FROM centred GROUP BY id), first_axis f, second_axis g),
near AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {EPS}),
cores AS MATERIALIZED (SELECT a AS id FROM near GROUP BY ALL HAVING count(*) >= {MIN_POINTS}),
cc AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT id FROM cores) AND b IN (SELECT id FROM cores)),
walk AS (SELECT id, id AS met FROM cores UNION SELECT w.id, cc.b FROM walk w JOIN cc ON cc.a = w.met),
named AS (SELECT id, min(met) AS cluster FROM walk GROUP BY ALL),
edge AS (SELECT near.a AS id, min(cluster) AS cluster FROM near JOIN named ON named.id = near.b WHERE near.a NOT IN (SELECT id FROM cores) GROUP BY ALL)
SELECT p.id, coalesce(named.cluster, edge.cluster, -1) AS cluster FROM p LEFT JOIN named USING (id) LEFT JOIN edge ON edge.id = p.id"""


@query("K02_dbscan", DBSCAN_SQL)
def dbscan(spark, sf):
    """Density clusters of the vectors reduced to their two principal components; -1 is noise."""
    reduced = models.principal_components(_labelled_vectors(spark, sf), 2).withColumn("v", vector_to_array("components"))
    return neighbors.dbscan(reduced.select("id", F.col("v")[0].alias("x"), F.col("v")[1].alias("y")), EPS, MIN_POINTS)


def _labelled_vectors(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").cast("string").alias("label"))
    return models.as_features(rows).drop("vector")


@query("K01_kmeans")
def kmeans(spark, sf):
    return models.kmeans(_labelled_vectors(spark, sf)).select("id", "cluster")


@query("K03_reduce_2d")
def reduce_2d(spark, sf):
    return shown(models.principal_components(_labelled_vectors(spark, sf), 2).withColumn("vector", vector_to_array("components")))


@query("K04_pca_32")
def pca_32(spark, sf):
    return shown(models.principal_components(_labelled_vectors(spark, sf), 32).withColumn("vector", vector_to_array("components")))


def _scored(spark, sf, kind):
    marked = tabular.split_rows(_labelled_vectors(spark, sf), 25, 31337, "id")
    predicted = models.classify(marked.filter("split = 'train'"), marked.filter("split = 'test'"), "label", kind)
    return rounded(tabular.weighted_scores(predicted), "accuracy", "precision", "recall", "f1")


@query("K05_logistic_regression")
def logistic_regression(spark, sf):
    return _scored(spark, sf, "logistic")


@query("K06_random_forest")
def random_forest(spark, sf):
    return _scored(spark, sf, "forest")


def _pair_scored(pairs, kind):
    """Scores of a classifier that tells edges from non-edges, on pairs it was not fitted on."""
    # written, as a fit reads its rows several times
    pairs = cut(pairs.withColumn("label", F.col("label").cast("string")).select("src", "dst", "label", "features"))
    marked = tabular.split_rows(pairs, 25, 31337, "src", "dst")
    predicted = models.classify(marked.filter("split = 'train'"), marked.filter("split = 'test'"), "label", kind)
    return rounded(tabular.weighted_scores(predicted), "accuracy", "precision", "recall", "f1")


@query("K06_random_forest_pair_scores")
def random_forest_pair_scores(spark, sf):
    """Links told from non-links by the six pair scores."""
    pairs = sampling_queries.pair_feature_table(spark, sf)
    scores = [c for c in pairs.columns if c not in ("src", "dst", "label")]
    return _pair_scored(models.assemble_features(pairs, scores), "forest")


def _pair_vectors(spark, sf):
    """Both ends' walk vectors for every edge and as many non-edges."""
    graph = fx.copurchase(spark, sf)
    walked = walk_vectors(spark, sf)
    labelled = tabular.union_labelled(graph.edges.select("src", "dst"), sampling_queries._negatives(spark, sf))
    return models.as_features(linkpred.concat_vectors(labelled, walked))


@query("K06_random_forest_pair_vectors")
def random_forest_pair_vectors(spark, sf):
    """Links told from non-links by the walk vectors of both ends."""
    return _pair_scored(_pair_vectors(spark, sf), "forest")


@query("K05_logistic_pair_vectors")
def logistic_pair_vectors(spark, sf):
    return _pair_scored(_pair_vectors(spark, sf), "logistic")


@query("N02_gcn_classifier")
def gcn_classifier(spark, sf):
    """The linear classifier behind two rounds of propagated features: the kind of a part."""
    graph = fx.copurchase(spark, sf)
    spread = embedding.gcn_propagate(graph.edges, doubles(spark, sf), 2)
    rows = models.as_features(spread.join(graph.vertices.select("id", F.col("kind").cast("string").alias("label")), "id"))
    marked = tabular.split_rows(rows, 25, 31337, "id")
    predicted = models.classify(marked.filter("split = 'train'"), marked.filter("split = 'test'"), "label", "logistic")
    return rounded(tabular.weighted_scores(predicted), "accuracy", "precision", "recall", "f1")


@query("K07_boosted_trees")
def boosted_trees(spark, sf):
    """Gradient-boosted trees for document quality, from text statistics."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", F.col("quality").cast("string").alias("label"), F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("words"), F.size(F.split("text", "\n")).cast("double").alias("lines"))
    marked = tabular.split_rows(models.assemble_features(docs, ["n_chars", "words", "lines"]), 25, 31337, "doc_id")
    predicted = models.classify(marked.filter("split = 'train'"), marked.filter("split = 'test'"), "label", "boosted")
    return rounded(tabular.weighted_scores(predicted), "accuracy", "precision", "recall", "f1")


@query("K08_classify_unlabelled")
def classify_unlabelled(spark, sf):
    """Documents without a quality label get one from those that have it."""
    docs = table(spark, sf, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"), F.size(F.split("text", r"\s+")).cast("double").alias("words"))
    known = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    rows = models.assemble_features(docs, ["n_chars", "words"]).join(known, "doc_id", "left")
    unlabelled = rows.filter("label IS NULL").drop("label")
    return models.classify(rows.filter("label IS NOT NULL"), unlabelled, "label").select("doc_id", "prediction")


@query("G06_structural_roles")
def structural_roles(spark, sf):
    features = embedding.recursive_features(fx.copurchase(spark, sf), 1, prune_at=0.95)
    return models.structural_roles(features, [c for c in features.columns if c != "id"]).drop("shares")
