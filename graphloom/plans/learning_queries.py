"""Propagation, embeddings, communities."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.operators import community, embedding, sampling
from graphloom.plans import fixtures as fx
from graphloom.plans.fixtures import COPURCHASE
from graphloom.plans.registry import query
from graphloom.plans.sampling_queries import FILLED, SEED, _walk_sql, vectors
from graphloom.plans.structure_queries import BOTH, DEGREES, rounded
from graphloom.session import cut


def doubles(spark, sf):
    return vectors(spark, sf).select("id", F.col("vector").cast("array<double>").alias("vector"))


def filled(spark, sf):
    """A vector for every vertex, zeros where it has none."""
    none = F.array_repeat(F.lit(0.0), 64)
    return fx.parts(spark, sf).select("id").join(doubles(spark, sf), "id", "left").select("id", F.coalesce("vector", none).alias("vector"))


def shown(df, vector="vector"):
    """A vector by its length, its sum and the sum of its squares."""
    v = F.col(vector)
    return df.select("id", F.size(v).cast("bigint").alias("width"),
                     F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 5).alias("total"),
                     F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x), 5).alias("squares"))


_LONG = f"""WITH {COPURCHASE}, feats AS MATERIALIZED (SELECT vec_id AS id, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)"""
_WHOLE = f"""WITH {COPURCHASE}, {FILLED}, feats AS MATERIALIZED (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM emb)"""
_SHOWN = "SELECT id, count(*) AS width, round(sum(x), 5) AS total, round(sum(x * x), 5) AS squares FROM {0} GROUP BY id"


def _sage_sql(rounds):
    parts = ["s0 AS (SELECT id, pos, x FROM feats)"]
    for k in range(1, rounds + 1):
        parts.append(f"""s{k} AS MATERIALIZED (SELECT s.id, s.pos, CASE WHEN m.x IS NULL THEN s.x ELSE (s.x + m.x) / 2 END AS x FROM s{k - 1} s
  LEFT JOIN (SELECT dst AS id, pos, avg(x) AS x FROM edges JOIN s{k - 1} p ON p.id = src GROUP BY ALL) m USING (id, pos))""")
    return ",\n".join(parts)


@query("N01_mean_aggregate", f"{_WHOLE}, {_sage_sql(2)} {_SHOWN.format('s2')}")
def mean_aggregate(spark, sf):
    """Two rounds of own vector averaged with the neighbour mean."""
    return shown(embedding.sage_rounds(fx.copurchase(spark, sf).edges, filled(spark, sf), 2))


@query("N02_gcn_propagate", f"""{_LONG}, w AS MATERIALIZED (SELECT src, dst, 1 / sqrt(count(*) OVER (PARTITION BY src) * count(*) OVER (PARTITION BY dst)) AS w FROM edges),
g1 AS MATERIALIZED (SELECT dst AS id, pos, sum(w * x) AS x FROM w JOIN feats ON id = src GROUP BY ALL),
g2 AS MATERIALIZED (SELECT dst AS id, pos, sum(w * x) AS x FROM w JOIN g1 ON id = src GROUP BY ALL) {_SHOWN.format('g2')}""")
def gcn_propagate(spark, sf):
    return shown(embedding.gcn_propagate(fx.copurchase(spark, sf).edges, doubles(spark, sf), 2))


@query("N03_attention_aggregate", f"""{_WHOLE},
sc AS MATERIALIZED (SELECT src, dst, list_dot_product(a.v, b.v) AS s FROM edges JOIN emb a ON a.id = src JOIN emb b ON b.id = dst),
att AS (SELECT src, dst, exp(s - max(s) OVER (PARTITION BY dst)) AS e FROM sc), nrm AS (SELECT src, dst, e / sum(e) OVER (PARTITION BY dst) AS a FROM att),
o AS (SELECT dst AS id, pos, sum(a * x) AS x FROM nrm JOIN feats ON feats.id = src GROUP BY ALL) {_SHOWN.format('o')}""")
def attention_aggregate(spark, sf):
    return shown(embedding.attention_aggregate(fx.copurchase(spark, sf).edges, filled(spark, sf)))


_COOCCURRENCE = f"""{_walk_sql(6)},
met AS MATERIALIZED (SELECT a.node, b.node AS context, count(*)::DOUBLE AS n FROM walks a JOIN walks b ON b.walk = a.walk AND b.step <> a.step AND abs(b.step - a.step) <= 3 GROUP BY ALL),
r AS MATERIALIZED (SELECT node, sum(n) AS r FROM met GROUP BY ALL), t AS (SELECT sum(n) AS t FROM met),
pmi AS MATERIALIZED (SELECT m.node, m.context, ln(n * t / (a.r * b.r)) AS x FROM met m JOIN r a ON a.node = m.node JOIN r b ON b.node = m.context, t WHERE ln(n * t / (a.r * b.r)) > 0),
axes AS MATERIALIZED (SELECT node AS context, i, CASE WHEN ('0x' || substr(md5(node || ':' || ({SEED} + i)), 1, 15))::BIGINT % 2 = 0 THEN 1 ELSE -1 END AS s FROM r, (SELECT unnest(range(16)) AS i)),
a AS (SELECT p.node AS id, i, sum(s * x) AS v FROM pmi p JOIN axes USING (context) GROUP BY ALL)
SELECT w.id, 16::BIGINT AS width, round(coalesce(sum(v), 0), 5) AS total, round(coalesce(sum(v * v), 0), 5) AS squares
FROM (SELECT DISTINCT node AS id FROM walks) w LEFT JOIN a USING (id) GROUP BY w.id"""


@fx.shared
def walk_vectors(spark, sf):
    """Vectors of ten walks of 80 from every vertex, 128 wide."""
    walks = sampling.random_walks(fx.copurchase(spark, sf), 80, 10)
    return cut(embedding.walk_embedding(walks, 128).withColumnRenamed("node", "id"))


@query("G03_walk_embedding")
def walk_embedding(spark, sf):
    return shown(walk_vectors(spark, sf))


@query("G03_cooccurrence_embedding", _COOCCURRENCE)
def cooccurrence_embedding(spark, sf):
    """The random projection of the same table, on short walks."""
    walks = sampling.random_walks(fx.copurchase(spark, sf), 6)
    return shown(embedding.cooccurrence_embedding(walks, 16, 3).withColumnRenamed("node", "id"))


@query("G04_spectral_embedding")
def spectral_embedding(spark, sf):
    return rounded(embedding.spectral_embedding(fx.copurchase(spark, sf), 4), "v0", "v1", "v2", "v3")


_EGO = f"""{DEGREES}, {BOTH}, l AS MATERIALIZED (SELECT id, count(*) AS links FROM nb GROUP BY ALL),
tri AS (SELECT x.id, count(*) // 2 AS t FROM nb x JOIN nb y ON y.id = x.n JOIN nb z ON z.id = y.n AND z.n = x.id GROUP BY ALL),
reach AS (SELECT nb.id, sum(links) AS reach FROM nb JOIN l ON l.id = nb.n GROUP BY ALL),
ego AS MATERIALIZED (SELECT id, degree, in_degree, out_degree, coalesce(links, 0) + coalesce(t, 0) AS ego_inside,
  (coalesce(reach, 0) - coalesce(links, 0) - 2 * coalesce(t, 0))::BIGINT AS ego_leaving FROM degrees LEFT JOIN l USING (id) LEFT JOIN tri USING (id) LEFT JOIN reach USING (id))"""
_BASE = ["degree", "in_degree", "out_degree", "ego_inside", "ego_leaving"]


@query("G05_recursive_features", f"""{_EGO} SELECT e.*, {", ".join(f"round(coalesce(m.mean_{c}, 0), 6)::DOUBLE AS mean_{c}, coalesce(m.sum_{c}, 0)::DOUBLE AS sum_{c}" for c in _BASE)}
FROM ego e LEFT JOIN (SELECT nb.id, {", ".join(f"avg(x.{c}) AS mean_{c}, sum(x.{c}) AS sum_{c}" for c in _BASE)} FROM nb JOIN ego x ON x.id = nb.n GROUP BY nb.id) m ON m.id = e.id""")
def recursive_features(spark, sf):
    return rounded(embedding.recursive_features(fx.copurchase(spark, sf), 1), *[f"mean_{c}" for c in _BASE])


@query("G05_log_binned", f"""{DEGREES}, r AS (SELECT id, degree, count(*) OVER (ORDER BY degree) AS upto, count(*) OVER () AS n FROM degrees)
SELECT id, degree, greatest(ceil(-log2(greatest((n - upto) / n, 0.5 / n))) - 1, 0)::INT AS bin FROM r""")
def log_binned(spark, sf):
    from graphloom.operators.structure import degrees

    return embedding.log_binned(degrees(fx.copurchase(spark, sf)).select("id", "degree"), "degree", "bin")


@query("G05_pruned_features")
def pruned_features(spark, sf):
    """Two rounds, features kept only while unlike the ones before."""
    return embedding.recursive_features(fx.copurchase(spark, sf), 2, prune_at=0.9)


_PART_COMMUNITY = "com AS (SELECT id, brand AS community FROM vertices)"


@query("G08_modularity", f"""WITH {COPURCHASE}, {_PART_COMMUNITY},
e AS (SELECT s.community AS cs, d.community AS cd FROM edges JOIN com s ON s.id = src JOIN com d ON d.id = dst), m AS (SELECT count(*)::DOUBLE AS m FROM edges),
o AS (SELECT cs AS c, count(*) AS o FROM e GROUP BY ALL), i AS (SELECT cd AS c, count(*) AS i FROM e GROUP BY ALL), l AS (SELECT cs AS c, count(*) AS l FROM e WHERE cs = cd GROUP BY ALL)
SELECT round(sum(coalesce(l, 0) / m - coalesce(o, 0) * coalesce(i, 0) / (m * m)), 6) AS modularity FROM (SELECT DISTINCT community AS c FROM com) LEFT JOIN o USING (c) LEFT JOIN i USING (c) LEFT JOIN l USING (c), m""")
def modularity(spark, sf):
    graph = fx.copurchase(spark, sf)
    return rounded(community.modularity(graph, graph.vertices.select("id", F.col("brand").alias("community"))), "modularity")


@query("G08_modularity_undirected", f"""WITH {COPURCHASE}, {BOTH}, {_PART_COMMUNITY}, m AS (SELECT count(*)::DOUBLE AS m FROM pairs),
d AS (SELECT community AS c, count(*) AS d FROM nb JOIN com USING (id) GROUP BY ALL),
l AS (SELECT s.community AS c, count(*) AS l FROM pairs JOIN com s ON s.id = src JOIN com t ON t.id = dst AND t.community = s.community GROUP BY ALL)
SELECT round(sum(coalesce(l, 0) / m - (d / (2 * m)) * (d / (2 * m))), 6) AS modularity FROM d LEFT JOIN l USING (c), m""")
def modularity_undirected(spark, sf):
    graph = fx.copurchase(spark, sf)
    return rounded(community.modularity(graph, graph.vertices.select("id", F.col("brand").alias("community")), directed=False), "modularity")


@query("G07_louvain")
def louvain(spark, sf):
    return community.louvain(fx.coship(spark, sf))


@query("G09_community_ids", f"""WITH {COPURCHASE}, s AS (SELECT brand, row_number() OVER (ORDER BY count(*) DESC, min(id)) - 1 AS "index" FROM vertices GROUP BY brand)
SELECT id, "index" FROM vertices JOIN s USING (brand)""")
def community_ids(spark, sf):
    return community.community_ids(fx.parts(spark, sf).select("id", F.col("brand").alias("community")))


_KNOWN = "known AS (SELECT id, kind AS label FROM vertices WHERE size <= 25), d AS MATERIALIZED (SELECT id, count(*) AS d FROM nb GROUP BY ALL)"
_LABEL = """top AS (SELECT id, label FROM (SELECT id, label, round(sum(p), 9) AS p FROM {0} GROUP BY id, label)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY p DESC, label) = 1) SELECT id, label FROM top"""


# rounds of the SQL, by when either stands still to more digits than are compared
HARMONIC_ROUNDS, CONSISTENT_ROUNDS = 40, 18


def _harmonic_sql(rounds):
    parts = [f"WITH {COPURCHASE}, {BOTH}, {_KNOWN}, h0 AS (SELECT id, label, 1.0::DOUBLE AS p FROM known)"]
    for k in range(1, rounds + 1):
        parts.append(f"""h{k} AS MATERIALIZED (SELECT id, label, 1.0::DOUBLE AS p FROM known UNION ALL
  SELECT nb.n AS id, label, sum(p / d.d) AS p FROM nb JOIN h{k - 1} h ON h.id = nb.id JOIN d ON d.id = nb.n WHERE nb.n NOT IN (SELECT id FROM known) GROUP BY nb.n, label)""")
    return ",\n".join(parts)


@query("G12_label_spreading", f"{_harmonic_sql(HARMONIC_ROUNDS)}, {_LABEL.format(f'h{HARMONIC_ROUNDS}')}")
def label_spreading(spark, sf):
    """Harmonic function: half of the parts know their kind."""
    graph = fx.copurchase(spark, sf)
    known = graph.vertices.filter("size <= 25").select("id", F.col("kind").alias("label"))
    return community.likeliest_label(community.harmonic_labels(graph, known))


def _consistent_sql(rounds):
    """Starts from the part of the answer along the leading eigenvector, the root of the degrees; the rest settles in few rounds."""
    parts = [f"""WITH {COPURCHASE}, {BOTH}, {_KNOWN}, 
c0 AS (SELECT d.id, y.label, sqrt(d.d) * y.s / (SELECT sum(d) FROM d) AS p FROM d, (SELECT label, sum(sqrt(d)) AS s FROM known JOIN d USING (id) GROUP BY label) y)"""]
    for k in range(1, rounds + 1):
        parts.append(f"""c{k} AS MATERIALIZED (SELECT id, label, sum(p) AS p FROM (SELECT id, label, 1 - 0.99::DOUBLE AS p FROM known UNION ALL
  SELECT nb.n, label, p * 0.99::DOUBLE / sqrt(a.d * b.d) FROM nb JOIN c{k - 1} c ON c.id = nb.id JOIN d a ON a.id = nb.id JOIN d b ON b.id = nb.n) GROUP BY ALL)""")
    return ",\n".join(parts)


@query("G12_local_global_consistency", f"{_consistent_sql(CONSISTENT_ROUNDS)}, {_LABEL.format(f'c{CONSISTENT_ROUNDS}')}")
def local_global_consistency(spark, sf):
    graph = fx.copurchase(spark, sf)
    known = graph.vertices.filter("size <= 25").select("id", F.col("kind").alias("label"))
    return community.likeliest_label(community.consistent_labels(graph, known))
