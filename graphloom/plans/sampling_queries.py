"""Sampling, walks, splits and link-prediction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.graph import Graph, undirected_pairs
from graphloom.operators import centrality, linkpred, sampling, structure, tabular
from graphloom.plans import fixtures as fx
from graphloom.plans.algorithm_queries import PAGERANK_ROUNDS, pagerank_sql
from graphloom.plans.fixtures import COPURCHASE, table
from graphloom.plans.registry import query
from graphloom.plans.structure_queries import BOTH, DEGREES, rounded

SEED = 31337


def unit_sql(text: str, seed: int = SEED) -> str:
    return f"((('0x' || substr(md5({text} || ':{seed}'), 1, 15))::BIGINT + 0.5::DOUBLE) / (1152921504606846976)::DOUBLE)"


def bucket_sql(text: str, seed: int = SEED) -> str:
    return f"('0x' || substr(md5({text} || ':{seed}'), 1, 15))::BIGINT"


def induced_sql(ids: str) -> str:
    return f"SELECT src, dst FROM edges WHERE src IN (SELECT id FROM {ids}) AND dst IN (SELECT id FROM {ids})"


@query("F01_degree_weighted_nodes", f"""{DEGREES}, picked AS (SELECT id FROM degrees WHERE degree > 0
  ORDER BY -ln({unit_sql('id')}) / degree, id LIMIT 500) {induced_sql('picked')}""")
def degree_weighted_nodes(spark, sf):
    """500 vertices drawn by degree, and the edges among them."""
    graph = fx.copurchase(spark, sf)
    picked = sampling.weighted_nodes(structure.degrees(graph), 500, SEED, "degree")
    return graph.induced(picked).edges.select("src", "dst")


@query("F02_pagerank_weighted_nodes", f"""WITH {COPURCHASE}, {pagerank_sql()}, picked AS (SELECT id FROM r{PAGERANK_ROUNDS}
  ORDER BY -ln({unit_sql('id')}) / rank, id LIMIT 500) {induced_sql('picked')}""")
def pagerank_weighted_nodes(spark, sf):
    graph = fx.copurchase(spark, sf)
    ranks = centrality.pagerank(graph, tolerance=1e-15)
    return graph.induced(sampling.weighted_nodes(ranks, 500, SEED, "rank")).edges.select("src", "dst")


@query("F03_uniform_nodes", f"""WITH {COPURCHASE}, picked AS (SELECT id FROM vertices ORDER BY md5(id || ':{SEED}'), id LIMIT 500) {induced_sql('picked')}""")
def uniform_nodes(spark, sf):
    graph = fx.copurchase(spark, sf)
    return graph.induced(sampling.uniform_nodes(graph.vertices, 500, SEED)).edges.select("src", "dst")


_NODE_EDGE = f"""picked AS (SELECT id FROM vertices ORDER BY md5(id || ':{SEED}'), id LIMIT 500),
touching AS (SELECT src AS id, src, dst FROM edges UNION ALL SELECT dst, src, dst FROM edges),
node_edges AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM touching WHERE id IN (SELECT id FROM picked)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY md5(id || ':' || src || ':' || dst || ':{SEED + 1}'), src, dst) = 1))"""


@query("F04_random_node_edge", f"WITH {COPURCHASE}, {_NODE_EDGE} SELECT src, dst FROM node_edges")
def random_node_edge(spark, sf):
    return sampling.random_node_edges(fx.copurchase(spark, sf), 500, SEED)


@query("F05_random_edge", f"WITH {COPURCHASE} SELECT src, dst FROM edges ORDER BY md5(src || ':' || dst || ':{SEED}'), src, dst LIMIT 1000")
def random_edge(spark, sf):
    return sampling.random_edges(fx.copurchase(spark, sf).edges, 1000, SEED)


@query("F05_random_edge_induced", f"""WITH {COPURCHASE}, picked AS (SELECT unnest([src, dst]) AS id FROM
  (SELECT src, dst FROM edges ORDER BY md5(src || ':' || dst || ':{SEED}'), src, dst LIMIT 300)) {induced_sql('picked')}""")
def random_edge_induced(spark, sf):
    return sampling.random_edges_induced(fx.copurchase(spark, sf), 300, SEED).edges.select("src", "dst")


@query("F05_hybrid_edges", f"""WITH {COPURCHASE}, {_NODE_EDGE} SELECT src, dst FROM node_edges UNION
(SELECT src, dst FROM edges ORDER BY md5(src || ':' || dst || ':{SEED + 2}'), src, dst LIMIT 500)""")
def hybrid_edges(spark, sf):
    return sampling.hybrid_edges(fx.copurchase(spark, sf), 1000, SEED)


def _start(spark, sf):
    """The vertex of highest degree, smallest id first."""
    return structure.degrees(fx.copurchase(spark, sf)).orderBy(F.desc("degree"), "id").limit(1).select("id")


_START = f"{DEGREES}, {BOTH}, start AS (SELECT id FROM degrees ORDER BY degree DESC, id LIMIT 1)"


def _snowball_sql(hops: int, fanout: int, limit: int) -> str:
    parts = ["s0 AS MATERIALIZED (SELECT id FROM start), f0 AS MATERIALIZED (SELECT id FROM start)"]
    for k in range(1, hops + 1):
        parts.append(f"""f{k} AS MATERIALIZED (SELECT id FROM (SELECT DISTINCT n AS id FROM (SELECT id, n FROM nb WHERE id IN (SELECT id FROM f{k - 1})
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY md5(id || ':' || n || ':{SEED}'), n) <= {fanout}) WHERE n NOT IN (SELECT id FROM s{k - 1}))
  ORDER BY md5(id || ':{SEED + 1}'), id LIMIT (SELECT {limit} - count(*) FROM s{k - 1})),
s{k} AS MATERIALIZED (SELECT id FROM s{k - 1} UNION ALL SELECT id FROM f{k})""")
    return ",\n".join(parts)


@query("F06_snowball", f"{_START}, {_snowball_sql(4, 10, 1000)}, picked AS (SELECT id FROM s4) {induced_sql('picked')}")
def snowball(spark, sf):
    graph = fx.copurchase(spark, sf)
    return graph.induced(sampling.snowball(graph, _start(spark, sf), 4, 10, 1000, SEED)).edges.select("src", "dst")


@query("F07_forest_fire", f"""{_START.replace('WITH', 'WITH RECURSIVE', 1)}, fire AS (SELECT id FROM start UNION
  SELECT nb.n FROM fire JOIN nb USING (id) WHERE {unit_sql("least(id, n) || ':' || greatest(id, n)")} < 0.03)
SELECT id FROM fire""")
def forest_fire(spark, sf):
    graph = fx.copurchase(spark, sf)
    return sampling.forest_fire(graph, _start(spark, sf), 0.03, SEED)


def _walk_sql(length: int, backtrack: bool = True, each: int = 1) -> str:
    parts = [f"""{DEGREES}, {BOTH},
slots AS MATERIALIZED (SELECT id AS node, n AS next, row_number() OVER (PARTITION BY id ORDER BY n) - 1 AS slot, count(*) OVER (PARTITION BY id) AS d FROM nb),
w0 AS MATERIALIZED (SELECT id || '-' || n AS walk, id AS node, NULL::BIGINT AS prev FROM vertices, range({each}) AS numbers(n))"""]
    for k in range(1, length):
        draw = bucket_sql("walk", SEED + k)
        if backtrack:
            slot = f"{draw} % s.d"
        else:
            slot = f"""CASE WHEN b.slot IS NULL THEN {draw} % s.d WHEN s.d = 1 THEN 0
      ELSE {draw} % (s.d - 1) + CASE WHEN {draw} % (s.d - 1) >= b.slot THEN 1 ELSE 0 END END"""
        parts.append(f"""w{k} AS MATERIALIZED (SELECT walk, s.next AS node, w.node AS prev FROM w{k - 1} w JOIN slots s ON s.node = w.node
  LEFT JOIN slots b ON b.node = w.node AND b.next = w.prev WHERE s.slot = {slot})""")
    union = " UNION ALL ".join(f"SELECT walk, {k} AS step, node FROM w{k}" for k in range(length))
    return ",\n".join(parts) + f", walks AS ({union})"


@query("G01_random_walks", f"{_walk_sql(80, each=10)} SELECT walk, step, node FROM walks")
def random_walks(spark, sf):
    """Ten walks of 80 from every vertex."""
    return sampling.random_walks(fx.copurchase(spark, sf), 80, 10)


_FEW_WALKS = "(substr(walk, 1, length(walk) - 2)::BIGINT) % 97 = 0"


@query("F08_random_walk_sample", f"{_walk_sql(16)}, picked AS (SELECT DISTINCT node AS id FROM walks WHERE {_FEW_WALKS}) {induced_sql('picked')}")
def random_walk_sample(spark, sf):
    """Subgraph among all the vertices that the walks from one in 97 vertices visit."""
    graph = fx.copurchase(spark, sf)
    walks = sampling.random_walks(graph, 16).filter("cast(substring(walk, 1, length(walk) - 2) as bigint) % 97 = 0")
    return sampling.walk_sample(graph, walks).edges.select("src", "dst")


@query("F08_non_backtracking_walks", f"{_walk_sql(5, backtrack=False)} SELECT walk, step, node FROM walks")
def non_backtracking_walks(spark, sf):
    return sampling.random_walks(fx.copurchase(spark, sf), 5, backtrack=False)


@query("G02_biased_walks")
def biased_walks(spark, sf):
    """Second-order walks with return and in-out weights."""
    return sampling.biased_walks(fx.copurchase(spark, sf), 5, p=0.5, q=2.0)


@query("F09_diffusion_sample", f"""{_START}, i0 AS (SELECT id FROM start),
""" + ",\n".join(f"""i{k + 1} AS MATERIALIZED (SELECT id FROM i{k} UNION SELECT n FROM (SELECT id, n FROM nb WHERE id IN (SELECT id FROM i{k})
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY md5(id || ':' || n || ':{SEED + k}'), n) = 1))""" for k in range(8)) + " SELECT id FROM i8")
def diffusion_sample(spark, sf):
    return sampling.diffusion(fx.copurchase(spark, sf), _start(spark, sf), 8, SEED)


@query("F10_edge_split", f"""WITH {COPURCHASE} SELECT src, dst, CASE WHEN {bucket_sql("src || ':' || dst")} % 100 < 10 THEN 'test' ELSE 'train' END AS split FROM edges""")
def edge_split(spark, sf):
    return tabular.split_rows(fx.copurchase(spark, sf).edges.select("src", "dst"), 10, SEED, "src", "dst")


@query("F11_train_test_split", f"""SELECT doc_id, quality, CASE WHEN {bucket_sql("doc_id")} % 100 < 25 THEN 'test' ELSE 'train' END AS split FROM labels""")
def train_test_split(spark, sf):
    return tabular.split_rows(table(spark, sf, "labels").select("doc_id", "quality"), 25, SEED, "doc_id")


# --- link prediction ---------------------------------------------------------------------------


NEGATIVES = f"""numbered AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM vertices),
draws AS (SELECT DISTINCT {bucket_sql("i || ':s'")} % (SELECT count(*) FROM vertices) AS ps, {bucket_sql("i || ':d'")} % (SELECT count(*) FROM vertices) AS pd
  FROM (SELECT unnest(range(2 * (SELECT count(*) FROM edges))) AS i)),
negatives AS MATERIALIZED (SELECT s.id AS src, d.id AS dst FROM draws JOIN numbered s ON s.place = ps JOIN numbered d ON d.place = pd
  WHERE ps <> pd AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.src = s.id AND e.dst = d.id)
  ORDER BY md5(s.id || ':' || d.id || ':{SEED}'), s.id, d.id LIMIT (SELECT count(*) FROM edges))"""


def _negatives(spark, sf):
    graph = fx.copurchase(spark, sf)
    return linkpred.negative_sampling(graph, graph.edges.count(), SEED)


@query("C17_negative_sampling", f"WITH {COPURCHASE}, {NEGATIVES} SELECT src, dst FROM negatives")
def negative_sampling(spark, sf):
    return _negatives(spark, sf)


@query("U06_label_pos_neg_union", f"WITH {COPURCHASE}, {NEGATIVES} SELECT src, dst, 1 AS label FROM edges UNION ALL SELECT src, dst, 0 FROM negatives")
def label_pos_neg_union(spark, sf):
    return tabular.union_labelled(fx.copurchase(spark, sf).edges.select("src", "dst"), _negatives(spark, sf))


SCORES = f"""d AS MATERIALIZED (SELECT id, count(*) AS d FROM nb GROUP BY ALL),
common AS (SELECT x.src, x.dst, count(*) AS n, sum(1 / d.d) AS ra, sum(1 / ln(d.d)) AS aa,
    count(*) FILTER (u.kind = v.kind AND w.kind = u.kind) AS cn_same, sum(1 / d.d) FILTER (u.kind = v.kind AND w.kind = u.kind) AS ra_same
  FROM asked x JOIN nb a ON a.id = x.src JOIN nb b ON b.id = x.dst AND b.n = a.n JOIN d ON d.id = a.n
  JOIN vertices u ON u.id = x.src JOIN vertices v ON v.id = x.dst JOIN vertices w ON w.id = a.n GROUP BY ALL),
scored AS (SELECT x.src, x.dst, round(coalesce(n / (du.d + dv.d - n), 0), 6)::DOUBLE AS jaccard, round(coalesce(ra, 0), 6)::DOUBLE AS resource_allocation,
    round(coalesce(aa, 0), 6)::DOUBLE AS adamic_adar, du.d * dv.d AS preferential_attachment,
    coalesce(n, 0) + coalesce(cn_same, 0) AS cn_soundarajan_hopcroft, round(coalesce(ra_same, 0), 6)::DOUBLE AS ra_soundarajan_hopcroft
  FROM asked x JOIN d du ON du.id = x.src JOIN d dv ON dv.id = x.dst LEFT JOIN common USING (src, dst))"""
_FLOATS = ("jaccard", "resource_allocation", "adamic_adar", "ra_soundarajan_hopcroft")


def _scored(spark, sf, pairs=None):
    graph = fx.copurchase(spark, sf)
    pairs = undirected_pairs(graph.edges) if pairs is None else pairs
    community = graph.vertices.select("id", F.col("kind").alias("community"))
    return rounded(linkpred.pair_features(graph, pairs, community), *_FLOATS)


def _score_query(key: str, score: str):
    @query(key, f"WITH {COPURCHASE}, {BOTH}, asked AS (SELECT src, dst FROM pairs), {SCORES} SELECT src, dst, {score} FROM scored")
    def run(spark, sf):
        return _scored(spark, sf).select("src", "dst", score)

    return run


for _key, _score in (
    ("L01_jaccard", "jaccard"), ("L02_resource_allocation", "resource_allocation"), ("L03_adamic_adar", "adamic_adar"),
    ("L04_preferential_attachment", "preferential_attachment"), ("L05_cn_soundarajan_hopcroft", "cn_soundarajan_hopcroft"),
    ("L06_ra_soundarajan_hopcroft", "ra_soundarajan_hopcroft"),
):
    _score_query(_key, _score)


@query("L07_pair_feature_table", f"""WITH {COPURCHASE}, {BOTH}, {NEGATIVES},
labelled AS (SELECT src, dst, 1 AS label FROM edges UNION ALL SELECT src, dst, 0 FROM negatives), asked AS (SELECT src, dst FROM labelled), {SCORES}
SELECT * FROM labelled JOIN scored USING (src, dst)""")
def pair_feature_table(spark, sf):
    """All six scores of every edge and of as many non-edges."""
    labelled = tabular.union_labelled(fx.copurchase(spark, sf).edges.select("src", "dst"), _negatives(spark, sf))
    return labelled.join(_scored(spark, sf, labelled), ["src", "dst"])


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


#: every vertex's vector, zeros where it has none
FILLED = """emb AS MATERIALIZED (SELECT id, coalesce(embedding::DOUBLE[], list_resize([]::DOUBLE[], 64, 0.0::DOUBLE)) AS v FROM vertices LEFT JOIN embeddings ON vec_id = id)"""


@query("L08_dot_product_score", f"""WITH {COPURCHASE}, {FILLED} SELECT src, dst, round(list_dot_product(a.v, b.v), 6) AS score
FROM edges JOIN emb a ON a.id = src JOIN emb b ON b.id = dst""")
def dot_product_score(spark, sf):
    return rounded(linkpred.dot_scores(fx.copurchase(spark, sf).edges, vectors(spark, sf)), "score")


@query("C16_pair_feature_join", f"""WITH {COPURCHASE}, {FILLED}, c AS (SELECT src, dst, list_concat(a.v, b.v) AS x
  FROM edges JOIN emb a ON a.id = src JOIN emb b ON b.id = dst)
SELECT src, dst, len(x) AS width, round(list_sum(x), 5) AS total, round(x[65], 6) AS first_of_dst FROM c""")
def pair_feature_join(spark, sf):
    """Both ends' vectors as one, shown by its width, sum and the first value of its second half."""
    x = linkpred.concat_vectors(fx.copurchase(spark, sf).edges, vectors(spark, sf)).withColumn("x", F.col("vector").cast("array<double>"))
    return x.select("src", "dst", F.size("x").cast("bigint").alias("width"),
                    F.round(F.aggregate("x", F.lit(0.0), lambda a, b: a + b), 5).alias("total"), F.round(F.col("x")[64], 6).alias("first_of_dst"))
