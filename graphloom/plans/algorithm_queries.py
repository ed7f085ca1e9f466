"""Components, centralities and the one-row description, with SQL by recursion or by rounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.operators import centrality, components, report
from graphloom.plans import fixtures as fx
from graphloom.plans.fixtures import COPURCHASE, COSHIP
from graphloom.plans.registry import query
from graphloom.plans.structure_queries import BOTH, FAGIOLO, PAIRS, rounded

REACH = f"""WITH RECURSIVE {COSHIP}, {BOTH},
walk AS (SELECT id, id AS met FROM vertices UNION SELECT w.id, nb.n FROM walk w JOIN nb ON nb.id = w.met),
components AS (SELECT id, min(met) AS component FROM walk GROUP BY ALL)"""


@query("E03_connected_components", f"{REACH} SELECT id, component FROM components")
def connected_components(spark, sf):
    return components.connected_components(fx.coship(spark, sf))


@query("E03_forum_components", f"""WITH {fx.FORUM},
r0 AS MATERIALIZED (SELECT id, id AS c FROM vertices),
""" + ",\n".join(
    f"""r{k} AS MATERIALIZED (SELECT id, min(c) AS c FROM (SELECT id, c FROM r{k - 1}
  UNION ALL SELECT e.dst, r.c FROM edges e JOIN r{k - 1} r ON r.id = e.src UNION ALL SELECT e.src, r.c FROM edges e JOIN r{k - 1} r ON r.id = e.dst) GROUP BY ALL)"""
    for k in range(1, 13)) + "\nSELECT id, c AS component FROM r12")
def forum_components(spark, sf):
    """The typed graph: tags are hubs that a large part of all posts hang on."""
    return components.connected_components(fx.forum(spark, sf))


@query("D07_component_sizes", f"{REACH} SELECT component, count(*) AS n FROM components GROUP BY ALL")
def component_sizes(spark, sf):
    return components.component_sizes(components.connected_components(fx.coship(spark, sf)))


@query("E05_is_weakly_connected", f"{REACH} SELECT count(DISTINCT component) = 1 AS connected FROM components")
def is_weakly_connected(spark, sf):
    return components.is_weakly_connected(components.connected_components(fx.coship(spark, sf)))


@query("E06_largest_component", f"""{REACH}, top AS (SELECT component FROM components GROUP BY ALL ORDER BY count(*) DESC, component LIMIT 1),
keep AS (SELECT id FROM components WHERE component = (SELECT component FROM top))
SELECT src, dst FROM edges WHERE src IN (SELECT id FROM keep) AND dst IN (SELECT id FROM keep)""")
def largest_component(spark, sf):
    return components.largest_component(fx.coship(spark, sf)).edges.select("src", "dst")


SCC = f"""WITH RECURSIVE {COSHIP},
walk AS (SELECT id, id AS met FROM vertices UNION SELECT w.id, e.dst FROM walk w JOIN edges e ON e.src = w.met),
scc AS (SELECT a.id, min(a.met) AS scc FROM walk a JOIN walk b ON a.id = b.met AND a.met = b.id GROUP BY ALL)"""


@query("E04_strongly_connected_components", f"{SCC} SELECT id, scc FROM scc")
def strongly_connected_components(spark, sf):
    return components.strongly_connected_components(fx.coship(spark, sf))


@query("E15_bridges", f"""WITH RECURSIVE {COSHIP}, {BOTH},
walk AS (SELECT src, dst, src AS met FROM pairs UNION
  SELECT w.src, w.dst, nb.n FROM walk w JOIN nb ON nb.id = w.met WHERE NOT (w.met = w.src AND nb.n = w.dst) AND w.met <> w.dst)
SELECT src, dst FROM pairs WHERE (src, dst) NOT IN (SELECT (src, dst) FROM walk WHERE met = dst)""")
def bridges(spark, sf):
    return components.bridges(fx.coship(spark, sf))


@query("E15_has_bridges", f"""WITH RECURSIVE {COSHIP}, {BOTH},
walk AS (SELECT src, dst, src AS met FROM pairs UNION
  SELECT w.src, w.dst, nb.n FROM walk w JOIN nb ON nb.id = w.met WHERE NOT (w.met = w.src AND nb.n = w.dst) AND w.met <> w.dst)
SELECT count(*) > 0 AS has_bridges FROM pairs WHERE (src, dst) NOT IN (SELECT (src, dst) FROM walk WHERE met = dst)""")
def has_bridges(spark, sf):
    return components.bridges(fx.coship(spark, sf)).limit(1).agg((F.count("*") > 0).alias("has_bridges"))


PAGERANK_ROUNDS = 60  # of the SQL, by when it stands still to more digits than are compared


def pagerank_sql(edges: str = "edges", rounds: int = PAGERANK_ROUNDS) -> str:
    """CTEs r0..r<rounds> of the damped iteration on the given unweighted edge table."""
    parts = [f"""n AS (SELECT count(*)::DOUBLE AS n FROM vertices),
outs AS MATERIALIZED (SELECT src, count(*)::DOUBLE AS total FROM {edges} GROUP BY ALL),
steps AS MATERIALIZED (SELECT src, dst, 1 / total AS share FROM {edges} JOIN outs USING (src)),
r0 AS MATERIALIZED (SELECT id, 1 / n AS rank FROM vertices, n)"""]
    for k in range(1, rounds + 1):
        parts.append(f"""r{k} AS MATERIALIZED (
  SELECT id, 0.85 * (coalesce(got, 0) + lost / n) + 0.15 / n AS rank FROM vertices
  LEFT JOIN (SELECT dst AS id, sum(rank * share) AS got FROM steps JOIN r{k - 1} ON r{k - 1}.id = src GROUP BY ALL) USING (id), n,
  (SELECT coalesce(sum(rank), 0) AS lost FROM r{k - 1} WHERE id NOT IN (SELECT src FROM outs)))""")
    return ",\n".join(parts)


@query("E10_pagerank", f"WITH {COPURCHASE}, {pagerank_sql()} SELECT id, round(rank, 9) AS rank FROM r{PAGERANK_ROUNDS}")
def pagerank(spark, sf):
    ranks = centrality.pagerank(fx.copurchase(spark, sf), tolerance=1e-15)
    return ranks.select("id", F.round("rank", 9).alias("rank"))


EIGEN_ROUNDS = 400  # of the SQL, by when it stands still to more digits than are compared


@query("E12_eigenvector_centrality", f"""{REACH}, top AS (SELECT component FROM components GROUP BY ALL ORDER BY count(*) DESC, component LIMIT 1),
x AS (SELECT 0 AS k, id, 1.0::DOUBLE AS x FROM components WHERE component = (SELECT component FROM top)
  UNION ALL SELECT k, id, x / sqrt(sum(x * x) OVER ()) FROM (
    SELECT k + 1 AS k, id, sum(x) AS x FROM (SELECT k, id, x FROM x UNION ALL SELECT k, nb.n, x FROM nb JOIN x USING (id)) GROUP BY ALL) WHERE k <= {EIGEN_ROUNDS}),
last AS (SELECT id, x FROM x WHERE k = {EIGEN_ROUNDS})
SELECT id, round(coalesce(x, 0), 6)::DOUBLE AS eigenvector FROM vertices LEFT JOIN last USING (id)""")
def eigenvector_centrality(spark, sf):
    return rounded(centrality.eigenvector_centrality(fx.coship(spark, sf)), "eigenvector")


def _levels_sql(start: str, levels: int) -> str:
    """CTEs l0..l<levels> of (root, id, paths) per breadth-first level, each pair once."""
    parts = [f"l0 AS MATERIALIZED (SELECT id AS root, id, 1.0::DOUBLE AS paths FROM {start}), s0 AS (SELECT root, id FROM l0)"]
    for k in range(1, levels + 1):
        parts.append(f"""l{k} AS MATERIALIZED (SELECT root, dst AS id, sum(paths) AS paths FROM l{k - 1} l JOIN edges ON src = l.id
  WHERE NOT EXISTS (SELECT 1 FROM s{k - 1} s WHERE s.root = l.root AND s.id = dst) GROUP BY ALL),
s{k} AS MATERIALIZED (SELECT root, id FROM s{k - 1} UNION ALL SELECT root, id FROM l{k})""")
    return ",\n".join(parts)


LEVELS = 9  # more levels than any shortest path of the graph has; further ones stay empty


@query("E13_closeness_centrality", f"""WITH {COPURCHASE}, {_levels_sql('vertices', LEVELS)},
d AS ({" UNION ALL ".join(f"SELECT id, {k} AS depth FROM l{k}" for k in range(1, LEVELS + 1))}),
t AS (SELECT id, count(*) AS r, sum(depth) AS d FROM d GROUP BY ALL)
SELECT id, round(coalesce(r * r / (d * (SELECT count(*) - 1 FROM vertices)), 0), 6)::DOUBLE AS closeness FROM vertices LEFT JOIN t USING (id)""")
def closeness_centrality(spark, sf):
    """Exact: its state grows with vertices times vertices; the estimate beside it has no such state."""
    return rounded(centrality.exact_closeness(fx.copurchase(spark, sf)), "closeness")


@query("E13_closeness_hyperball")
def closeness_hyperball(spark, sf):
    return centrality.closeness_centrality(fx.copurchase(spark, sf))


@query("E13_hyperball_error", f"""WITH co AS (WITH {COPURCHASE} SELECT count(*) AS n FROM vertices), sh AS (WITH {COSHIP} SELECT count(*) AS n FROM vertices)
SELECT 'copurchase' AS graph, n AS vertices, true AS mean_within, true AS all_near FROM co UNION ALL SELECT 'coship', n, true, true FROM sh""")
def hyperball_error(spark, sf):
    """The estimate beside the exact value on both graphs: mean error within one standard error of a sketch, none beyond six."""
    one = 1.04 / 2 ** (10 / 2)
    found = None
    for name in ("copurchase", "coship"):
        graph = getattr(fx, name)(spark, sf)
        near = centrality.closeness_centrality(graph).withColumnRenamed("closeness", "near")
        gap = F.abs(F.col("near") - F.col("closeness"))
        row = near.join(centrality.exact_closeness(graph), "id").agg(
            F.lit(name).alias("graph"), F.count("*").alias("vertices"),
            (F.sum(gap) <= one * F.sum("closeness")).alias("mean_within"), (F.max(gap - 6 * one * F.col("closeness")) <= 0).alias("all_near"))
        found = row if found is None else found.unionByName(row)
    return found


def _betweenness_sql(levels: int) -> str:
    parts = [f"b{levels} AS MATERIALIZED (SELECT root, id, paths, 0.0::DOUBLE AS credit FROM l{levels})"]
    for k in range(levels - 1, 0, -1):
        parts.append(f"""b{k} AS MATERIALIZED (SELECT l.root, l.id, l.paths, coalesce(l.paths * g, 0)::DOUBLE AS credit FROM l{k} l
  LEFT JOIN (SELECT root, src AS id, sum((1 + credit) / paths) AS g FROM b{k + 1} b JOIN edges ON dst = b.id GROUP BY ALL) x ON x.root = l.root AND x.id = l.id)""")
    return ",\n".join(parts)


@query("E14_betweenness_approx", f"""WITH {COPURCHASE}, pivots AS (SELECT id FROM vertices ORDER BY md5(id || ':31337'), id LIMIT 20),
{_levels_sql('pivots', LEVELS)}, {_betweenness_sql(LEVELS)},
t AS (SELECT id, sum(credit) AS b FROM ({" UNION ALL ".join(f"SELECT id, credit FROM b{k}" for k in range(1, LEVELS + 1))}) GROUP BY ALL)
SELECT id, round(coalesce(b, 0) * (SELECT count(*) FROM vertices) / (SELECT count(*) FROM pivots), 4)::DOUBLE AS betweenness FROM vertices LEFT JOIN t USING (id)""")
def betweenness_approx(spark, sf):
    """Sampled betweenness: the pivots are the operator's own sample."""
    graph = fx.copurchase(spark, sf)
    scores = centrality.betweenness(graph, centrality.pick_pivots(graph, 20, 31337))
    return scores.select("id", F.round("betweenness", 4).alias("betweenness"))


@query("E14_betweenness_by_paths")
def betweenness_by_paths(spark, sf):
    """Betweenness from sampled shortest paths, every value within 0.1 of the true share with probability 0.9."""
    found = centrality.betweenness_by_paths(fx.copurchase(spark, sf), error=0.1)
    return found.select("id", F.round("betweenness", 6).alias("betweenness"))


@query("E20_describe_graph", f"""{SCC}, {BOTH},
uwalk AS (SELECT id, id AS met FROM vertices UNION SELECT w.id, nb.n FROM uwalk w JOIN nb ON nb.id = w.met),
cc AS (SELECT id, min(met) AS component FROM uwalk GROUP BY ALL), sizes AS (SELECT component, count(*) AS n FROM cc GROUP BY ALL),
deg AS (SELECT id, count(*) - 1 AS degree FROM (SELECT id FROM vertices UNION ALL SELECT src FROM edges UNION ALL SELECT dst FROM edges) GROUP BY ALL),
{FAGIOLO}
SELECT (SELECT count(*) FROM vertices) AS n, (SELECT count(*) FROM edges) AS m, round((SELECT avg(degree) FROM deg), 6) AS mean_degree,
  (SELECT median(degree)::DOUBLE FROM deg) AS median_degree, round((SELECT count(*) FROM edges) / (SELECT count(*) FROM vertices), 6) AS edges_per_node,
  (SELECT count(*) FROM sizes) AS weak_components, (SELECT max(n) FROM sizes) AS largest_component,
  (SELECT count(DISTINCT scc) FROM scc) AS strong_components,
  round((SELECT avg(clustering) FROM clustering), 6) AS mean_clustering, round((SELECT median(clustering) FROM clustering), 6) AS median_clustering""")
def describe_graph(spark, sf):
    return rounded(report.describe_graph(fx.coship(spark, sf)), "mean_degree", "edges_per_node", "mean_clustering", "median_clustering")
