"""Degree, density, clustering and null-model queries on the co-purchase graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions.ordering import exact_median
from graphloom.graph import edge_ends
from graphloom.operators import structure, tabular
from graphloom.plans import fixtures as fx
from graphloom.plans.fixtures import COPURCHASE, COSHIP, FORUM, table
from graphloom.plans.registry import query

DEGREES = f"""WITH {COPURCHASE},
o AS (SELECT src AS id, count(*) AS out_degree FROM edges GROUP BY ALL), i AS (SELECT dst AS id, count(*) AS in_degree FROM edges GROUP BY ALL),
degrees AS (SELECT id, coalesce(in_degree, 0) AS in_degree, coalesce(out_degree, 0) AS out_degree,
  coalesce(in_degree, 0) + coalesce(out_degree, 0) AS degree FROM vertices LEFT JOIN o USING (id) LEFT JOIN i USING (id))"""
PAIRS = "pairs AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM edges WHERE src <> dst)"
BOTH = PAIRS + ", nb AS (SELECT src AS id, dst AS n FROM pairs UNION ALL SELECT dst, src FROM pairs)"


def rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("D12_degrees", f"{DEGREES} SELECT * FROM degrees")
def degrees(spark, sf):
    return structure.degrees(fx.copurchase(spark, sf))


@query("C12_join_degree", f"""WITH {COSHIP}, d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY ALL)
SELECT id, brand, coalesce(degree, 0) AS degree FROM vertices LEFT JOIN d USING (id)""")
def join_degree(spark, sf):
    return structure.join_degree(fx.coship(spark, sf)).vertices.select("id", "brand", "degree")


@query("C12_join_degree_inner", f"""WITH {COSHIP}, d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY ALL)
SELECT id, brand, degree FROM vertices JOIN d USING (id)""")
def join_degree_inner(spark, sf):
    """The form that drops isolated vertices."""
    return structure.join_degree(fx.coship(spark, sf), keep_isolates=False).vertices.select("id", "brand", "degree")


@query("C13_join_type_degree", f"""WITH {FORUM} SELECT id, relationship, count(*) AS n FROM vertices JOIN edges ON src = id GROUP BY id, relationship""")
def join_type_degree(spark, sf):
    """The map column, shown as one row per entry."""
    return structure.join_type_degree(fx.forum(spark, sf)).vertices.select("id", F.explode("type_degree").alias("relationship", "n"))


@query("D11_degree_summary", f"""{DEGREES} SELECT (SELECT count(*) FROM vertices) AS n, (SELECT count(*) FROM edges) AS m,
  round(avg(degree), 6) AS mean_degree, median(degree)::DOUBLE AS median_degree,
  round((SELECT count(*) FROM edges) / (SELECT count(*) FROM vertices), 6) AS edges_per_node FROM degrees""")
def degree_summary(spark, sf):
    return rounded(structure.degree_summary(fx.copurchase(spark, sf)), "mean_degree", "edges_per_node")


@query("D13_density", f"""WITH {COPURCHASE}, {PAIRS}, s AS (SELECT count(*) * (count(*) - 1) AS room FROM vertices)
SELECT round((SELECT count(*) FROM edges) / room, 6) AS directed, round(2 * (SELECT count(*) FROM pairs) / room, 6) AS undirected FROM s""")
def density(spark, sf):
    return rounded(structure.density(fx.copurchase(spark, sf)), "directed", "undirected")


@query("D23_prob_vector", f"{DEGREES} SELECT id, degree, round(degree / sum(degree) OVER (), 9) AS p FROM degrees")
def prob_vector(spark, sf):
    shares = tabular.share_of_total(structure.degrees(fx.copurchase(spark, sf)), "degree", "p")
    return shares.select("id", "degree", F.round("p", 9).alias("p"))


@query("B16_log10_scale", f"""{DEGREES} SELECT id, round(log10(degree + 1e-6), 6) AS log_degree,
  round(log10(in_degree / (SELECT count(*) - 1 FROM vertices) + 1e-10), 6) AS log_in_centrality FROM degrees""")
def log10_scale(spark, sf):
    graph = fx.copurchase(spark, sf)
    both = structure.degrees(graph).join(structure.degree_centrality(graph), "id")
    return both.select("id", F.round(F.log10(F.col("degree") + 1e-6), 6).alias("log_degree"),
                       F.round(F.log10(F.col("in_centrality") + 1e-10), 6).alias("log_in_centrality"))


@query("B17_degree_offset", f"""WITH {COSHIP}, d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY ALL)
SELECT id, degree + 1 AS plus_one, round(degree + 0.01, 6)::DOUBLE AS plus_hundredth FROM d WHERE degree > 0""")
def degree_offset(spark, sf):
    d = structure.degrees(fx.coship(spark, sf)).filter("degree > 0")
    return d.select("id", (F.col("degree") + 1).alias("plus_one"), F.round(F.col("degree") + F.lit(0.01), 6).alias("plus_hundredth"))


@query("E11_degree_centrality", f"""{DEGREES}, s AS (SELECT count(*) - 1 AS n FROM vertices)
SELECT id, round(degree / n, 6) AS degree_centrality, round(in_degree / n, 6) AS in_centrality, round(out_degree / n, 6) AS out_centrality FROM degrees, s""")
def degree_centrality(spark, sf):
    return rounded(structure.degree_centrality(fx.copurchase(spark, sf)), "degree_centrality", "in_centrality", "out_centrality")


@query("E16_degree_assortativity", f"""{DEGREES}
SELECT round(corr(s.out_degree, d.in_degree), 6) AS out_in, round(corr(s.out_degree, d.out_degree), 6) AS out_out,
  round(corr(s.in_degree, d.in_degree), 6) AS in_in, round(corr(s.in_degree, d.out_degree), 6) AS in_out
FROM edges JOIN degrees s ON s.id = src JOIN degrees d ON d.id = dst""")
def degree_assortativity(spark, sf):
    return rounded(structure.degree_assortativity(fx.copurchase(spark, sf)), "out_in", "out_out", "in_in", "in_out")


@query("E18_remove_isolates", f"WITH {COSHIP} SELECT id, brand FROM vertices WHERE id IN (SELECT src FROM edges UNION SELECT dst FROM edges)")
def remove_isolates(spark, sf):
    return fx.coship(spark, sf).without_isolates().vertices.select("id", "brand")


@query("E19_degree_gt_zero_subgraph", f"""WITH {COSHIP}, keep AS (SELECT id FROM vertices WHERE size <= 25),
sub AS (SELECT src, dst FROM edges WHERE src IN (SELECT id FROM keep) AND dst IN (SELECT id FROM keep))
SELECT id FROM keep WHERE id IN (SELECT src FROM sub UNION SELECT dst FROM sub)""")
def degree_gt_zero_subgraph(spark, sf):
    graph = fx.coship(spark, sf)
    return graph.induced(graph.vertices.filter("size <= 25")).without_isolates().vertices.select("id")


@query("E21_supernode_cutoff", f"""{DEGREES}, heavy AS (SELECT id FROM degrees WHERE degree > 50)
SELECT src, dst FROM edges WHERE src NOT IN (SELECT id FROM heavy) AND dst NOT IN (SELECT id FROM heavy)""")
def supernode_cutoff(spark, sf):
    return fx.copurchase(spark, sf).without_supernodes(50).edges.select("src", "dst")


@query("E29_temporal_violations", f"""WITH {COPURCHASE}, dates AS (SELECT l_partkey AS id, min(l_shipdate) AS published FROM lineitem GROUP BY ALL)
SELECT src, dst FROM edges JOIN dates s ON s.id = src JOIN dates d ON d.id = dst WHERE s.published < d.published""")
def temporal_violations(spark, sf):
    dates = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.min("l_shipdate").alias("published"))
    return structure.temporal_violations(fx.copurchase(spark, sf).edges, dates).select("src", "dst")


@query("E30_reciprocal_edges", f"WITH {COPURCHASE} SELECT a.src, a.dst FROM edges a JOIN edges b ON b.src = a.dst AND b.dst = a.src WHERE a.src < a.dst")
def reciprocal_edges(spark, sf):
    return structure.reciprocal_pairs(fx.copurchase(spark, sf).edges)


_TRIANGLES = f"""WITH {COPURCHASE}, {PAIRS},
found AS (SELECT x.src AS a, x.dst AS b, y.dst AS c FROM pairs x JOIN pairs y ON y.src = x.dst JOIN pairs z ON z.src = x.src AND z.dst = y.dst),
corners AS (SELECT id, count(*) AS t FROM (SELECT unnest([a, b, c]) AS id FROM found) GROUP BY ALL)"""


@query("E07_triangle_count", f"{_TRIANGLES} SELECT id, coalesce(t, 0) AS triangles FROM vertices LEFT JOIN corners USING (id)")
def triangle_count(spark, sf):
    return structure.triangle_count(fx.copurchase(spark, sf))


@query("E08_clustering_undirected", f"""{_TRIANGLES},
d AS (SELECT id, count(*) AS d FROM (SELECT src AS id FROM pairs UNION ALL SELECT dst FROM pairs) GROUP BY ALL)
SELECT id, round(CASE WHEN d > 1 THEN coalesce(2.0 * t / (d * (d - 1)), 0) ELSE 0 END, 6)::DOUBLE AS clustering FROM vertices LEFT JOIN d USING (id) LEFT JOIN corners USING (id)""")
def clustering_undirected(spark, sf):
    return rounded(structure.clustering_undirected(fx.copurchase(spark, sf)), "clustering")


FAGIOLO = """wpairs AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, count(*) AS w FROM edges GROUP BY ALL),
wfound AS (SELECT x.src AS a, x.dst AS b, y.dst AS c, x.w * y.w * z.w AS w FROM wpairs x JOIN wpairs y ON y.src = x.dst JOIN wpairs z ON z.src = x.src AND z.dst = y.dst),
wcorners AS (SELECT id, sum(w) AS t FROM (SELECT unnest([a, b, c]) AS id, w FROM wfound) GROUP BY ALL),
wroom AS (SELECT id, sum(w) * (sum(w) - 1) - 2 * count(*) FILTER (w = 2) AS room FROM (SELECT src AS id, w FROM wpairs UNION ALL SELECT dst, w FROM wpairs) GROUP BY ALL),
clustering AS (SELECT id, coalesce(t / nullif(room, 0), 0)::DOUBLE AS clustering FROM vertices LEFT JOIN wroom USING (id) LEFT JOIN wcorners USING (id))"""


@query("E09_clustering_directed", f"WITH {COPURCHASE}, {FAGIOLO} SELECT id, round(clustering, 6) AS clustering FROM clustering")
def clustering_directed(spark, sf):
    return rounded(structure.clustering_directed(fx.copurchase(spark, sf)), "clustering")


@query("E09_clustering_summary", f"WITH {COPURCHASE}, {FAGIOLO} SELECT round(avg(clustering), 6) AS mean, round(median(clustering), 6) AS median FROM clustering")
def clustering_summary(spark, sf):
    """Mean and median over all vertices."""
    c = structure.clustering_directed(fx.copurchase(spark, sf))
    return rounded(c.agg(F.avg("clustering").alias("mean")).join(F.broadcast(exact_median(c, "clustering", "median"))), "mean", "median")


DISPERSION = f"""WITH {COPURCHASE},
st AS (SELECT a.src AS u, a.dst AS v, b.dst AS s FROM edges a JOIN edges b ON b.src = a.src AND b.dst <> a.dst JOIN edges c ON c.src = a.dst AND c.dst = b.dst),
st_pairs AS (SELECT x.u, x.v, x.s, y.s AS t FROM st x JOIN st y ON x.u = y.u AND x.v = y.v AND x.s < y.s),
close AS (SELECT DISTINCT p.u, p.v, p.s, p.t FROM st_pairs p JOIN edges e ON e.src = p.s AND e.dst = p.t
  UNION SELECT p.u, p.v, p.s, p.t FROM st_pairs p JOIN edges e ON e.src = p.s JOIN edges f ON f.src = p.t AND f.dst = e.dst
        JOIN edges g ON g.src = p.u AND g.dst = e.dst WHERE e.dst <> p.v AND e.dst <> p.u),
far AS (SELECT u, v, count(*) AS far FROM (SELECT * FROM st_pairs EXCEPT SELECT * FROM close) GROUP BY ALL),
k AS (SELECT u, v, count(*) AS k FROM st GROUP BY ALL),
dispersion AS (SELECT src AS u, dst AS v, coalesce(k, 0) AS embeddedness, coalesce(far / k, 0)::DOUBLE AS dispersion
  FROM edges LEFT JOIN k ON k.u = src AND k.v = dst LEFT JOIN far ON far.u = src AND far.v = dst)"""


@query("E17_dispersion", f"{DISPERSION} SELECT u, v, embeddedness, round(dispersion, 6) AS dispersion FROM dispersion")
def dispersion(spark, sf):
    return rounded(structure.dispersion(fx.copurchase(spark, sf)), "dispersion")


@query("D18_mean_dispersion_stats", f"""{DISPERSION}
SELECT u, round(avg(dispersion), 6) AS mean, median(dispersion) AS median, max(dispersion) AS max FROM dispersion GROUP BY u""")
def mean_dispersion_stats(spark, sf):
    """Mean, median and maximum over each vertex's pairs."""
    d = structure.dispersion(fx.copurchase(spark, sf))
    return rounded(d.groupBy("u").agg(F.avg("dispersion").alias("mean"), F.median("dispersion").alias("median"), F.max("dispersion").alias("max")), "mean")


@query("E22_null_degree_compare", f"""{DEGREES}, {PAIRS},
stubs AS (SELECT id, unnest(range(1, degree + 1)) AS stub FROM degrees),
ordered AS (SELECT id, row_number() OVER (ORDER BY md5(id || ':' || stub || ':31337'), id, stub) - 1 AS place FROM stubs),
drawn AS (SELECT DISTINCT min(id) AS src, max(id) AS dst FROM ordered GROUP BY place // 2 HAVING min(id) <> max(id)),
h1 AS (SELECT d AS degree, count(*) AS observed FROM (SELECT id, count(*) AS d FROM (SELECT unnest([src, dst]) AS id FROM pairs) GROUP BY ALL) GROUP BY ALL),
h2 AS (SELECT d AS degree, count(*) AS rewired FROM (SELECT id, count(*) AS d FROM (SELECT unnest([src, dst]) AS id FROM drawn) GROUP BY ALL) GROUP BY ALL)
SELECT degree, coalesce(observed, 0) AS observed, coalesce(rewired, 0) AS rewired FROM h1 FULL JOIN h2 USING (degree)""")
def null_degree_compare(spark, sf):
    return structure.null_degree_compare(fx.copurchase(spark, sf), 31337)


@query("E23_er_expected_degrees", f"""WITH {COPURCHASE}, {PAIRS},
d AS (SELECT id, count(*) - 1 AS degree FROM (SELECT unnest([src, dst]) AS id FROM pairs UNION ALL SELECT id FROM vertices) GROUP BY ALL),
seen AS (SELECT degree, count(*) AS observed FROM d GROUP BY ALL),
f AS (SELECT n, 2.0::DOUBLE * (SELECT count(*) FROM pairs) / (n * (n - 1)) AS p FROM (SELECT count(*)::DOUBLE AS n FROM vertices))
SELECT degree, observed, round(n * exp(lgamma(n) - lgamma(degree + 1) - lgamma(n - degree) + degree * ln(p) + (n - 1 - degree) * ln(1 - p)), 6) AS expected FROM seen, f""")
def er_expected_degrees(spark, sf):
    return rounded(structure.er_expected_degrees(fx.copurchase(spark, sf)), "expected")


@query("U03_edge_ends_of_forum", f"WITH {FORUM} SELECT src AS id FROM edges UNION SELECT dst FROM edges")
def edge_ends_of_forum(spark, sf):
    return edge_ends(fx.forum(spark, sf).edges)
