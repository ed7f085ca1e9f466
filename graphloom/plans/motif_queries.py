"""Motif queries on the forum graph and the co-purchase graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions.vectors import cosine_similarity
from graphloom.operators import motifs
from graphloom.plans.fixtures import COPURCHASE, FORUM, copurchase, forum, table
from graphloom.plans.registry import query

G4 = "(a)-[e]->(b); (b)-[e2]->(c); (c)-[e3]->(a)"
G5 = "(a)-[e]->(b); (a)-[e2]->(c); (c)-[e3]->(b)"
SIX = {"a_type": "a", "e_relationship": "e", "b_type": "b", "e2_relationship": "e2", "c_type": "c", "e3_relationship": "e3"}

# (result column, SQL) for the plain three-edge signature
_SIX_SQL = """a.type AS a_type, e.relationship AS e_relationship, b.type AS b_type,
  e2.relationship AS e2_relationship, c.type AS c_type, e3.relationship AS e3_relationship"""


def _triangle_sql(wedge: str, closing: str) -> str:
    """Two clauses meet at c first; the third closes on two keys."""
    return f"""WITH {FORUM},
wedge AS MATERIALIZED (SELECT {wedge} FROM edges e2 JOIN edges e3 ON e3.src = e2.dst)
SELECT {_SIX_SQL}, count(*) AS n
FROM (SELECT w.*, e.relationship AS r1, e.src AS a_id, e.dst AS b_id FROM wedge w JOIN edges e ON {closing}) m
JOIN vertices a ON a.id = m.a_id JOIN vertices b ON b.id = m.b_id JOIN vertices c ON c.id = m.c_id
GROUP BY ALL""".replace("e.relationship AS e_relationship", "m.r1 AS e_relationship").replace(
        "e2.relationship AS e2_relationship", "m.r2 AS e2_relationship").replace(
        "e3.relationship AS e3_relationship", "m.r3 AS e3_relationship")


_WEDGE = "e2.src AS s, e2.dst AS c_id, e3.dst AS t, e2.relationship AS r2, e3.relationship AS r3"


def _triangles(spark, sf, pattern):
    counted = motifs.triangle_counts(forum(spark, sf), pattern)
    return counted.select(*[F.col(c).alias(name) for name, c in SIX.items()], "n")


@query("M03_motif_g5", _triangle_sql(_WEDGE, "e.src = w.s AND e.dst = w.t"))
def motif_g5(spark, sf):
    """Divergent triangle: a points at b and c, c points at b."""
    return _triangles(spark, sf, G5)


@query("M02_motif_g4", _triangle_sql(_WEDGE, "e.dst = w.s AND e.src = w.t"))
def motif_g4(spark, sf):
    """Directed three-cycle."""
    return _triangles(spark, sf, G4)


@query("M02_cycle_matches", f"""WITH {COPURCHASE}
SELECT e.src AS a, e2.src AS b, e3.src AS c
FROM edges e JOIN edges e2 ON e2.src = e.dst JOIN edges e3 ON e3.src = e2.dst AND e3.dst = e.src""")
def cycle_matches(spark, sf):
    """Every binding of the directed three-cycle among parts."""
    return motifs.triangle_matches(copurchase(spark, sf), G4, edge_label=None, vertex_label=None).select("a", "b", "c")


@query("M01_motif_find", f"""WITH {FORUM}, found AS MATERIALIZED (
SELECT e.src AS a_id, e.relationship AS e_relationship, e.dst AS b_id, e2.relationship AS e2_relationship, e2.dst AS c_id
FROM edges e JOIN edges e2 ON e2.src = e.dst) SELECT * FROM found""")
def motif_find(spark, sf):
    found = motifs.find(forum(spark, sf), "(a)-[e]->(b); (b)-[e2]->(c)", vertex_columns=[])
    return found.select(
        F.col("a.id").alias("a_id"), F.col("e.relationship").alias("e_relationship"), F.col("b.id").alias("b_id"),
        F.col("e2.relationship").alias("e2_relationship"), F.col("c.id").alias("c_id"))


@query("M04_motif_g6", f"""WITH {FORUM}
SELECT {_SIX_SQL}, count(*) AS n
FROM edges e JOIN edges e2 ON e2.src = e.dst JOIN edges e3 ON e3.src = e2.dst
JOIN vertices a ON a.id = e.src JOIN vertices b ON b.id = e.dst JOIN vertices c ON c.id = e2.dst
GROUP BY ALL""")
def motif_g6(spark, sf):
    """Three-step path, grouped without its last vertex."""
    counted = motifs.path_counts(
        forum(spark, sf), [{"a_type": "type"}, {"b_type": "type"}, {"c_type": "type"}])
    return counted.withColumnsRenamed({"e1": "e_relationship", "e2": "e2_relationship", "e3": "e3_relationship"})


@query("D05_g6_vote_signature", f"""WITH {FORUM}
SELECT a.vote_type AS a_vote_type, {_SIX_SQL}, count(*) AS n
FROM edges e JOIN edges e2 ON e2.src = e.dst JOIN edges e3 ON e3.src = e2.dst
JOIN vertices a ON a.id = e.src JOIN vertices b ON b.id = e.dst JOIN vertices c ON c.id = e2.dst
WHERE a.type = 'Vote' GROUP BY ALL""")
def g6_vote_signature(spark, sf):
    """Three-step paths that start at a vote, also by the kind of vote."""
    counted = motifs.path_counts(
        forum(spark, sf),
        [{"a_type": "type", "a_vote_type": "vote_type"}, {"b_type": "type"}, {"c_type": "type"}],
        where=[F.col("type") == "Vote", None, None],
    )
    return counted.withColumnsRenamed({"e1": "e_relationship", "e2": "e2_relationship", "e3": "e3_relationship"})


_STAR_JOIN = """FROM edges e JOIN edges e2 ON e2.dst = e.src JOIN edges e3 ON e3.dst = e.src
JOIN vertices a ON a.id = e.src JOIN vertices b ON b.id = e.dst
JOIN vertices c ON c.id = e2.src JOIN vertices d ON d.id = e3.src"""
_STAR_NAMES = {"e1": "e_relationship", "e2": "e2_relationship", "e3": "e3_relationship"}


@query("M05_motif_g10", f"""WITH {FORUM}
SELECT {_SIX_SQL}, d.type AS d_type, count(*) AS n {_STAR_JOIN} GROUP BY ALL""")
def motif_g10(spark, sf):
    """Convergent star: c and d point at a, a points at b."""
    counted = motifs.star_counts(
        forum(spark, sf), {"a_type": "type"}, [{"b_type": "type"}], [{"c_type": "type"}, {"d_type": "type"}])
    return counted.withColumnsRenamed(_STAR_NAMES)


@query("D06_g10_vote_signature", f"""WITH {FORUM}
SELECT {_SIX_SQL}, d.type AS d_type, c.vote_type AS c_vote_type, d.vote_type AS d_vote_type, count(*) AS n {_STAR_JOIN}
WHERE c.type = 'Vote' AND d.type = 'Vote' AND e3.relationship = 'CastFor' GROUP BY ALL""")
def g10_vote_signature(spark, sf):
    """The star with two votes pointing in, by the kinds of both votes."""
    counted = motifs.star_counts(
        forum(spark, sf),
        {"a_type": "type"},
        [{"b_type": "type"}],
        [{"c_type": "type", "c_vote_type": "vote_type"}, {"d_type": "type", "d_vote_type": "vote_type"}],
        in_where=F.col("type") == "Vote",
    )
    return counted.withColumnsRenamed(_STAR_NAMES).filter("e3_relationship = 'CastFor'")


@query("D03_three_edge_count", f"""WITH {FORUM}
SELECT {_SIX_SQL}, count(*) AS n
FROM edges e JOIN edges e2 ON e2.src = e.dst JOIN edges e3 ON e3.src = e2.dst
JOIN vertices a ON a.id = e.src JOIN vertices b ON b.id = e.dst JOIN vertices c ON c.id = e2.dst
GROUP BY ALL""")
def three_edge_count(spark, sf):
    """The signature count of a chain of three edges, by counts carried along the path."""
    counted = motifs.path_counts(
        forum(spark, sf), [{"a_type": "type"}, {"b_type": "type"}, {"c_type": "type"}])
    return counted.withColumnsRenamed({"e1": "e_relationship", "e2": "e2_relationship", "e3": "e3_relationship"})


_FOUR_CYCLE_SQL = f"""WITH {FORUM}
SELECT a.type AS a_type, e.relationship AS e_relationship, b.type AS b_type, e2.relationship AS e2_relationship,
  c.type AS c_type, e3.relationship AS e3_relationship, d.type AS d_type, e4.relationship AS e4_relationship, count(*) AS n
FROM edges e JOIN edges e2 ON e2.src = e.dst JOIN edges e3 ON e3.src = e2.dst
JOIN edges e4 ON e4.src = e3.dst AND e4.dst = e.src
JOIN vertices a ON a.id = e.src JOIN vertices b ON b.id = e.dst JOIN vertices c ON c.id = e2.dst JOIN vertices d ON d.id = e3.dst
GROUP BY ALL"""


@query("M06_motif_g14", _FOUR_CYCLE_SQL)
def motif_g14(spark, sf):
    """Directed four-cycle, counted by meeting at the two opposite ends."""
    return motifs.four_cycle_counts(forum(spark, sf)).withColumnsRenamed({
        "a": "a_type", "b": "b_type", "c": "c_type", "d": "d_type", "e1": "e_relationship",
        "e2": "e2_relationship", "e3": "e3_relationship", "e4": "e4_relationship"})


@query("D04_four_edge_count", _FOUR_CYCLE_SQL)
def four_edge_count(spark, sf):
    """The same counts over listed matches."""
    found = motifs.find(
        forum(spark, sf), "(a)-[e]->(b); (b)-[e2]->(c); (c)-[e3]->(d); (d)-[e4]->(a)", vertex_columns=["type"])
    return motifs.signature_count(found, {
        "a_type": "a.type", "e_relationship": "e.relationship", "b_type": "b.type", "e2_relationship": "e2.relationship",
        "c_type": "c.type", "e3_relationship": "e3.relationship", "d_type": "d.type", "e4_relationship": "e4.relationship"})


@query("M07_motif_two_path", f"""WITH {FORUM}, found AS MATERIALIZED (
SELECT e.src, e.dst, e.relationship FROM edges e JOIN edges e2 ON e2.dst = e.src) SELECT * FROM found""")
def motif_two_path(spark, sf):
    """a -> b with c -> a, the first edge's own columns."""
    found = motifs.find(forum(spark, sf), "(a)-[e]->(b); (c)-[e2]->(a)", vertex_columns=[])
    return motifs.expand(found, "e")


_FILTERED_SQL = f"""WITH {FORUM}, found AS MATERIALIZED (
SELECT a.id AS a_id, a.type AS a_type, e.relationship AS e_relationship, b.id AS b_id, b.type AS b_type,
  e2.relationship AS e2_relationship, c.id AS c_id, c.type AS c_type, e3.relationship AS e3_relationship, d.type AS d_type
FROM edges e JOIN edges e2 ON e2.dst = e.dst JOIN edges e3 ON e3.dst = e2.src
JOIN vertices a ON a.id = e.src JOIN vertices b ON b.id = e.dst
JOIN vertices c ON c.id = e2.src JOIN vertices d ON d.id = e3.src
WHERE a.type = 'User' AND b.type = 'Post' AND c.type = 'Post' AND d.type = 'User' AND e3.relationship = 'Answers') SELECT * FROM found"""


def _filtered(spark, sf, **how):
    return motifs.find(
        forum(spark, sf), "(a)-[e]->(b); (c)-[e2]->(b); (d)-[e3]->(c)",
        where={"a": F.col("type") == "User", "b": F.col("type") == "Post", "c": F.col("type") == "Post",
               "d": F.col("type") == "User", "e3": F.col("relationship") == "Answers"},
        vertex_columns=["type"], **how)


_MATCH_FIELDS = {
    "a_id": "a.id", "a_type": "a.type", "e_relationship": "e.relationship", "b_id": "b.id", "b_type": "b.type",
    "e2_relationship": "e2.relationship", "c_id": "c.id", "c_type": "c.type",
    "e3_relationship": "e3.relationship", "d_type": "d.type"}


@query("M08_motif_filtered_path", _FILTERED_SQL)
def motif_filtered_path(spark, sf):
    """Users whose post is answered, and who wrote the answer; predicates reach the scans."""
    return _filtered(spark, sf).select(*[F.col(p).alias(n) for n, p in _MATCH_FIELDS.items()])


@query("B26_struct_field_project", f"""{_FILTERED_SQL.replace('SELECT a.id', 'SELECT DISTINCT a.id')}""")
def struct_field_project(spark, sf):
    """Nested fields of a match by name."""
    found = _filtered(spark, sf, short=True).select(*[F.col(p).alias(n) for n, p in _MATCH_FIELDS.items()]).distinct()
    return motifs.with_ids(forum(spark, sf), found, ["a_id", "b_id", "c_id"])


@query("B27_motif_property_filter", f"""WITH {FORUM}, found AS MATERIALIZED (
SELECT e.src AS a_id, e.dst AS b_id, a.vote_type AS vote_type, e2.relationship AS e2_relationship, e2.dst AS c_id
FROM edges e JOIN edges e2 ON e2.src = e.dst JOIN vertices a ON a.id = e.src
WHERE a.type = 'Vote' AND a.vote_type = 'UpVote') SELECT * FROM found""")
def motif_property_filter(spark, sf):
    """Filter on properties of matched elements after the match."""
    found = motifs.find(
        forum(spark, sf), "(a)-[e]->(b); (b)-[e2]->(c)", where={"a": F.col("type") == "Vote"},
        vertex_columns=["vote_type"])
    return found.filter(F.col("a.vote_type") == "UpVote").select(
        F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), F.col("a.vote_type").alias("vote_type"),
        F.col("e2.relationship").alias("e2_relationship"), F.col("c.id").alias("c_id"))


@query("B25_expand_struct", f"""WITH {FORUM}
SELECT b.id, b.type, b.source_id FROM edges e JOIN vertices b ON b.id = e.dst WHERE e.relationship = 'Links'""")
def expand_struct(spark, sf):
    """A record column to one column per field."""
    found = motifs.find(
        forum(spark, sf), "(a)-[e]->(b)", where={"e": F.col("relationship") == "Links"},
        vertex_columns=["type", "source_id"])
    return motifs.expand(found, "b")


@query("M09_motif_collapse", f"""WITH {COPURCHASE},
groups AS (
  SELECT DISTINCT list_sort([e.src::VARCHAR, e2.src::VARCHAR, e3.src::VARCHAR]) AS ids
  FROM edges e JOIN edges e2 ON e2.src = e.dst JOIN edges e3 ON e3.src = e2.dst AND e3.dst = e.src)
SELECT array_to_string(ids, '-') AS "group", unnest(ids) AS member FROM groups""")
def motif_collapse(spark, sf):
    """Three-cycles folded into one node per member set, with their members."""
    found = motifs.triangle_matches(copurchase(spark, sf), G4, edge_label=None, vertex_label=None)
    return motifs.collapse(found, ["a", "b", "c"])


@query("M10_semantic_motif", f"""WITH {COPURCHASE},
near AS (
  SELECT e.src, e.dst, round(list_dot_product(s.embedding::DOUBLE[], d.embedding::DOUBLE[])
    / sqrt(list_dot_product(s.embedding::DOUBLE[], s.embedding::DOUBLE[]) * list_dot_product(d.embedding::DOUBLE[], d.embedding::DOUBLE[])), 6) AS cosine
  FROM edges e JOIN embeddings s ON s.vec_id = e.src JOIN embeddings d ON d.vec_id = e.dst)
SELECT p.src AS a, p.dst AS b, q.dst AS c, p.cosine FROM near p JOIN edges q ON q.src = p.dst WHERE p.cosine >= 0.2""")
def semantic_motif(spark, sf):
    """Two-step paths whose first step joins parts with similar vectors."""
    graph = copurchase(spark, sf)
    vectors = table(spark, sf, "embeddings")
    near = (
        graph.edges.join(vectors.select(F.col("vec_id").alias("src"), F.col("embedding").alias("u")), "src")
        .join(vectors.select(F.col("vec_id").alias("dst"), F.col("embedding").alias("v")), "dst")
        .select(F.col("src").alias("a"), F.col("dst").alias("b"), F.round(cosine_similarity("u", "v"), 6).alias("cosine"))
        .filter("cosine >= 0.2")
    )
    onward = graph.edges.select(F.col("src").alias("b"), F.col("dst").alias("c"))
    return near.join(onward, "b").select("a", "b", "c", "cosine")


@query("M11_multi_path_ownership", f"""WITH {FORUM}, pairs AS (SELECT DISTINCT src, dst FROM edges)
SELECT p.src AS a, q.dst AS c, count(DISTINCT p.dst) AS paths
FROM pairs p JOIN pairs q ON q.src = p.dst
WHERE p.src <> p.dst AND q.src <> q.dst AND p.src <> q.dst
GROUP BY ALL HAVING count(DISTINCT p.dst) >= 2""")
def multi_path_ownership(spark, sf):
    """Ends joined by two or more different two-step paths."""
    return motifs.multi_paths(forum(spark, sf))
