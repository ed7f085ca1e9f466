"""Pair features for link prediction and negative pairs to learn against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.hashing import bucket60, order_key
from graphloom.functions.ordering import dense_index, first_by_key
from graphloom.functions.vectors import dot
from graphloom.graph import Graph, both_ways, endpoint_rows, undirected_pairs
from graphloom.session import cut


def pair_features(graph: Graph, pairs: DataFrame, community: DataFrame) -> DataFrame:
    """Six neighbourhood scores of (src, dst) pairs, from one pass over common neighbours.

    jaccard, resource_allocation, adamic_adar, preferential_attachment and the two
    community-aware scores; ``community`` is (id, community).  Neighbourhoods are
    undirected.  A pair opens the neighbours of its lower-degree end only and looks
    them up at the other end, so a hub is never expanded against small vertices.
    """
    links = cut(both_ways(undirected_pairs(graph.edges)))
    d = links.groupBy("src").agg(F.count("*").alias("d"))
    facts = cut(
        graph.vertices.select("id").join(d.withColumnRenamed("src", "id"), "id", "left").fillna(0, ["d"])
        .join(community.select("id", "community"), "id", "left")
    )
    known = pairs.select("src", "dst").distinct()
    for end, mark in (("src", "u"), ("dst", "v")):
        known = known.join(facts.select(
            F.col("id").alias(end), F.col("d").alias(f"d_{mark}"), F.col("community").alias(f"c_{mark}")), end)
    known = cut(known)
    turn = F.col("d_u") > F.col("d_v")
    opened = known.select(
        "src", "dst",
        F.when(F.col("c_u") == F.col("c_v"), F.col("c_u")).alias("shared"),
        F.when(turn, F.col("dst")).otherwise(F.col("src")).alias("small"),
        F.when(turn, F.col("src")).otherwise(F.col("dst")).alias("big"),
    )
    common = (
        opened.join(links.select(F.col("src").alias("small"), F.col("dst").alias("w")), "small")
        .join(links.select(F.col("src").alias("big"), F.col("dst").alias("w")), ["big", "w"], "left_semi")
        .join(facts.select(F.col("id").alias("w"), F.col("d").alias("d_w"), F.col("community").alias("c_w")), "w")
    )
    same = F.col("c_w") == F.col("shared")
    # a common neighbour touches both ends, so its degree is at least 2 unless src = dst
    scores = common.groupBy("src", "dst").agg(
        F.count("*").alias("common"),
        F.sum(1 / F.col("d_w")).alias("ra"),
        F.sum(F.when(F.col("d_w") > 1, 1 / F.ln("d_w"))).alias("aa"),
        F.count_if(same).alias("cn_same"),
        F.sum(F.when(same, 1 / F.col("d_w"))).alias("ra_same"),
    )
    n = F.coalesce("common", F.lit(0))
    return known.join(scores, ["src", "dst"], "left").select(
        "src", "dst",
        F.coalesce(F.try_divide(n.cast("double"), F.col("d_u") + F.col("d_v") - n), F.lit(0.0)).alias("jaccard"),
        F.coalesce("ra", F.lit(0.0)).alias("resource_allocation"),
        F.coalesce("aa", F.lit(0.0)).alias("adamic_adar"),
        (F.col("d_u") * F.col("d_v")).alias("preferential_attachment"),
        (n + F.coalesce("cn_same", F.lit(0))).alias("cn_soundarajan_hopcroft"),
        F.coalesce("ra_same", F.lit(0.0)).alias("ra_soundarajan_hopcroft"),
    )


def negative_sampling(graph: Graph, n: int, seed: int, per_edge: int = 2) -> DataFrame:
    """n ordered vertex pairs that are no edges and no self pairs, seeded.

    Candidates are drawn from the numbered vertices by hash, then real edges are
    anti-joined away; if too few are left, further draws are added to those made.  The complement of
    the graph is never built.
    """
    numbered = cut(dense_index(graph.vertices.select("id"), ["id"], "place"))
    size = numbered.count()
    edges = graph.edges.select("src", "dst").distinct()
    room = size * (size - 1) - edges.filter("src <> dst").count()
    if n > room:
        raise ValueError(f"only {room} pairs are not edges, {n} were asked for")
    spread = graph.vertices.sparkSession.range
    drawn, draws, found = 0, n * per_edge, None
    while True:
        ends = spread(drawn, draws).select(
            F.pmod(bucket60(seed, "id", F.lit("s")), F.lit(size)).alias("ps"),
            F.pmod(bucket60(seed, "id", F.lit("d")), F.lit(size)).alias("pd"),
        )
        candidates = (
            ends.filter("ps <> pd").distinct()
            .join(numbered.select(F.col("place").alias("ps"), F.col("id").alias("src")), "ps")
            .join(numbered.select(F.col("place").alias("pd"), F.col("id").alias("dst")), "pd")
            .select("src", "dst").join(edges, ["src", "dst"], "left_anti")
        )
        found = cut(candidates if found is None else found.unionByName(candidates).distinct())
        if found.count() >= n:
            return first_by_key(found, order_key(seed, "src", "dst"), ["src", "dst"], n)
        drawn, draws = draws, draws * 2


def pair_vectors(pairs: DataFrame, vectors: DataFrame, width: int | None = None) -> DataFrame:
    """Both ends' vectors next to each pair as ``u`` and ``v``; an end without a vector has zeros.

    ``width`` is that of the vectors; where it is not given, the longest one's is looked up.
    """
    kind = vectors.schema["vector"].dataType
    if width is None:
        width = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    none = F.array_repeat(F.lit(0.0), width).cast(kind)
    ends = pairs.join(vectors.select(F.col("id").alias("src"), F.col("vector").alias("u")), "src", "left").join(
        vectors.select(F.col("id").alias("dst"), F.col("vector").alias("v")), "dst", "left")
    return ends.withColumn("u", F.coalesce("u", none)).withColumn("v", F.coalesce("v", none))


def concat_vectors(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    return pair_vectors(pairs, vectors).withColumn("vector", F.concat("u", "v")).drop("u", "v")


def dot_scores(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    return pair_vectors(pairs, vectors).withColumn("score", dot("u", "v")).drop("u", "v")


def total_degree(edges: DataFrame) -> DataFrame:
    return endpoint_rows(edges).groupBy("id").agg(F.count("*").alias("degree"))
