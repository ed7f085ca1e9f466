"""Degrees, density, assortativity, triangles, clustering, dispersion, null models."""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.hashing import order_key
from graphloom.functions.ordering import dense_index, exact_median
from graphloom.graph import Graph, both_ways, endpoint_rows, simple_digraph, undirected_pairs
from graphloom.session import cut


def degrees(graph: Graph) -> DataFrame:
    """in, out and total degree of every vertex, isolates with zeros; a self-loop counts twice.

    Both directions come from one pass over the edges and one shuffle.
    """
    ends = graph.edges.select(
        F.explode(F.array(
            F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
            F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
        )).alias("end")
    ).select("end.*")
    zero = graph.vertices.select("id", F.lit(0).alias("o"), F.lit(0).alias("i"))
    return ends.unionByName(zero).groupBy("id").agg(
        F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"), F.sum(F.col("i") + F.col("o")).alias("degree")
    )


def join_degree(graph: Graph, keep_isolates: bool = True) -> Graph:
    """Add ``degree`` to the vertices.  ``keep_isolates=False`` drops degree-0 vertices."""
    found = endpoint_rows(graph.edges).groupBy("id").agg(F.count("*").alias("degree"))
    how = "left" if keep_isolates else "inner"
    return Graph(graph.vertices.join(found, "id", how).fillna(0, ["degree"]), graph.edges)


def join_type_degree(graph: Graph) -> Graph:
    """Add a map relationship -> out-degree to the vertices; edges without a source are left out."""
    vertices, edges, named = graph.short_ids()
    counts = (
        edges.filter(F.col("_src").isNotNull())
        .groupBy(F.col("_src").alias("_id"), "relationship")
        .agg(F.count("*").alias("n"))
    )
    # counted first, so the list per vertex holds one entry per relationship
    maps = counts.groupBy("_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("relationship", "n")))).alias("type_degree")
    )
    # the id is made again after the join
    found = vertices.drop("id").join(maps, "_id", "left").withColumn("id", named(F.col("_id")))
    return Graph(found.select(*graph.vertices.columns, "type_degree"), graph.edges)


def graph_size(graph: Graph) -> DataFrame:
    """One row: n vertices, m edges."""
    return graph.vertices.agg(F.count("*").alias("n")).join(
        F.broadcast(graph.edges.agg(F.count("*").alias("m")))
    )


def density(graph: Graph) -> DataFrame:
    """m/(n(n-1)) directed, 2m'/(n(n-1)) for the m' undirected pairs."""
    pairs = undirected_pairs(graph.edges).agg(F.count("*").alias("pairs"))
    room = F.col("n") * (F.col("n") - 1)
    return graph_size(graph).join(F.broadcast(pairs)).select(
        F.try_divide("m", room).alias("directed"), F.try_divide(2 * F.col("pairs"), room).alias("undirected")
    )


def degree_summary(graph: Graph) -> DataFrame:
    """Sizes with both readings of the mean degree (2m/n and m/n) and the median."""
    spread = degrees(graph)
    return (
        graph_size(graph)
        .join(F.broadcast(spread.agg(F.avg("degree").alias("mean_degree"))))
        .join(F.broadcast(exact_median(spread, "degree", "median_degree")))
        .withColumn("edges_per_node", F.try_divide("m", F.col("n")))
    )


def degree_centrality(graph: Graph) -> DataFrame:
    """Degrees divided by n - 1."""
    n = graph.vertices.agg((F.count("*") - 1).alias("_n"))
    return degrees(graph).join(F.broadcast(n)).select(
        "id", *[F.try_divide(F.col(d), F.col("_n")).alias(c) for c, d in (
            ("degree_centrality", "degree"), ("in_centrality", "in_degree"), ("out_centrality", "out_degree"))]
    )


def degree_assortativity(graph: Graph) -> DataFrame:
    """Pearson correlation, over edges, of a degree of the source and one of the target,
    for all four pairs.  The usual directed coefficient is (out, in)."""
    # written, so that the joins can split the edges of a hub
    d = cut(degrees(graph).select("id", "in_degree", "out_degree"))
    ends = graph.edges.select("src", "dst")
    for end, mark in (("src", "s"), ("dst", "d")):
        ends = ends.join(
            d.select(F.col("id").alias(end), F.col("in_degree").alias(f"{mark}_in"), F.col("out_degree").alias(f"{mark}_out")), end
        )
    return ends.agg(*[
        F.corr(f"s_{x}", f"d_{y}").alias(f"{x}_{y}") for x in ("out", "in") for y in ("in", "out")
    ])


def reciprocal_pairs(edges: DataFrame) -> DataFrame:
    """Pairs linked in both directions: one grouping instead of a self-join."""
    return (
        simple_digraph(edges)
        .groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(F.count("*").alias("_ways"))
        .filter("_ways = 2")
        .drop("_ways")
    )


def temporal_violations(edges: DataFrame, dates: DataFrame) -> DataFrame:
    """Edges whose source is dated before its target; undated ends never violate."""
    when = dates.select("id", "published")
    return (
        edges.join(when.select(F.col("id").alias("src"), F.col("published").alias("src_published")), "src")
        .join(when.select(F.col("id").alias("dst"), F.col("published").alias("dst_published")), "dst")
        .filter("src_published < dst_published")
    )


# --- triangles ----------------------------------------------------------------------------------


def oriented_pairs(pairs: DataFrame) -> DataFrame:
    """Undirected pairs pointed from the lower to the higher (degree, id) end.

    Every out-degree is then at most sqrt(2m), whatever the largest degree is.
    ``rank`` is the higher end's (degree, id); columns other than src and dst are kept.
    """
    d = cut(endpoint_rows(pairs).groupBy("id").agg(F.count("*").alias("_d")))
    rest = [c for c in pairs.columns if c not in ("src", "dst")]
    ranked = pairs.join(d.select(F.col("id").alias("src"), F.struct("_d", F.col("id")).alias("_rs")), "src").join(
        d.select(F.col("id").alias("dst"), F.struct("_d", F.col("id")).alias("_rd")), "dst"
    )
    turn = F.col("_rs") > F.col("_rd")
    return ranked.select(
        F.when(turn, F.col("dst")).otherwise(F.col("src")).alias("low"),
        F.when(turn, F.col("src")).otherwise(F.col("dst")).alias("high"),
        F.greatest("_rs", "_rd")["_d"].alias("rank"),
        *rest,
    )


def _wedges(first: DataFrame, second: DataFrame) -> DataFrame:
    """Pairs b, c of a's higher neighbours, each once: only b below c can be a pair of the oriented graph."""
    opened = first.join(second, "a")
    return opened.filter("b_rank < c_rank OR (b_rank = c_rank AND b < c)").drop("b_rank", "c_rank")


def triangles(pairs: DataFrame, weight: str | None = None) -> DataFrame:
    """Each undirected triangle once as (a, b, c), with its edges' weight product if asked."""
    kept = pairs if weight else pairs.select("src", "dst")
    oriented = cut(oriented_pairs(kept))
    w = [F.col(weight)] if weight else [F.lit(1).alias("w")]

    def side(x: str, y: str, name: str) -> DataFrame:
        return oriented.select(F.col("low").alias(x), F.col("high").alias(y), w[0].alias(name), F.col("rank").alias(f"{y}_rank"))

    # a is the lowest-ranked corner; b and c are two of its at most sqrt(2m) higher neighbours
    wedge = _wedges(side("a", "b", "w1"), side("a", "c", "w2"))
    return wedge.join(side("b", "c", "w3").drop("c_rank"), ["b", "c"]).select(
        "a", "b", "c", (F.col("w1") * F.col("w2") * F.col("w3")).alias("w")
    )


def _per_corner(found: DataFrame, value: Column, name: str) -> DataFrame:
    return found.select(F.explode(F.array("a", "b", "c")).alias("id"), "w").groupBy("id").agg(value.alias(name))


def triangle_count(graph: Graph) -> DataFrame:
    """Undirected triangles through every vertex, zeros included."""
    found = _per_corner(triangles(undirected_pairs(graph.edges)), F.count("*"), "triangles")
    return graph.vertices.select("id").join(found, "id", "left").fillna(0, ["triangles"])


def clustering_undirected(graph: Graph) -> DataFrame:
    """2T / (d(d-1)) on the simple undirected form, 0 below degree 2."""
    pairs = undirected_pairs(graph.edges)
    d = endpoint_rows(pairs).groupBy("id").agg(F.count("*").alias("d"))
    found = _per_corner(triangles(pairs), F.count("*"), "t")
    return (
        graph.vertices.select("id").join(d, "id", "left").join(found, "id", "left")
        .select("id", F.coalesce(F.try_divide(2.0 * F.col("t"), F.col("d") * (F.col("d") - 1)), F.lit(0.0)).alias("clustering"))
    )


def clustering_directed(graph: Graph) -> DataFrame:
    """Directed coefficient after Fagiolo (2007): with w = number of directions (1 or 2) of
    a pair, the sum over triangles at u of w*w*w, over d_tot(d_tot-1) - 2 d_recip."""
    pairs = (
        simple_digraph(graph.edges)
        .groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(F.count("*").alias("w"))
    )
    pairs = cut(pairs)
    room = (
        pairs.select(F.explode(F.array("src", "dst")).alias("id"), "w")
        .groupBy("id")
        .agg(F.sum("w").alias("total"), F.count_if(F.col("w") == 2).alias("recip"))
        .select("id", (F.col("total") * (F.col("total") - 1) - 2 * F.col("recip")).alias("room"))
    )
    found = _per_corner(triangles(pairs, "w"), F.sum("w"), "t")
    return (
        graph.vertices.select("id").join(room, "id", "left").join(found, "id", "left")
        .select("id", F.coalesce(F.try_divide(F.col("t").cast("double"), F.col("room")), F.lit(0.0)).alias("clustering"))
    )


# --- dispersion -----------------------------------------------------------------------------------


def ego_links(e: DataFrame) -> DataFrame:
    """(u, v, s) with u -> v, u -> s and v -> s: the links among the successors of every u.

    They are the directed readings of the undirected triangles, which open at their
    lowest-degree corner: at most E * sqrt(E) wedges, and no hub's successors are paired.
    """
    pairs = e.groupBy(F.least("src", "dst").alias("low_id"), F.greatest("src", "dst").alias("high_id")).agg(
        F.max(F.col("src") < F.col("dst")).alias("up"), F.max(F.col("src") > F.col("dst")).alias("down")
    ).withColumnsRenamed({"low_id": "src", "high_id": "dst"})
    rising = F.col("low") < F.col("high")
    oriented = cut(oriented_pairs(pairs).select(
        "low", "high", "rank", F.when(rising, F.col("up")).otherwise(F.col("down")).alias("there"),
        F.when(rising, F.col("down")).otherwise(F.col("up")).alias("back"),
    ))

    def side(x: str, y: str) -> DataFrame:
        return oriented.select(F.col("low").alias(x), F.col("high").alias(y), F.col("rank").alias(f"{y}_rank"),
                               F.col("there").alias(x + y), F.col("back").alias(y + x))

    found = _wedges(side("a", "b"), side("a", "c")).join(side("b", "c").drop("c_rank"), ["b", "c"])
    readings = F.array(*[
        F.struct(F.col(u).alias("u"), F.col(v).alias("v"), F.col(s).alias("s"),
                 (F.col(u + v) & F.col(u + s) & F.col(v + s)).alias("holds"))
        for u, v, s in permutations("abc")
    ])
    return found.select(F.explode(readings).alias("r")).select("r.*").filter("holds").drop("holds")


def dispersion(graph: Graph) -> DataFrame:
    """Normalised dispersion of every edge (u, v).

    Among the common successors ST of u and v, count the pairs s < t where s does not
    point at t and no successor of u other than v is a successor of both; divide by
    |ST|.  The close pairs are few, so those are found by joins and subtracted from
    |ST|(|ST|-1)/2; the far pairs are never listed.

    A pair's closeness hardly depends on v, so it is settled once per u and pair: s
    points at t, or the two share successors in u's neighbourhood.  Only where they
    share a single one does it matter whether that one is v.  Every close pair then
    counts for each v that points at both, found from the end that fewer point at.
    """
    e = simple_digraph(graph.edges)
    st = cut(ego_links(e))
    sizes = st.groupBy("u", "v").agg(F.count("*").alias("k"))
    first = st.select("u", F.col("v").alias("s"), F.col("s").alias("w"))
    shared = (
        first.join(first.withColumnRenamed("s", "t"), ["u", "w"]).filter("s < t")
        .groupBy("u", "s", "t").agg(F.count("*").alias("n"), F.min("w").alias("w"))
    )
    # a link settles the pair for every v, as two shared successors do
    linked = st.filter("v < s").select(
        "u", F.col("v").alias("s"), F.col("s").alias("t"), F.lit(2).cast("bigint").alias("n"), F.lit(None).cast(st.schema["s"].dataType).alias("w"))
    close_pairs = shared.unionByName(linked).groupBy("u", "s", "t").agg(F.sum("n").alias("n"), F.min("w").alias("w"))
    # pointed at inside u's neighbourhood; pairs with an end that nothing points at count for no v
    fame = cut(st.groupBy("u", "s").agg(F.count("*").alias("fame")))
    ranked = close_pairs.join(fame, ["u", "s"]).join(fame.withColumnsRenamed({"s": "t", "fame": "t_fame"}), ["u", "t"])
    turn = F.col("t_fame") < F.col("fame")
    opened = cut(ranked.select(
        "u", F.when(turn, F.col("t")).otherwise(F.col("s")).alias("s"),
        F.when(turn, F.col("s")).otherwise(F.col("t")).alias("t"), F.when(F.col("n") == 1, F.col("w")).alias("only")))
    close = (
        opened.join(st, ["u", "s"]).filter("only IS NULL OR only <> v")
        .join(st.withColumnRenamed("s", "t"), ["u", "v", "t"], "left_semi")
        .groupBy("u", "v").agg(F.count("*").alias("close"))
    )
    far = F.col("k") * (F.col("k") - 1) / 2 - F.coalesce("close", F.lit(0))
    return (
        e.withColumnsRenamed({"src": "u", "dst": "v"})
        .join(sizes, ["u", "v"], "left").join(close, ["u", "v"], "left")
        .select("u", "v", F.coalesce("k", F.lit(0)).alias("embeddedness"),
                F.coalesce(F.try_divide(far, F.col("k")), F.lit(0.0)).alias("dispersion"))
    )


# --- null models -----------------------------------------------------------------------------------


def rewired(graph: Graph, seed: int) -> DataFrame:
    """Degree-preserving null graph: edge stubs paired in a seeded random order, then
    loops and parallels dropped."""
    d = degrees(graph).filter("degree > 0").select("id", "degree")
    stubs = d.select("id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("degree"))).alias("stub"))
    ordered = dense_index(
        stubs.withColumn("_key", order_key(seed, "id", "stub")), ["_key", "id", "stub"], "place"
    )
    pairs = ordered.groupBy(F.floor(F.col("place") / 2).alias("pair")).agg(
        F.min("id").alias("src"), F.max("id").alias("dst"), F.count("*").alias("_ends")
    )
    return pairs.filter("_ends = 2 AND src <> dst").select("src", "dst").distinct()


def degree_histogram(edges: DataFrame) -> DataFrame:
    d = endpoint_rows(edges).groupBy("id").agg(F.count("*").alias("degree"))
    return d.groupBy("degree").agg(F.count("*").alias("n"))


def null_degree_compare(graph: Graph, seed: int) -> DataFrame:
    """Degree histogram of the simple graph beside that of its rewired null."""
    seen = degree_histogram(undirected_pairs(graph.edges)).withColumnRenamed("n", "observed")
    null = degree_histogram(rewired(graph, seed)).withColumnRenamed("n", "rewired")
    return seen.join(null, "degree", "full_outer").fillna(0)


def ln_gamma(x: Column) -> Column:
    """Log-gamma for x >= 1 by Stirling's series after shifting the argument up by eight."""
    y = x + 8.0
    series = (y - 0.5) * F.ln(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return series - reduce(lambda a, b: a + b, [F.ln(x + float(i)) for i in range(8)])


def er_expected_degrees(graph: Graph) -> DataFrame:
    """Observed vertices per degree beside the binomial expectation at equal density."""
    pairs = undirected_pairs(graph.edges)
    d = endpoint_rows(pairs).unionByName(graph.vertices.select("id")).groupBy("id").agg((F.count("*") - 1).alias("degree"))
    seen = d.groupBy("degree").agg(F.count("*").alias("observed"))
    facts = graph.vertices.agg(F.count("*").cast("double").alias("n")).join(
        F.broadcast(pairs.agg(F.count("*").cast("double").alias("m")))
    )
    k, trials = F.col("degree").cast("double"), F.col("n") - 1
    p = 2 * F.col("m") / (F.col("n") * trials)
    choose = ln_gamma(trials + 1) - ln_gamma(k + 1) - ln_gamma(trials - k + 1)
    return seen.join(F.broadcast(facts)).select(
        "degree", "observed", (F.col("n") * F.exp(choose + k * F.ln(p) + (trials - k) * F.ln(1 - p))).alias("expected")
    )


def neighbours(pairs: DataFrame) -> DataFrame:
    """(id, neighbour) rows of an undirected graph."""
    return both_ways(pairs.select("src", "dst")).withColumnsRenamed({"src": "id", "dst": "neighbour"})
