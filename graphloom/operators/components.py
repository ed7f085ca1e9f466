"""Connected components, strong components, bridges.

Every loop keeps a fixed set of columns, cuts the lineage once a round with a
written table, and asks the data for one number to decide whether to go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.hashing import order_key
from graphloom.functions.ordering import dense_index, next_value, running_totals
from graphloom.graph import Graph, both_ways, edge_ends, endpoint_rows, undirected_pairs
from graphloom.session import cut, discard


def _signature(pairs: DataFrame):
    """Count and order-free checksum of a set of pairs, to see whether a round changed it."""
    return pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst"))).first()


def connected_components(graph: Graph) -> DataFrame:
    """(id, component) with the smallest id of the component as its name.

    Alternates large-star and small-star steps (Kiveris et al. 2014): links are
    redirected to the smallest neighbour until every component is a star around
    its smallest id.  That takes few rounds also on long paths.  The smallest
    neighbour is a map-side-combined minimum and meets the links again by a join,
    so a hub's links are never gathered in one task.  Vertices of one link take no part in the
    rounds, which carry short ids; a component is named when it is whole.
    """
    vertices, edges, named = graph.short_ids()
    links, hung = _without_leaves(cut(undirected_pairs(edges.select(F.col("_src").alias("src"), F.col("_dst").alias("dst")))))
    last = _signature(links)
    while last[0]:
        spent = [links]
        links = cut(_small_star(_large_star(links, spent), spent))
        discard(spent)
        now = _signature(links)
        if now == last:
            break
        last = now
    found = links.select(F.col("dst").alias("id"), F.col("src").alias("root"))
    # a leaf belongs where the vertex it hangs on does
    hangs = hung.join(found.select(F.col("id").alias("on"), "root"), "on", "left").select("id", F.coalesce("root", "on").alias("root"))
    members = cut(found.unionByName(hangs))
    names = cut(members.groupBy("root").agg(F.min(named(F.col("id"))).alias("least")).select(
        "root", F.least("least", named(F.col("root"))).alias("component")))
    known = members.join(names, "root").select("id", "component").unionByName(names.select(F.col("root").alias("id"), "component"))
    return vertices.select(F.col("_id")).join(known.withColumnRenamed("id", "_id"), "_id", "left").select(
        named(F.col("_id")).alias("id"), F.coalesce("component", named(F.col("_id"))).alias("component")
    )


def _without_leaves(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links between vertices of two or more, and (id, on): every vertex of one link and the one it hangs on.

    Of two vertices linked to nothing else the larger hangs on the smaller.
    """
    # written, so that the joins can split the links of a hub
    single = cut(endpoint_rows(links).groupBy("id").agg(F.count("*").alias("n")).filter("n = 1").select("id", F.lit(True).alias("leaf")))
    marked = cut(
        links.join(single.select(F.col("id").alias("src"), F.col("leaf").alias("s")), "src", "left")
        .join(single.select(F.col("id").alias("dst"), F.col("leaf").alias("d")), "dst", "left"))
    discard([links, single])
    upper = F.col("d").isNotNull()
    hung = marked.filter("s IS NOT NULL OR d IS NOT NULL").select(
        F.when(upper, F.col("dst")).otherwise(F.col("src")).alias("id"), F.when(upper, F.col("src")).otherwise(F.col("dst")).alias("on"))
    return cut(marked.filter("s IS NULL AND d IS NULL").select("src", "dst")), hung


def _large_star(links: DataFrame, spent: list[DataFrame]) -> DataFrame:
    """Point every larger neighbour of u at the smallest of u and its neighbours.

    Tables that the result reads are added to ``spent``.
    """
    ends = both_ways(links)
    # written, so that the join can split the links of a hub
    least = cut(ends.groupBy("src").agg(F.least(F.col("src"), F.min("dst")).alias("m")))
    spent.append(least)
    # links are kept with src < dst, so they are the larger neighbours already
    moved = links.join(least, "src").select(F.col("m").alias("src"), "dst")
    # repeats are folded by the small-star step that follows
    return moved.filter("src <> dst")


def _small_star(links: DataFrame, spent: list[DataFrame]) -> DataFrame:
    """Point u and its smaller neighbours at the smallest of them; reads ``links`` once."""
    # two readers: the minimum and the join
    links = cut(links)
    spent.append(links)
    # links come with src < dst, so dst is the centre and src a smaller neighbour
    least = cut(links.groupBy("dst").agg(F.min("src").alias("m")))
    spent.append(least)
    moved = links.join(least, "dst").select(
        F.explode(F.array(
            F.struct(F.col("m").alias("src"), F.col("src").alias("dst")),
            F.struct(F.col("m").alias("src"), F.col("dst").alias("dst")),
        )).alias("link")
    )
    return moved.select("link.*").filter("src <> dst").distinct()


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "component")


def is_weakly_connected(components: DataFrame) -> DataFrame:
    # two distinct names are enough to say no
    names = components.select("component").distinct().limit(2)
    return names.agg((F.count("*") == 1).alias("connected"))


def largest_component(graph: Graph, components: DataFrame | None = None) -> Graph:
    """Induced subgraph of the biggest component; the smaller name wins a tie."""
    components = cut(connected_components(graph)) if components is None else components
    top = component_sizes(components).limit(1).select("component")
    return graph.induced(components.join(F.broadcast(top), "component", "left_semi"))


# --- strong components ------------------------------------------------------------------------


def strongly_connected_components(graph: Graph, seed: int = 31337) -> DataFrame:
    """(id, scc), named by the smallest id of the component.

    Many pivots at once.  Vertices are put in a random order.  Each takes the first vertex that reaches it and the
    first that it reaches; where both are the same vertex, it belongs to that one's component and is closed.  Members of
    one component agree on both, so links between vertices that differ in either go, and the rest goes on: all
    parts together, in about log n rounds as a random order halves the parts, however many components there are.
    Vertices without a predecessor or a successor left are components of their own.
    """
    # nothing is broadcast in the rounds: a table small enough for it would pass the driver again and again
    ranked = cut(dense_index(graph.vertices.select("id").distinct().withColumn("_key", order_key(seed, "id")), ["_key", "id"], "rank").select("id", "rank"))
    edges = cut(
        graph.edges.select("src", "dst").filter("src <> dst").distinct()
        .join(ranked.select(F.col("id").alias("src"), F.col("rank").alias("a")).hint("merge"), "src")
        .join(ranked.select(F.col("id").alias("dst"), F.col("rank").alias("b")).hint("merge"), "dst").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    closed: list[DataFrame] = []
    while True:
        # an open vertex has links both ways; all others are components of their own
        ids = cut(edges.select(F.col("src").alias("id")).distinct().join(edges.select(F.col("dst").alias("id")).distinct().hint("merge"), "id", "left_semi"))
        if ids.isEmpty():
            break
        kept = cut(_inside(edges, ids))
        labels = _first_both_ways(ids, kept)
        closed.append(cut(labels.filter("f = b").select("id", F.col("f").alias("head"))))
        left = labels.filter("f <> b")
        after = cut(
            kept.join(left.select(F.col("id").alias("src"), F.col("f").alias("f1"), F.col("b").alias("b1")).hint("merge"), "src")
            .join(left.select(F.col("id").alias("dst"), "f", "b").hint("merge"), "dst").filter("f = f1 AND b = b1").select("src", "dst"))
        discard([edges, kept, ids, labels])
        edges = after
    heads = ranked.select("id", "rank", F.col("rank").alias("head"))
    if closed:
        found = closed[0]
        for more in closed[1:]:
            found = found.unionByName(more)
        heads = ranked.join(found.select(F.col("id").alias("rank"), "head").hint("merge"), "rank", "left").select("id", "rank", F.coalesce("head", "rank").alias("head"))
    names = cut(heads.groupBy("head").agg(F.min("id").alias("scc")))
    return heads.join(names.hint("merge"), "head").select("id", "scc")


def _first_both_ways(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, f, b): the smallest number that reaches each vertex, and the smallest that it reaches, itself included.

    A round takes the labels of neighbours and then the label of the own label's vertex: what reaches my label
    reaches me.  The reach so grows by a factor in most rounds, and not by one link.
    """
    labels, last = cut(ids.select("id", F.col("id").alias("f"), F.col("id").alias("b"))), None
    while True:
        down = edges.join(labels.select(F.col("id").alias("src"), "f").hint("merge"), "src").select(F.col("dst").alias("id"), "f", F.col("dst").alias("b"))
        up = edges.join(labels.select(F.col("id").alias("dst"), "b").hint("merge"), "dst").select(F.col("src").alias("id"), F.col("src").alias("f"), "b")
        # a popular label is a hot key: the side it is looked up in is written, so Spark may split the other
        near = cut(labels.unionByName(down).unionByName(up).groupBy("id").agg(F.min("f").alias("f"), F.min("b").alias("b")))
        jumped = (
            near.join(near.select(F.col("id").alias("f"), F.col("f").alias("ff")).hint("merge"), "f")
            .join(near.select(F.col("id").alias("b"), F.col("b").alias("bb")).hint("merge"), "b").select("id", F.col("ff").alias("f"), F.col("bb").alias("b")))
        fresh = cut(jumped)
        discard([labels, near])
        labels = fresh
        now = labels.agg(F.sum(F.col("f").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == last:
            return labels
        last = now


def _inside(edges: DataFrame, ids: DataFrame) -> DataFrame:
    return edges.join(ids.select(F.col("id").alias("src")).hint("merge"), "src", "left_semi").join(
        ids.select(F.col("id").alias("dst")).hint("merge"), "dst", "left_semi"
    )


# --- bridges ----------------------------------------------------------------------------------


def spanning_forest(pairs: DataFrame, seed: int = 31337) -> tuple[DataFrame, DataFrame]:
    """Links (src, dst) of a spanning forest of undirected pairs, and (id, root) of the vertices they touch.

    Boruvka's rounds: every part takes its first link outwards in a random order, parts that meet become one, and of the
    links between two parts the first is kept.  Chains of parts are short in a random order and are followed by
    doubling, so the rounds grow with the logarithm of the vertices, not with the depth of the graph.
    """
    roots = cut(edge_ends(pairs).select("id", F.col("id").alias("root")))
    links = cut(pairs.select(F.col("src").alias("p"), F.col("dst").alias("q"), F.struct(order_key(seed, "src", "dst").alias("key"), "src", "dst").alias("link")))
    chosen: list[DataFrame] = []
    while not links.isEmpty():
        ends = links.select(F.explode(F.array(F.struct("p", "q"), F.struct(F.col("q").alias("p"), F.col("p").alias("q")))).alias("e"), "link").select("e.p", "e.q", "link")
        first = cut(ends.groupBy("p").agg(F.min(F.struct("link", "q")).alias("first")).select("p", F.col("first.q").alias("up"), "first.link"))
        chosen.append(cut(first.select("link.src", "link.dst").distinct()))
        # two parts that chose each other: the smaller name stays
        back = first.select(F.col("p").alias("up"), F.col("up").alias("again"))
        heads = cut(first.join(back, "up").select("p", F.when((F.col("again") == F.col("p")) & (F.col("p") < F.col("up")), F.col("p")).otherwise(F.col("up")).alias("up")))
        while True:
            further = cut(heads.join(heads.select(F.col("p").alias("up"), F.col("up").alias("top")), "up").select("p", F.col("top").alias("up"), (F.col("up") != F.col("top")).alias("moved")))
            discard([heads])
            done, heads = further.filter("moved").isEmpty(), further.select("p", "up")
            heads._cut_path = further._cut_path
            if done:
                break
        a, b = heads.select("p", F.col("up").alias("a")), heads.select(F.col("p").alias("q"), F.col("up").alias("b"))
        joined = links.join(a, "p").join(b, "q").filter("a <> b")
        fresh = cut(joined.groupBy(F.least("a", "b").alias("p"), F.greatest("a", "b").alias("q")).agg(F.min("link").alias("link")))
        named = cut(roots.join(heads.withColumnRenamed("p", "root"), "root", "left").select("id", F.coalesce("up", "root").alias("root")))
        discard([links, roots, first, heads])
        links, roots = fresh, named
    tree = pairs.select("src", "dst").filter(F.lit(False))
    for part in chosen:
        tree = tree.unionByName(part)
    return cut(tree), roots


def tour_order(tree: DataFrame, roots: DataFrame) -> DataFrame:
    """(src, dst, root, left): the Euler tour of every tree, each link once a way, and the steps left to the tour's end.

    A step into v from u is followed by the one to v's next neighbour after u; at the root the last one ends the tour.
    Steps are counted by pointer doubling.
    """
    arcs = cut(both_ways(tree))
    following = next_value(arcs, "src", ["dst"], "dst", "next")
    first = cut(arcs.groupBy("src").agg(F.min("dst").alias("first")).join(roots.select(F.col("id").alias("src"), "root"), "src"))
    turns = following.join(first, "src").select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), "root",
        F.coalesce("next", F.when(F.col("src") != F.col("root"), F.col("first"))).alias("to"))
    # a step is known by its two ends; the last of a tour has none after it
    state = cut(turns.select("src", "dst", "root", F.when(F.col("to").isNotNull(), F.col("dst")).alias("na"), F.col("to").alias("nb"), F.when(F.col("to").isNotNull(), 1).otherwise(0).cast("bigint").alias("left")))
    while not state.filter("na IS NOT NULL").isEmpty():
        ahead = state.select(F.col("src").alias("na"), F.col("dst").alias("nb"), F.col("na").alias("xa"), F.col("nb").alias("xb"), F.col("left").alias("more"))
        fresh = cut(state.join(ahead, ["na", "nb"], "left").select(
            "src", "dst", "root", F.col("xa").alias("na"), F.col("xb").alias("nb"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left")))
        discard([state])
        state = fresh
    return state.select("src", "dst", "root", "left")


def bridges(graph: Graph, seed: int = 31337) -> DataFrame:
    """Undirected pairs whose removal splits their component, after Tarjan and Vishkin.

    On the Euler tour of any spanning forest a subtree is a stretch.  Every pair outside the forest gets a random
    128-bit label at both ends; a label whose ends lie in one stretch cancels out, so the exclusive-or over a stretch
    (the difference of two running totals) is zero exactly when no pair leaves the subtree (short of a 128-bit
    collision): then the link above it is a bridge.  Rounds grow with the logarithm of the vertices.
    """
    pairs = cut(undirected_pairs(graph.edges))
    tree, roots = spanning_forest(pairs, seed)
    tour = cut(tour_order(tree, roots).withColumn("low", F.least("src", "dst")).withColumn("high", F.greatest("src", "dst")))
    label = order_key(seed, "src", "dst")
    high = F.conv(F.substring(label, 1, 15), 16, 10).cast("bigint").alias("x1")
    low = F.conv(F.substring(label, 17, 15), 16, 10).cast("bigint").alias("x2")
    extra = both_ways(pairs.join(tree, ["src", "dst"], "left_anti").select("src", "dst", high, low))
    own = extra.groupBy(F.col("src").alias("dst")).agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    # of a link's two steps, the earlier one (more steps left) enters the subtree
    entries = cut(tour.groupBy("low", "high").agg(F.max(F.struct("left", "dst")).alias("e")).select("low", "high", F.col("e.dst").alias("dst")).join(own, "dst"))
    steps = tour.join(entries, ["low", "high", "dst"], "left").fillna(0, ["x1", "x2"]).withColumn("place", -F.col("left"))
    summed = running_totals(steps.select("low", "high", "root", "place", "x1", "x2"), ["root", "place"], {"x1": "t1", "x2": "t2"}, "bit_xor")
    # the running total at the last step of a stretch, without that before its first: the first one's own is in its total
    over = summed.groupBy("low", "high").agg(*[F.bit_xor(F.col(f"t{k}")).bitwiseXOR(F.bit_xor(f"x{k}")).alias(f"x{k}") for k in (1, 2)])
    return over.filter("x1 = 0 AND x2 = 0").select(F.col("low").alias("src"), F.col("high").alias("dst"))
