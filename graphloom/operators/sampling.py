"""Vertex and edge samples that are the same on every run with the same seed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.hashing import bucket60, order_key, unit
from graphloom.functions.ordering import dense_index, first_by_key
from graphloom.graph import Graph, both_ways, edge_ends, undirected_pairs
from graphloom.session import Layers, cut, discard


def weighted_nodes(weights: DataFrame, n: int, seed: int, weight: str = "weight") -> DataFrame:
    """n ids without replacement, chance in proportion to weight (Efraimidis and Spirakis
    2006): the n smallest of -ln(u)/w.  Vertices of weight 0 are never drawn."""
    key = -F.ln(unit(seed, "id")) / F.col(weight)
    keyed = weights.filter(F.col(weight) > 0).select("id", key.alias("_key"))
    return dense_index(keyed, ["_key", "id"], "_at").filter(F.col("_at") < n).select("id")


def uniform_nodes(ids: DataFrame, n: int, seed: int) -> DataFrame:
    return first_by_key(ids.select("id"), order_key(seed, "id"), ["id"], n)


def random_edges(edges: DataFrame, n: int, seed: int) -> DataFrame:
    return first_by_key(edges.select("src", "dst"), order_key(seed, "src", "dst"), ["src", "dst"], n)


def random_edges_induced(graph: Graph, n: int, seed: int) -> Graph:
    """Random edges, then every further edge among their ends."""
    return graph.induced(edge_ends(random_edges(graph.edges, n, seed)))


def random_node_edges(graph: Graph, n: int, seed: int) -> DataFrame:
    """n random vertices, each with one of its incident edges; vertices without edges give none."""
    picked = uniform_nodes(graph.vertices, n, seed)
    touching = graph.edges.select("src", "dst", F.explode(F.array("src", "dst")).alias("id"))
    choice = F.min(F.struct(order_key(seed + 1, "id", "src", "dst").alias("k"), "src", "dst"))
    return (
        touching.join(picked, "id", "left_semi").groupBy("id").agg(choice.alias("edge"))
        .select("edge.src", "edge.dst").distinct()
    )


def hybrid_edges(graph: Graph, n: int, seed: int) -> DataFrame:
    """Half node-then-edge picks, half uniform edges, duplicates folded."""
    return (
        random_node_edges(graph, n // 2, seed)
        .unionByName(random_edges(graph.edges, n - n // 2, seed + 2)).distinct()
    )


def snowball(graph: Graph, starts: DataFrame, hops: int, fanout: int, max_nodes: int, seed: int) -> DataFrame:
    """Ids within ``hops`` steps of the starts, at most ``fanout`` seeded neighbours followed
    per vertex, until ``max_nodes`` are found; the frontier advances every hop."""
    ends = cut(both_ways(undirected_pairs(graph.edges)))
    seen = cut(starts.select("id").distinct())
    frontier, count = seen, seen.count()
    for hop in range(hops):
        order = Window.partitionBy("src").orderBy(order_key(seed, "src", "dst"), "dst")
        # the rank filter is applied within each task first, so a hub sends few rows
        found = (
            ends.join(frontier.select(F.col("id").alias("src")), "src")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= fanout)
            .select(F.col("dst").alias("id")).distinct().join(seen, "id", "left_anti")
        )
        room = max_nodes - count
        frontier = cut(first_by_key(found, order_key(seed + 1, "id"), ["id"], room))
        added = frontier.count()
        if added == 0:
            break
        count += added
        seen = cut(seen.unionByName(frontier))
        if count >= max_nodes:
            break
    return seen


def forest_fire(graph: Graph, starts: DataFrame, chance: float, seed: int) -> DataFrame:
    """Ids the fire reaches when every undirected link burns with the given chance."""
    live = undirected_pairs(graph.edges).filter(unit(seed, "src", "dst") < chance)
    ends = cut(both_ways(live))
    layers = [cut(starts.select("id").distinct())]
    while True:
        # in an undirected search only the last two layers can be met again
        recent = reduce(DataFrame.unionByName, layers[-2:])
        found = (
            ends.join(layers[-1].select(F.col("id").alias("src")), "src").select(F.col("dst").alias("id"))
            .distinct().join(recent, "id", "left_anti")
        )
        layer = cut(found)
        if layer.isEmpty():
            return reduce(DataFrame.unionByName, layers)
        layers.append(layer)


def diffusion(graph: Graph, starts: DataFrame, rounds: int, seed: int) -> DataFrame:
    """Ids infected when, each round, every infected vertex passes it to one seeded neighbour."""
    ends = cut(both_ways(undirected_pairs(graph.edges)))
    infected = cut(starts.select("id").distinct())
    for step in range(rounds):
        choice = F.min(F.struct(order_key(seed + step, "src", "dst").alias("k"), "dst"))
        passed = (
            ends.join(infected.select(F.col("id").alias("src")), "src")
            .groupBy("src").agg(choice.alias("c")).select(F.col("c.dst").alias("id"))
        )
        infected = cut(infected.unionByName(passed).distinct())
    return infected


# --- walks ------------------------------------------------------------------------------------


class IndexedNeighbours:
    """Undirected neighbours numbered per vertex, so a step is a lookup by (vertex, number).

    Numbers come from one global numbering minus the vertex's first number; no task
    holds a whole hub, and walks standing on a hub spread over its many numbers.
    """

    def __init__(self, graph: Graph):
        placed = cut(dense_index(both_ways(undirected_pairs(graph.edges)), ["src", "dst"], "place"))
        starts = placed.groupBy("src").agg(F.min("place").alias("first"), F.count("*").alias("degree"))
        self.degrees = cut(starts.select(F.col("src").alias("node"), "degree"))
        self.slots = cut(
            placed.join(starts.select("src", "first"), "src")
            .select(F.col("src").alias("node"), (F.col("place") - F.col("first")).alias("slot"), F.col("dst").alias("next"))
        )

    def step(self, state: DataFrame, slot: Column) -> DataFrame:
        """Move rows of ``state`` (column node) to the neighbour at ``slot``; column next."""
        return state.withColumn("slot", slot).join(self.slots, ["node", "slot"]).drop("slot")


def _starts(graph: Graph, walks_per_node: int) -> DataFrame:
    numbers = F.explode(F.sequence(F.lit(0), F.lit(walks_per_node - 1)))
    return graph.vertices.select("id", numbers.alias("number")).select(
        F.concat_ws("-", F.col("id").cast("string"), F.col("number").cast("string")).alias("walk"),
        F.col("id").alias("node"),
    )


def random_walks(
    graph: Graph, length: int, walks_per_node: int = 1, seed: int = 31337, backtrack: bool = True, steps_a_table: int = 8
) -> DataFrame:
    """(walk, step, node) rows of uniform walks over undirected links.

    With ``backtrack=False`` a step avoids the vertex it came from unless it is the
    only neighbour.  A walk from an isolated vertex has its start only.

    A step is one join: the table of neighbours tells the next vertex's degree, and at which number the way back
    stands there.  A walk carries its last few steps only, and these are written as a layer.
    """
    index = IndexedNeighbours(graph)
    there = index.degrees.withColumnsRenamed({"node": "next", "degree": "next_degree"})
    back = index.slots.select(F.col("node").alias("next"), F.col("next").alias("node"), F.col("slot").alias("next_back"))
    ways = cut(index.slots.join(there, "next").join(back, ["node", "next"]))
    starts = cut(_starts(graph, walks_per_node).join(index.degrees, "node", "left"))
    discard([index.slots, index.degrees])
    alone = starts.filter("degree IS NULL").select("walk", F.lit(0).alias("step"), "node")
    state = starts.filter("degree IS NOT NULL").select(
        "walk", "node", "degree", F.lit(None).cast("bigint").alias("back"), F.lit(0).alias("first"), F.array("node").alias("path"))
    none, layers = F.slice(F.array("node"), 1, 0), Layers(graph.vertices.sparkSession, "walks")
    for number in range(1, length):
        draw = bucket60(seed + number, "walk")
        slot = F.pmod(draw, F.col("degree"))
        if not backtrack:
            pick = F.pmod(draw, F.greatest(F.col("degree") - 1, F.lit(1)))
            slot = (
                F.when(F.col("back").isNull(), slot).when(F.col("degree") == 1, F.lit(0).cast("bigint"))
                .otherwise(pick + F.when(pick >= F.col("back"), 1).otherwise(0))
            )
        state = state.withColumn("slot", slot).join(ways, ["node", "slot"]).select(
            "walk", F.col("next").alias("node"), F.col("next_degree").alias("degree"), F.col("next_back").alias("back"),
            "first", F.concat("path", F.array("next")).alias("path"))
        if number % steps_a_table == 0:
            state = layers.add(number, state).withColumns({"first": F.lit(number + 1), "path": none})
    if (length - 1) % steps_a_table or length == 1:
        layers.add(length, state)
    walked = layers.all().select("walk", "first", F.posexplode("path").alias("at", "node"))
    return alone.unionByName(walked.select("walk", (F.col("first") + F.col("at")).alias("step"), "node"))


def biased_walks(
    graph: Graph, length: int, walks_per_node: int = 1, p: float = 1.0, q: float = 1.0, seed: int = 31337, tries: int = 12
) -> DataFrame:
    """Second-order walks: from prev over node, a candidate weighs 1/p if it is prev, 1 if it
    neighbours prev, else 1/q.

    Candidates are drawn uniformly and accepted in proportion to their weight, a few
    draws a round and as many rounds as it takes; that gives the exact second-order
    law without weighing all neighbours of a hub for every walk standing on it.
    """
    index = IndexedNeighbours(graph)
    top = max(1 / p, 1.0, 1 / q)
    first = random_walks(graph, 2, walks_per_node, seed)
    start, second = first.filter("step = 0"), first.filter("step = 1")
    state = cut(
        second.select("walk", "node").join(start.select("walk", F.col("node").alias("prev")), "walk")
    )
    steps = [start, state.select("walk", F.lit(1).alias("step"), "node")]
    linked = index.slots.select(F.col("node").alias("prev"), "next", F.lit(True).alias("near"))
    for number in range(2, length):
        waiting, settled, attempt = state, [], 0
        while True:
            drawn = waiting.join(index.degrees, "node").withColumn(
                "try", F.explode(F.sequence(F.lit(attempt), F.lit(attempt + tries - 1)))
            )
            pick = F.pmod(bucket60(seed + number, "walk", "try"), F.col("degree"))
            offered = index.step(drawn, pick).join(linked, ["prev", "next"], "left")
            weight = F.when(F.col("next") == F.col("prev"), 1 / p).when(F.col("near"), 1.0).otherwise(1 / q)
            good = offered.filter(unit(seed - number, "walk", "try") * top < weight)
            chosen = cut(
                good.groupBy("walk").agg(F.min(F.struct("try", "next", "node")).alias("c"))
                .select("walk", F.col("c.next").alias("node"), F.col("c.node").alias("prev"))
            )
            settled.append(chosen)
            waiting = cut(waiting.join(chosen.select("walk"), "walk", "left_anti"))
            attempt += tries
            if waiting.isEmpty():
                break
        state = cut(reduce(DataFrame.unionByName, settled))
        steps.append(state.select("walk", F.lit(number).alias("step"), "node"))
    return reduce(DataFrame.unionByName, steps)


def walk_sample(graph: Graph, walks: DataFrame) -> Graph:
    """Subgraph induced by the vertices that walks visit."""
    return graph.induced(walks.select(F.col("node").alias("id")).distinct())
