"""Motif matching as joins, and motif counting without listing the matches.

Matching is by homomorphism: each clause binds one edge row, a shared name is an
equality join, and two names may bind the same vertex.  Parallel edges multiply.

Counting by signature never lists matches where it need not: paths and stars
carry (vertex, signature so far) -> count, so their cost follows the number of
edges and of distinct labels.  Triangles and four-cycles are rooted at their
lowest- or highest-degree vertex, so a hub is never the middle of a wedge whose
ends are smaller; that bounds the wedges by E * sqrt(E) on any graph.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from graphloom.graph import Graph, endpoint_rows
from graphloom.session import cut

Clause = tuple[str, str, str]


def clauses(pattern: str | Iterable[Clause]) -> list[Clause]:
    """Triples (source name, edge name, target name), or the arrow text for them."""
    if not isinstance(pattern, str):
        return list(pattern)
    return [
        re.fullmatch(r"\((\w+)\)-\[(\w+)\]->\((\w+)\)", part.strip()).groups()
        for part in pattern.split(";")
    ]


def find(
    graph: Graph,
    pattern: str | Iterable[Clause],
    where: dict[str, Column] | None = None,
    vertex_columns: list[str] | None = None,
    distinct_vertices: bool = False,
    short: bool = False,
) -> DataFrame:
    """All matches, one struct column per name.

    ``where`` maps a vertex or edge name to a predicate on that frame's columns;
    it filters the frame before any join.  ``vertex_columns`` limits the vertex
    properties fetched; an empty list leaves just the ids.  With ``short`` the ids in the
    structs are the graph's short ones, which :func:`with_ids` turns into ids later.
    """
    steps, where = clauses(pattern), where or {}
    # ids travel in their short form, an edge's ends once with the names they bind; structs are built at the end
    vertices, edges, named = graph.short_ids()
    if short:
        named = lambda c: c
    wanted = graph.vertices.columns if vertex_columns is None else ["id", *vertex_columns]
    usable = passable(graph, edges, steps)
    edges_of = usable.of
    if len(steps) > 2 and {s for s, _, _ in steps} == {d for _, _, d in steps}:
        # every name is entered and left, so edges from or to a dead end are in no match
        passed = _passed_edges(usable.used if any(e in where for _, e, _ in steps) else usable.used.drop("src", "dst"))
        edges_of = {e: passed for _, e, _ in steps}

    def frame(name: str) -> DataFrame:
        rows = usable.held(vertices, name)
        rows = rows.filter(where[name]) if name in where else rows
        return rows.select(F.col("_id").alias(f"{name}.id"), *[F.col(c).alias(f"{name}.{c}") for c in wanted if c != "id"])

    bound: set[str] = set()
    matches: DataFrame | None = None
    pending = list(steps)
    while pending:
        step = next((s for s in pending if not bound or {s[0], s[2]} & bound), None)
        if step is None:
            raise ValueError("pattern is not connected: it would need a cross join")
        pending.remove(step)
        source, edge, target = step
        rows = _edge_rows(edges_of[edge], step, where)
        for name in dict.fromkeys((source, target)):
            if name in where and name not in bound:
                # filtered and fetched by one join
                rows = rows.join(frame(name), f"{name}.id", "left_semi" if set(wanted) == {"id"} else "inner")
        keys = [f"{v}.id" for v in dict.fromkeys((source, target)) if v in bound]
        matches = rows if matches is None else matches.join(rows, keys)
        bound |= {source, target}
    names = sorted(bound)
    if distinct_vertices:
        for i, left in enumerate(names):
            for right in names[i + 1:]:
                matches = matches.filter(_held(left, "id") != _held(right, "id"))
    found = []
    for name in names:
        if set(wanted) != {"id"} and name not in where:
            matches = matches.join(frame(name), f"{name}.id")
        found.append(F.struct(*[(named(_held(name, c)) if c == "id" else _held(name, c)).alias(c) for c in wanted]).alias(name))
    for source, edge, target in steps:
        ends = {"src": named(_held(source, "id")), "dst": named(_held(target, "id"))}
        found.append(F.struct(*[ends.get(c, _held(edge, c)).alias(c) for c in graph.edges.columns]).alias(edge))
    return matches.select(*found)


@dataclass(frozen=True)
class Passable:
    """What of a graph a pattern can bind, told by the kinds of the edges' ends.

    ``of`` has the edges for each edge name, ``used`` those of any, ``kinds`` the kinds for each vertex name
    (None where ids do not tell them).
    """

    of: dict[str, DataFrame]
    used: DataFrame
    kinds: dict[str, set] | None
    pairs: frozenset | None

    def held(self, vertices: DataFrame, name: str | None = None) -> DataFrame:
        """The vertices that may stand for ``name``, or for any name."""
        if self.kinds is None:
            return vertices
        return vertices.filter(F.col("_kind").isin(*(self.kinds[name] if name else set().union(*self.kinds.values()))))


def passable(graph: Graph, edges: DataFrame, steps: list[Clause], most: int = 256) -> Passable:
    """Edges of short ids that can be in a match, as far as the kinds of their ends tell.

    A match binds a name to one vertex, so to one kind: pairs of kinds that no assignment of kinds to the names
    allows are left out of the clause, until nothing more goes.  Only distinct pairs of kinds reach the driver;
    a graph with more than ``most`` of them, or whose ids tell no kinds, keeps all edges.
    """
    pairs = None
    if "_src_kind" in edges.columns:
        known = graph.__dict__.setdefault("_kind_pairs", [])
        if not known:
            known.append([tuple(r) for r in edges.select("_src_kind", "_dst_kind").distinct().limit(most + 1).collect()])
        pairs = known[0]
    if pairs is None or len(pairs) > most or any(None in p for p in pairs):
        bare = edges.drop("_src_kind", "_dst_kind")
        return Passable({e: bare for _, e, _ in steps}, bare, None, None)
    left = {e: {p for p in pairs if s != d or p[0] == p[1]} for s, e, d in steps}
    while True:
        kinds: dict[str, set] = {}
        for s, e, d in steps:
            for name, at in ((s, 0), (d, 1)):
                found = {p[at] for p in left[e]}
                kinds[name] = kinds.get(name, found) & found
        fewer = {e: {p for p in left[e] if p[0] in kinds[s] and p[1] in kinds[d]} for s, e, d in steps}
        if fewer == left:
            break
        left = fewer

    def among(chosen: set) -> DataFrame:
        kept = [(F.col("_src_kind") == a) & (F.col("_dst_kind") == b) for a, b in sorted(chosen)]
        return edges.filter(reduce(lambda x, y: x | y, kept, F.lit(False))).drop("_src_kind", "_dst_kind")

    every = set().union(*left.values())
    return Passable({e: among(chosen) for e, chosen in left.items()}, among(every), kinds, frozenset(every))


def _passed_edges(edges: DataFrame) -> DataFrame:
    """Edges that start where some edge ends and end where some edge starts; written, as every clause reads them."""
    entered = edges.select(F.col("_dst").alias("_src")).distinct()
    left = edges.select(F.col("_src").alias("_dst")).distinct()
    return cut(edges.join(entered, "_src", "left_semi").join(left, "_dst", "left_semi"))


def _held(name: str, column: str) -> Column:
    """A column of a name's row as it travels through the joins."""
    return F.col(f"`{name}.{column}`")


def _edge_rows(edges: DataFrame, step: Clause, where: dict[str, Column]) -> DataFrame:
    """Edges of one clause with its own predicate applied."""
    source, edge, target = step
    rows = edges.filter(where[edge]) if edge in where else edges
    own = [F.col(c).alias(f"{edge}.{c}") for c in edges.columns if c not in ("src", "dst") and not c.startswith(("_src", "_dst"))]
    if source == target:
        return rows.filter("_src = _dst").select(F.col("_src").alias(f"{source}.id"), *own)
    return rows.select(F.col("_src").alias(f"{source}.id"), F.col("_dst").alias(f"{target}.id"), *own)


def with_ids(graph: Graph, table: DataFrame, columns: list[str]) -> DataFrame:
    """A table of short ids by the graph's ids."""
    named = graph.short_ids()[2]
    return table.withColumns({c: named(F.col(c)) for c in columns})


def expand(matches: DataFrame, name: str) -> DataFrame:
    """One column per field of a matched element."""
    return matches.select(f"{name}.*")


def signature_count(matches: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Matches per signature; ``fields`` maps a result column to a ``name.field`` path."""
    return (
        matches.select(*[F.col(path).alias(name) for name, path in fields.items()])
        .groupBy(*fields)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), *fields)
    )


# --- paths and stars: counts carried along, nothing listed --------------------------------


def _join_key(graph: Graph) -> Callable[[str], Column]:
    """An id column as it travels in counts, which name no vertex: of a text of 16 bytes or more, its 128-bit digest."""
    kinds = {graph.vertices.schema["id"].dataType, *[graph.edges.schema[end].dataType for end in ("src", "dst")]}
    if kinds != {StringType()}:
        return F.col
    # shorter texts stay as they are, so no text equals another's digest
    return lambda c: F.when(F.octet_length(c) < 16, F.col(c).cast("binary")).otherwise(F.unhex(F.md5(c)))


def _count_key(graph: Graph) -> Callable[[str], Column]:
    """A short id as it travels in counts: digested only where it is no shorter than the graph's own id."""
    return _join_key(graph) if type(graph).short_ids is Graph.short_ids else F.col


def path_counts(
    graph: Graph,
    vertex_labels: list[dict[str, str]],
    edge_label: str = "relationship",
    where: list[Column | None] | None = None,
) -> DataFrame:
    """Signature counts of directed paths, grouped by the labels of their vertices and edges.

    ``vertex_labels[i]`` maps result columns to properties of the i-th vertex of
    the path; the edge after it is reported as ``e<i+1>``.  The vertex after the
    last labelled one is free, so k entries count paths of k edges.  ``where[i]``
    filters the i-th vertex's properties.

    Counts are carried from the path's end to its start: the table
    (vertex, signature of the rest) -> n has at most one row per vertex and
    distinct signature, never one per path.  The first vertex is labelled before
    its edges meet the rest of the path, so that leaves carry no signature.
    """
    where, key = where or [None] * len(vertex_labels), _count_key(graph)
    vertices, edges, _ = graph.short_ids()
    last = len(vertex_labels) - 1
    usable = passable(graph, edges, [(f"v{i}", f"e{i + 1}", f"v{i + 1}") for i in range(last + 1)])
    suffix: DataFrame | None = None
    fields: list[str] = []
    for i in reversed(range(last + 1)):
        edge_name = f"e{i + 1}"
        step = usable.of[edge_name].select(key("_src").alias("src"), key("_dst").alias("dst"), F.col(edge_label).alias(edge_name))
        labels = vertex_labels[i]
        holders = usable.held(vertices, f"v{i}")
        holders = holders if where[i] is None else holders.filter(where[i])
        labelled = holders.select(
            key("_id").alias("src"), *[F.col(prop).alias(name) for name, prop in labels.items()]
        )
        if i == 0 and last:
            counted = step.join(labelled, "src").drop("src").join(suffix.withColumnRenamed("src", "dst"), "dst")
        elif suffix is None:
            counted = step.groupBy("src", edge_name).agg(F.count("*").alias("n")).join(labelled, "src")
        else:
            counted = (
                step.join(suffix.withColumnRenamed("src", "dst"), "dst")
                .groupBy("src", edge_name, *fields)
                .agg(F.sum("n").alias("n"))
                .join(labelled, "src")
            )
        # written, so that the next join can split the edges of a hub
        suffix = cut(counted) if i else counted
        fields = [*labels, edge_name, *fields]
    return suffix.groupBy(*fields).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), *fields)


def star_counts(
    graph: Graph,
    centre: dict[str, str],
    out_ends: list[dict[str, str]],
    in_ends: list[dict[str, str]],
    edge_label: str = "relationship",
    in_where: Column | None = None,
) -> DataFrame:
    """Signature counts of stars: a centre with out-edges and in-edges of their own ends.

    Each arm is first aggregated to (centre, edge label, end labels) -> n; a star's
    count is the product of its arms' counts.  Rows per centre are bounded by the
    number of distinct arm signatures, whatever the centre's degree.
    Arms are named e1, e2, ... in the order out then in; arms of equal labels are counted once.
    """
    key = _count_key(graph)
    vertices, edges, _ = graph.short_ids()
    outs, ins = len(out_ends), len(in_ends)
    usable = passable(graph, edges, [
        *[("v0", f"e{k}", f"v{k}") for k in range(1, outs + 1)], *[(f"v{k}", f"e{k}", "v0") for k in range(outs + 1, outs + ins + 1)]])
    counted: dict[tuple, DataFrame] = {}

    def arm(number: int, labels: dict[str, str]) -> DataFrame:
        own, other = ("src", "dst") if number <= outs else ("dst", "src")
        kind = (own, *labels.values())
        if kind not in counted:
            ends = usable.held(vertices, f"v{number}")
            ends = ends if own == "src" or in_where is None else ends.filter(in_where)
            ends = ends.select(key("_id").alias(other), *[F.col(p).alias(f"l{k}") for k, p in enumerate(labels.values())])
            rows = usable.of[f"e{number}"].select(key("_src").alias("src"), key("_dst").alias("dst"), F.col(edge_label).alias("e")).join(ends, other)
            # written, so that the joins can split what a hub has
            counted[kind] = cut(rows.groupBy(F.col(own).alias("_centre"), "e", *[f"l{k}" for k in range(len(labels))]).agg(F.count("*").alias("n")))
        return counted[kind].select(
            "_centre", F.col("e").alias(f"e{number}"), *[F.col(f"l{k}").alias(c) for k, c in enumerate(labels)], F.col("n").alias(f"_n{number}"))

    fields = [*centre]
    stars = usable.held(vertices, "v0").select(key("_id").alias("_centre"), *[F.col(p).alias(c) for c, p in centre.items()])
    for number, labels in enumerate([*out_ends, *in_ends], 1):
        stars = stars.join(arm(number, labels), "_centre")
        fields += [f"e{number}", *labels]
    weight = reduce(lambda a, b: a * b, [F.col(f"_n{k}") for k in range(1, outs + ins + 1)])
    return stars.groupBy(*fields).agg(F.sum(weight).alias("n")).orderBy(F.desc("n"), *fields)


# --- triangles and four-cycles: rooted by degree ------------------------------------------


def ranked_edges(graph: Graph, edge_label: str | None, vertex_label: str | None, steps: list[Clause]) -> tuple[DataFrame, bool]:
    """Edges that the pattern's cycles may use, with short ids, each end's degree among them and, if asked,
    the labels; (degree, id) is an end's rank.  And whether some edge is a self-loop.

    Parallel edges with the same label are folded into a multiplicity ``m``.  An end of one edge is in no cycle
    unless the cycle goes round a self-loop, so without loops such edges go.
    """
    vertices, edges, _ = graph.short_ids()
    usable, known = passable(graph, edges, steps), graph.__dict__.setdefault("_ranked", {})
    round_trip = {s for s, _, _ in steps} == {d for _, _, d in steps}
    if (edge_label, vertex_label, usable.pairs, round_trip) in known:
        return known[edge_label, vertex_label, usable.pairs, round_trip]
    label = [F.col(edge_label).alias("e")] if edge_label else [F.lit("").alias("e")]
    rows = usable.used.select("_src", "_dst", *label)
    if round_trip:
        # every name is entered and left, so edges from or to a dead end are in no match
        rows = _passed_edges(rows)
    rows = rows.select(F.col("_src").alias("src"), F.col("_dst").alias("dst"), "e")
    loops = not rows.filter("src = dst").isEmpty()
    # written, so that the joins can split the edges of a hub
    degrees = endpoint_rows(rows).groupBy("id").agg(F.count("*").alias("degree"))
    facts = cut(degrees if loops else degrees.filter("degree > 1"))
    if vertex_label:
        facts = cut(facts.join(usable.held(vertices).select(F.col("_id").alias("id"), F.col(vertex_label).alias("label")), "id"))
    sides = {}
    for end, short in (("src", "s"), ("dst", "d")):
        sides[end] = facts.select(
            F.col("id").alias(end),
            F.col("degree").alias(f"{short}_degree"),
            *([F.col("label").alias(f"{short}_label")] if vertex_label else []),
        )
    # leaves go before the edges are folded
    folded = rows.join(sides["src"], "src")
    folded = folded.groupBy(*folded.columns).agg(F.count("*").alias("m")).join(sides["dst"], "dst")
    # read by every branch of every pattern on this graph, so it is written once
    known[edge_label, vertex_label, usable.pairs, round_trip] = cut(folded), loops
    return known[edge_label, vertex_label, usable.pairs, round_trip]


def triangle_matches(
    graph: Graph,
    pattern: str | Iterable[Clause],
    edge_label: str | None = "relationship",
    vertex_label: str | None = "type",
) -> DataFrame:
    """Matches of a three-clause pattern over three names, each pair of names linked once.

    Per name one branch covers the matches whose lowest rank sits at that name
    (the first such name on a tie, which only a repeated vertex can cause): the
    wedge opens at the lowest vertex and the third clause closes it on two keys.
    Result: the three ids, ``label_<name>``, ``label_<edge>`` and the multiplicity ``m``.
    """
    steps = clauses(pattern)
    names = sorted({n for s, _, d in steps for n in (s, d)})
    edges, loops = ranked_edges(graph, edge_label, vertex_label, steps)
    named = graph.short_ids()[2]

    def bind(step: Clause) -> DataFrame:
        source, edge, target = step
        labels = (
            [F.col("s_label").alias(f"label_{source}"), F.col("d_label").alias(f"label_{target}")]
            if vertex_label
            else []
        )
        return edges.select(
            F.col("src").alias(source),
            F.col("dst").alias(target),
            F.col("s_degree").alias(f"degree_{source}"),
            F.col("d_degree").alias(f"degree_{target}"),
            *labels,
            F.col("e").alias(f"label_{edge}"),
            F.col("m").alias(f"m_{edge}"),
        )

    def lower(a: str, b: str) -> Column:
        tie = F.col(a) <= F.col(b) if names.index(a) < names.index(b) else F.col(a) < F.col(b)
        left, right = F.col(f"degree_{a}"), F.col(f"degree_{b}")
        return (left < right) | ((left == right) & tie)

    out = [*names, *([f"label_{n}" for n in names] if vertex_label else []), *[f"label_{e}" for _, e, _ in steps]]
    branches = []
    for root in names:
        first, second = [s for s in steps if root in (s[0], s[2])]
        third = next(s for s in steps if root not in (s[0], s[2]))
        near, far = [n for n in (first[0], first[2]) if n != root][0], [n for n in (second[0], second[2]) if n != root][0]
        shared_cols = [f"degree_{root}", *([f"label_{root}"] if vertex_label else [])]
        wedge = (
            bind(first).filter(lower(root, near))
            .join(bind(second).filter(lower(root, far)).drop(*shared_cols), root)
        )
        if not loops:
            # the third clause would be a loop
            wedge = wedge.filter(F.col(near) != F.col(far))
        closing = bind(third).select(third[0], third[2], f"label_{third[1]}", f"m_{third[1]}")
        weight = reduce(lambda a, b: a * b, [F.col(f"m_{e}") for _, e, _ in steps])
        branches.append(
            wedge.join(closing, [third[0], third[2]]).select(*out, weight.alias("m"))
        )
    return reduce(DataFrame.unionByName, branches).withColumns({n: named(F.col(n)) for n in names})


def triangle_counts(graph: Graph, pattern: str | Iterable[Clause], **labels) -> DataFrame:
    """Signature counts over :func:`triangle_matches`."""
    matches = triangle_matches(graph, pattern, **labels)
    fields = [c for c in matches.columns if c.startswith("label_")]
    return (
        matches.groupBy(*fields)
        .agg(F.sum("m").alias("n"))
        .orderBy(F.desc("n"), *fields)
        .withColumnsRenamed({c: c.removeprefix("label_") for c in fields})
    )


def four_cycle_counts(graph: Graph, edge_label: str | None = "relationship", vertex_label: str = "type") -> DataFrame:
    """Signature counts of a -> b -> c -> d -> a without listing the cycles.

    Each cycle is cut at its highest-ranked vertex (the first such name on a tie)
    into a wedge leaving it and a wedge returning to it.  Wedges are folded to
    (top, opposite, labels) -> n before the two halves meet, and a wedge's middle
    and far end never outrank its top.
    """
    edges, _ = ranked_edges(graph, edge_label, vertex_label, clauses("(a)-[e1]->(b); (b)-[e2]->(c); (c)-[e3]->(d); (d)-[e4]->(a)"))

    def half(leaving: bool) -> DataFrame:
        """Wedge between top and opposite, with the ties the naming rule needs."""
        near = edges.select(
            F.col("src" if leaving else "dst").alias("top"),
            F.col("dst" if leaving else "src").alias("mid"),
            F.col("s_degree" if leaving else "d_degree").alias("top_degree"),
            F.col("d_degree" if leaving else "s_degree").alias("mid_degree"),
            F.col("s_label" if leaving else "d_label").alias("top_label"),
            F.col("d_label" if leaving else "s_label").alias("mid_label"),
            F.col("e").alias("near_e"),
            F.col("m").alias("near_m"),
        ).filter("mid_degree < top_degree OR (mid_degree = top_degree AND mid <= top)")
        far = edges.select(
            F.col("src" if leaving else "dst").alias("mid"),
            F.col("dst" if leaving else "src").alias("opp"),
            F.col("d_degree" if leaving else "s_degree").alias("opp_degree"),
            F.col("d_label" if leaving else "s_label").alias("opp_label"),
            F.col("e").alias("far_e"),
            F.col("m").alias("far_m"),
        )
        side = "out" if leaving else "in"
        return (
            near.join(far, "mid")
            .filter("opp_degree < top_degree OR (opp_degree = top_degree AND opp <= top)")
            .groupBy(
                "top", "opp", "top_label", "opp_label",
                (F.col("mid") == F.col("top")).alias(f"{side}_mid_is_top"),
                F.col("mid_label").alias(f"{side}_mid"),
                F.col("near_e").alias(f"{side}_near"),
                F.col("far_e").alias(f"{side}_far"),
            )
            .agg(F.sum(F.col("near_m") * F.col("far_m")).alias(f"{side}_n"))
        )

    back = half(False).drop("top_label", "opp_label")
    cycles = half(True).join(back, ["top", "opp"]).withColumn("opp_is_top", F.col("opp") == F.col("top"))
    # which names stand at the top, the way out, the opposite end and the way back
    turns = ["abcd", "bcda", "cdab", "dabc"]
    edge_names = {"ab": "e1", "bc": "e2", "cd": "e3", "da": "e4"}
    rows = []
    for top, out_mid, opp, in_mid in turns:
        ties = {out_mid: "out_mid_is_top", opp: "opp_is_top", in_mid: "in_mid_is_top"}
        kept = cycles
        for name, flag in ties.items():
            if name < top:
                kept = kept.filter(~F.col(flag))
        rows.append(
            kept.select(
                F.col("top_label").alias(top),
                F.col("out_mid").alias(out_mid),
                F.col("opp_label").alias(opp),
                F.col("in_mid").alias(in_mid),
                F.col("out_near").alias(edge_names[top + out_mid]),
                F.col("out_far").alias(edge_names[out_mid + opp]),
                F.col("in_far").alias(edge_names[opp + in_mid]),
                F.col("in_near").alias(edge_names[in_mid + top]),
                (F.col("out_n") * F.col("in_n")).alias("n"),
            )
        )
    fields = ["a", "e1", "b", "e2", "c", "e3", "d", "e4"]
    return (
        reduce(DataFrame.unionByName, rows)
        .groupBy(*fields)
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), *fields)
    )


# --- built on matches -----------------------------------------------------------------------


def collapse(matches: DataFrame, members: list[str]) -> DataFrame:
    """Fold matches over the same members into one higher-order node.

    The result is the (group, member) incidence.  Two groups are linked when they
    share a member; the incidence keeps that relation in linear size, since a hub
    in many groups is one member and not a pair of every two of its groups.
    """
    ids = F.array_sort(F.array_distinct(F.array(*[F.col(m).cast("string") for m in members])))
    return matches.select(F.array_join(ids, "-").alias("group"), ids.alias("_ids")).distinct().select(
        "group", F.explode("_ids").alias("member")
    )


def multi_paths(graph: Graph, minimum: int = 2) -> DataFrame:
    """Pairs (a, c) joined by at least ``minimum`` different two-step paths.

    Only sources with that many successors and targets with that many
    predecessors can qualify, so the leaves around a hub go before the join.
    """
    _, edges, named = graph.short_ids()
    usable = passable(graph, edges, [("a", "e", "b"), ("b", "e2", "c")])
    # written, as the counts and the join read them
    first, second = (
        cut(usable.of[e].select(F.col("_src").alias(s), F.col("_dst").alias(d)).filter(F.col(s) != F.col(d)).distinct())
        for s, e, d in (("a", "e", "b"), ("b", "e2", "c")))
    enough_out = first.groupBy("a").count().filter(F.col("count") >= minimum).select("a")
    enough_in = second.groupBy("c").count().filter(F.col("count") >= minimum).select("c")
    return (
        first.join(enough_out, "a", "left_semi").join(second.join(enough_in, "c", "left_semi"), "b")
        .filter("a <> c")
        .groupBy("a", "c")
        .agg(F.count("*").alias("paths"))
        .filter(F.col("paths") >= minimum)
        .select(named(F.col("a")).alias("a"), named(F.col("c")).alias("c"), "paths")
    )
