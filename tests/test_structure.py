"""Hand-made graphs with known answers."""

import itertools
import random

from pyspark.sql import functions as F

from graphloom.graph import Graph, undirected_pairs
from graphloom.operators import centrality, community, components, motifs, structure
from graphloom.session import cut

CYCLE3 = [(1, 2), (2, 3), (3, 1)]
FEED_FORWARD = [(1, 2), (1, 3), (3, 2)]
FULL3 = [(a, b) for a in (1, 2, 3) for b in (1, 2, 3) if a != b]
CYCLE4 = [(1, 2), (2, 3), (3, 4), (4, 1)]
STAR = [(i, 0) for i in range(1, 6)] + [(0, 9)]
PATH4 = [(1, 2), (2, 3), (3, 4)]
BOWTIE = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (3, 5)]
BARBELL = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (5, 6), (4, 6)]

G4 = "(a)-[e]->(b); (b)-[e2]->(c); (c)-[e3]->(a)"
G5 = "(a)-[e]->(b); (a)-[e2]->(c); (c)-[e3]->(b)"


def total(df):
    return sum(r["n"] for r in df.collect())


def as_dict(df, value):
    return {r["id"]: r[value] for r in df.collect()}


def test_triangles(make):
    assert total(motifs.triangle_counts(make(CYCLE3), G4)) == 3
    assert total(motifs.triangle_counts(make(CYCLE3), G5)) == 0
    assert total(motifs.triangle_counts(make(FEED_FORWARD), G5)) == 1
    assert total(motifs.triangle_counts(make(FEED_FORWARD), G4)) == 0


def test_rooted_counts_equal_plain_matches_with_loops_and_parallels(make):
    graph = make(FULL3 + CYCLE4 + [(1, 1), (1, 2), (4, 2), (2, 4)])
    for pattern in (G4, G5):
        assert total(motifs.triangle_counts(graph, pattern)) == motifs.find(graph, pattern, vertex_columns=[]).count()
    four = "(a)-[e]->(b); (b)-[e2]->(c); (c)-[e3]->(d); (d)-[e4]->(a)"
    assert total(motifs.four_cycle_counts(graph)) == motifs.find(graph, four, vertex_columns=[]).count()


def test_path_and_star_counts(make):
    labels = [{f"v{i}": "type"} for i in range(3)]
    assert total(motifs.path_counts(make(PATH4), labels)) == 1
    star = motifs.star_counts(make(STAR), {"a": "type"}, [{"b": "type"}], [{"c": "type"}, {"d": "type"}])
    assert total(star) == 25
    assert total(motifs.four_cycle_counts(make(CYCLE4))) == 4


def test_distinct_vertices_and_disconnected_pattern(make):
    import pytest

    pattern = "(a)-[e]->(b); (c)-[e2]->(a); (d)-[e3]->(a)"
    assert motifs.find(make(STAR), pattern, vertex_columns=[], distinct_vertices=True).count() == 20
    with pytest.raises(ValueError):
        motifs.find(make(STAR), "(a)-[e]->(b); (c)-[f]->(d)")


def test_clustering(make):
    assert as_dict(structure.clustering_directed(make(CYCLE3)), "clustering") == {1: 0.5, 2: 0.5, 3: 0.5}
    assert as_dict(structure.clustering_directed(make(FULL3)), "clustering") == {1: 1.0, 2: 1.0, 3: 1.0}
    assert as_dict(structure.clustering_undirected(make(FEED_FORWARD)), "clustering") == {1: 1.0, 2: 1.0, 3: 1.0}
    assert as_dict(structure.triangle_count(make(BOWTIE)), "triangles") == {1: 1, 2: 1, 3: 2, 4: 1, 5: 1}


def test_degrees_and_isolates(make):
    graph = make(CYCLE3 + [(5, 5)], extra=[7])
    d = {r["id"]: (r["in_degree"], r["out_degree"], r["degree"]) for r in structure.degrees(graph).collect()}
    assert d[1] == (1, 1, 2) and d[5] == (1, 1, 2) and d[7] == (0, 0, 0)
    assert structure.join_degree(graph, keep_isolates=False).vertices.count() == 4
    assert graph.without_isolates().vertices.count() == 4
    assert structure.reciprocal_pairs(make(FULL3).edges.select("src", "dst")).count() == 3


def test_components(make):
    graph = make(CYCLE3 + [(11, 12), (12, 13), (13, 14)], extra=[99])
    found = components.connected_components(graph)
    assert as_dict(found, "component") == {1: 1, 2: 1, 3: 1, 11: 11, 12: 11, 13: 11, 14: 11, 99: 99}
    assert components.largest_component(graph, found).vertices.count() == 4
    long_path = make([(i, i + 1) for i in range(60)])
    assert components.connected_components(long_path).select("component").distinct().count() == 1


def test_strong_components(make):
    graph = make(CYCLE3 + [(3, 4), (4, 5), (5, 4), (5, 6)], extra=[9])
    assert as_dict(components.strongly_connected_components(graph), "scc") == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 9: 9}


def test_bridges(make):
    def found(pairs):
        return {(r["src"], r["dst"]) for r in components.bridges(make(pairs)).collect()}

    assert found(BARBELL) == {(3, 4)}
    assert found(PATH4) == {(1, 2), (2, 3), (3, 4)}
    assert found(CYCLE4) == set()
    assert found([]) == set()


def test_bridges_of_random_forests_and_cycles(make):
    rng = random.Random(9)
    for _ in range(3):
        pairs = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(38)}

        def linked(a, b, without, pairs=pairs):
            met, stack = {a}, [a]
            while stack:
                x = stack.pop()
                for p in pairs - {without}:
                    y = p[1] if p[0] == x else p[0] if p[1] == x else None
                    if y is not None and y not in met:
                        met.add(y)
                        stack.append(y)
            return b in met

        want = {p for p in pairs if not linked(*p, p)}
        assert {(r["src"], r["dst"]) for r in components.bridges(make(pairs)).collect()} == want


def test_rounds_do_not_grow_with_depth_or_number_of_components(spark, monkeypatch):
    """A path of 10,000 has as many levels; written tables stand for rounds."""
    tables = []
    monkeypatch.setattr(components, "cut", lambda df: tables.append(1) or cut(df))
    links = spark.range(10_000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    path = Graph(spark.range(10_001).select("id"), links.union(spark.createDataFrame([(9000, 9500)], "src bigint, dst bigint")))
    assert components.bridges(path).count() == 9500
    assert len(tables) < 150
    tables.clear()
    # 400 rings of five, the first ten of them in a row: as many strong components
    rings = spark.range(2000).select(F.col("id").alias("src"), F.when(F.col("id") % 5 == 4, F.col("id") - 4).otherwise(F.col("id") + 1).alias("dst"))
    chain = spark.range(9).select((F.col("id") * 5 + 2).alias("src"), (F.col("id") * 5 + 5).alias("dst"))
    found = components.strongly_connected_components(Graph(spark.range(2000).select("id"), rings.union(chain)))
    assert found.filter("scc <> id - id % 5").count() == 0 and found.count() == 2000
    assert len(tables) < 120


def test_hyperball_stays_near_the_exact_value(make):
    rng = random.Random(3)
    graph = make({(rng.randrange(300), rng.randrange(300)) for _ in range(900)})
    near = as_dict(centrality.closeness_centrality(graph, 8), "closeness")
    exact = as_dict(centrality.exact_closeness(graph), "closeness")
    assert set(near) == set(exact) and all((near[i] == 0) == (exact[i] == 0) for i in exact)
    assert sum(abs(near[i] - exact[i]) for i in exact) < 0.065 * sum(exact.values())


def test_centralities(make):
    ranks = as_dict(centrality.pagerank(make(STAR)), "rank")
    assert abs(sum(ranks.values()) - 1) < 1e-9 and max(ranks, key=ranks.get) == 9
    for measure in (centrality.closeness_centrality, centrality.exact_closeness):
        close = as_dict(measure(make(PATH4)), "closeness")
        assert close[1] == 0.0 and abs(close[4] - 3 / 6) < 1e-9 and abs(close[2] - 1 / 3) < 1e-9
    between = as_dict(centrality.betweenness(make(PATH4)), "betweenness")
    assert between == {1: 0.0, 2: 2.0, 3: 2.0, 4: 0.0}
    eigen = as_dict(centrality.eigenvector_centrality(make(CYCLE4)), "eigenvector")
    assert all(abs(x - 0.5) < 1e-6 for x in eigen.values())


def test_louvain_splits_the_barbell(make):
    graph = make(BARBELL + [(b, a) for a, b in BARBELL])
    found = community.louvain(graph)
    assert as_dict(found, "community") == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4}
    assert community.modularity(graph, found).first()[0] > 0.3


def test_hub_with_a_third_of_all_edges(make):
    """A hub must not change results of the rooted and factorised forms."""
    hub = [(i, 0) for i in range(1, 200)] + [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(1, 120)]
    graph = make(hub)
    for pattern in (G4, G5):
        assert total(motifs.triangle_counts(graph, pattern)) == motifs.find(graph, pattern, vertex_columns=[]).count()


def brute_dispersion(links):
    after = {}
    for a, b in links:
        if a != b:
            after.setdefault(a, set()).add(b)
    found = {}
    for u in after:
        for v in after[u]:
            common = sorted(after[u] & after.get(v, set()))
            far = 0
            for s, t in itertools.combinations(common, 2):
                inside = (after[u] & after.get(s, set())) - {u, v}
                far += t not in inside and inside.isdisjoint(after.get(t, set()))
            found[u, v] = (len(common), far / len(common) if common else 0.0)
    return found


def test_dispersion_against_brute_force(make):
    rng = random.Random(3)
    links = [(rng.randrange(24), rng.randrange(24)) for _ in range(170)]
    # a hub linked with everyone, loops, repeated links and a part of its own
    links += [(50, i) for i in range(24)] + [(i, 50) for i in range(0, 24, 2)] + [(3, 3), links[0], (60, 61), (61, 62), (60, 62)]
    want = brute_dispersion(links)
    got = {(r.u, r.v): (r.embeddedness, r.dispersion) for r in structure.dispersion(make(links)).collect()}
    assert got == want and max(k for k, _ in want.values()) > 5
    assert any(0 < d for _, d in want.values())


def test_dispersion_pairs_no_successors_of_a_hub(make, spark):
    """A hub that points at many vertices without links among them leaves no row behind."""
    links = [(0, i) for i in range(1, 3000)]
    assert structure.ego_links(make(links).edges.select("src", "dst")).count() == 0
    assert structure.dispersion(make(links[:50])).agg({"embeddedness": "max"}).first()[0] == 0


def test_sampled_paths_stay_within_the_error(make):
    rng = random.Random(9)
    # two crowds that meet in vertex 0, a tail, and a part that nothing reaches
    links = [(rng.randrange(1, 16), rng.randrange(1, 16)) for _ in range(50)]
    links += [(rng.randrange(16, 31), rng.randrange(16, 31)) for _ in range(50)]
    links += [(i, 0) for i in (1, 5, 20)] + [(0, i) for i in (2, 7, 17, 25)] + [(30, 31), (31, 32), (32, 33), (40, 41)]
    graph = make(links, extra=[50])
    n = graph.vertices.count()
    exact = as_dict(centrality.betweenness(graph), "betweenness")
    got = as_dict(centrality.betweenness_by_paths(graph, error=0.04), "betweenness")
    assert set(got) == set(exact) and max(exact.values()) / (n * (n - 1)) > 0.1
    assert max(abs(got[v] - exact[v] / (n * (n - 1))) for v in exact) <= 0.04
    assert all(got[v] == 0 for v in exact if exact[v] == 0)
    assert set(as_dict(centrality.betweenness_by_paths(make([(1, 2)])), "betweenness").values()) == {0.0}


def test_strong_components_broadcast_nothing_in_their_rounds(make, monkeypatch):
    graph = make([(1, 2), (2, 1), (2, 3)])
    kept, plans = components.cut, []
    monkeypatch.setattr(components, "cut", lambda df: plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString())) or kept(df))
    found = as_dict(components.strongly_connected_components(graph), "scc")
    assert found == {1: 1, 2: 1, 3: 3}
    # numbering sends one row for each partition, and only once
    assert not [columns for columns, plan in plans if "Broadcast" in plan and columns != ["id", "rank"]]


def test_components_with_leaves_are_named_by_the_smallest_id(make, spark):
    # a pair, a star whose centre is larger than its leaves, one whose smallest id hangs on a cycle, a lone vertex
    pairs = [(8, 7), (20, 11), (20, 12), (30, 31), (31, 32), (32, 30), (32, 3), (40, 40)]
    found = as_dict(components.connected_components(make(pairs, [50])), "component")
    assert found == {7: 7, 8: 7, 11: 11, 12: 11, 20: 11, 3: 3, 30: 3, 31: 3, 32: 3, 40: 40, 50: 50}
    links, hung = components._without_leaves(cut(undirected_pairs(make(pairs).edges)))
    assert links.count() == 3 and {tuple(r) for r in hung.collect()} == {(8, 7), (11, 20), (12, 20), (3, 32)}
