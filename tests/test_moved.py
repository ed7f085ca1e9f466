"""What is written and shuffled: keyed tables for the typed graph, every wedge once."""

import datetime
import time

from pyspark.sql import functions as F

from graphloom.functions.hashing import stable_id
from graphloom.graph import Graph
from graphloom.operators import etl, motifs, structure
from graphloom.plans import etl_queries
from graphloom.plans import fixtures as fx
from graphloom.session import cut, tune


def source(spark, folder):
    """Two customers and one that is no user, posts of both, repeated rows and a vote on no post."""
    day = datetime.datetime(2020, 1, 1)
    rows = {
        "customer": ([(1, "a", "x"), (2, "b", "y"), (2, "b", "y")], "c_custkey bigint, c_name string, c_mktsegment string"),
        "orders": ([(10, 1, "O", 1.0, day, "HIGH"), (11, 1, "F", 2.0, day, "LOW"), (11, 1, "F", 2.0, day, "LOW"), (12, 7, "F", 3.0, day, "LOW")],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(10, 1, 5, 6, "R"), (10, 1, 5, 6, "R"), (11, 2, 5, None, "N"), (99, 1, 5, 6, "N")],
                     "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string"),
        "events": ([(1, 1, "click"), (2, 9, "view")], "event_id bigint, user_id bigint, event_type string"),
        "conversations": ([(1, 0, "user"), (1, 0, "user")], "conv_id bigint, turn int, role string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_the_written_forum_holds_source_keys_and_reads_as_ids(spark, tmp_path):
    sf = source(spark, tmp_path)
    graph = fx.forum(spark, sf)
    for name in ("edges", "vertices"):
        rows = getattr(graph, name)
        kept = spark.read.parquet(*rows.inputFiles())
        held = kept.select("src.*") if name == "edges" else kept.select("type", F.col("source_id").alias("key"))
        assert held.filter(F.length("key") > 30).isEmpty() and "id" not in kept.columns
    wanted = etl.union_vertices(*[etl.typed(t, kind, key) for t, kind, key in (
        (fx.forum_posts(spark, sf).drop("raw_tags"), "Post", "post_key"), (fx.forum_users(spark, sf), "User", "user_key"),
        (fx.forum_votes(spark, sf), "Vote", "vote_key"), (fx.forum_tags(spark, sf), "Tag", "tag_name"),
        (fx.forum_badges(spark, sf), "Badge", "badge_key"),
        (fx.forum_links(spark, sf).filter("link_related IS NOT NULL"), "PostLinks", "link_post"),
        (fx.forum_comments(spark, sf), "Comment", "comment_key"))])
    assert graph.vertices.columns == wanted.columns
    assert sorted(map(repr, graph.vertices.collect())) == sorted(map(repr, wanted.collect()))
    votes = etl.cast_for_edges(fx.forum_votes(spark, sf), fx.forum_posts(spark, sf))
    cast = graph.edges.filter("relationship = 'CastFor'")
    assert sorted(map(repr, cast.collect())) == sorted(map(repr, votes.collect())) and cast.count() == 3


def test_disjoint_tables_drop_their_own_repeats(spark):
    a = etl.typed(spark.createDataFrame([(1, "x"), (1, "x"), (None, "x")], "k bigint, p string"), "A", "k")
    b = etl.typed(spark.createDataFrame([(1, 2.0), (1, 2.0)], "k bigint, q double"), "B", "k")
    apart, whole = etl.union_vertices(a, b, disjoint=True), etl.union_vertices(a, b)
    assert sorted(map(repr, apart.collect())) == sorted(map(repr, whole.collect())) and apart.count() == 3
    one = spark.createDataFrame([("A", None)], "t string, k bigint")
    assert one.select(stable_id(F.col("t"), "k") == stable_id("A", "k")).first()[0]


def test_a_wedge_is_opened_once(spark, make):
    clique = make([(i, j) for i in range(12) for j in range(12) if i < j])
    found = structure.triangle_count(clique)
    assert {r["triangles"] for r in found.collect()} == {55}
    # of the two orders of a wedge's ends, only the one that can close is shuffled
    wedges = structure._wedges(*[
        structure.oriented_pairs(clique.edges.select("src", "dst")).select(F.col("low").alias("a"), F.col("high").alias(x), F.col("rank").alias(f"{x}_rank"))
        for x in "bc"])
    assert wedges.count() == 220


def test_counts_carry_short_keys_for_long_ids(spark):
    """Long text ids, short ones and NULL ends give the counts that the same graph has with numbers."""
    long = lambda c: F.when(F.col(c) % 2 == 0, F.sha2(F.col(c).cast("string"), 256)).otherwise(F.col(c).cast("string"))
    vertices = spark.range(9).select("id", F.when(F.col("id") < 5, "P").otherwise("V").alias("type"))
    edges = spark.createDataFrame(
        [(i, (i * i + k) % 9, "R" if k else "S") for i in range(9) for k in range(3)] + [(None, 1, "R")],
        "src bigint, dst bigint, relationship string")
    plain = Graph(vertices, edges)
    texts = Graph(vertices.withColumn("id", long("id")), edges.withColumns({"src": long("src"), "dst": long("dst")}))
    key = motifs._join_key(texts)
    assert texts.edges.select(F.max(F.octet_length(key("src")))).first()[0] == 16
    paths = [{"a": "type"}, {"b": "type"}, {"c": "type"}]
    for count in (lambda g: motifs.path_counts(g, paths, where=[F.col("id") == g.vertices["id"], None, None]),
                  lambda g: motifs.star_counts(g, {"a": "type"}, [{"b": "type"}], [{"c": "type"}], in_where=F.col("type") == "V")):
        assert sorted(count(texts).collect()) == sorted(count(plain).collect())


def test_matches_carry_source_keys_and_show_ids(spark, tmp_path):
    graph = fx.forum(spark, source(spark, tmp_path))
    plain = Graph(graph.vertices, graph.edges)
    pattern, where = "(a)-[e]->(b); (b)-[e2]->(c); (b)-[l]->(b)", {"a": F.col("type") == "User", "b": F.col("id") != "", "e2": F.col("relationship") == "Answers"}
    for steps in (pattern, pattern.rsplit(";", 1)[0]):
        for columns in (None, [], ["type", "source_id"]):
            apart, whole = (motifs.find(g, steps, where=where, vertex_columns=columns) for g in (graph, plain))
            assert apart.schema == whole.schema and sorted(map(repr, apart.collect())) == sorted(map(repr, whole.collect()))
    found = motifs.find(graph, "(a)-[e]->(b); (b)-[e2]->(c)", where={"a": F.col("type") == "User"}, vertex_columns=["type"])
    assert found.count() > 0
    # ids are hashed once at the end, above every join
    lines = [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n")]
    first_join = next(i for i, x in enumerate(lines) if "Join" in x)
    assert any("sha2" in x for x in lines[:first_join]) and not any("sha2" in x for x in lines[first_join:])
    degrees = structure.join_type_degree(graph).vertices
    want = structure.join_type_degree(plain).vertices
    assert degrees.columns == want.columns and sorted(map(repr, degrees.collect())) == sorted(map(repr, want.collect()))


def test_a_repeated_vertex_repeats_its_matches(spark):
    graph = Graph(spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "id bigint, type string"),
                  spark.createDataFrame([(1, 2, "R"), (1, 1, "R"), (1, 3, "R")], "src bigint, dst bigint, relationship string"))
    for where in (None, {"a": F.col("type") == "x"}):
        found = motifs.find(graph, "(a)-[e]->(b)", where=where, vertex_columns=["type"])
        assert sorted((r["a"]["id"], r["b"]["id"]) for r in found.collect()) == [(1, 1)] * 4 + [(1, 2)] * 2
    assert motifs.find(graph, "(a)-[e]->(a)", where={"a": F.col("type") == "x"}, vertex_columns=["type"]).count() == 2


def test_cycles_are_listed_among_edges_that_go_on(spark, make):
    # a cycle of four and a vertex with a hundred dead ends each way
    pairs = [(0, 1), (1, 2), (2, 3), (3, 0), (4, 4)] + [(0, 100 + i) for i in range(100)] + [(200 + i, 0) for i in range(100)]
    graph = make(pairs)
    four = "(a)-[e]->(b); (b)-[e2]->(c); (c)-[e3]->(d); (d)-[e4]->(a)"
    for where in (None, {"e": F.col("src") >= 0, "a": F.col("id") < 50}):
        found = motifs.find(graph, four, where=where, vertex_columns=["type"])
        assert sorted(tuple(r[n]["id"] for n in "abcd") for r in found.collect()) == [(0, 1, 2, 3), (1, 2, 3, 0), (2, 3, 0, 1), (3, 0, 1, 2), (4, 4, 4, 4)]
        kept = spark.read.parquet(*[f for f in found.inputFiles() if "/cut-" in f])
        assert kept.count() == 5


def test_a_saved_forum_is_written_once(spark, tmp_path):
    sf = source(spark, tmp_path)
    graph = fx.forum(spark, sf)
    saved = etl_queries._saved_forum(spark, sf)
    assert not any("edges" in made.__dict__ or "vertices" in made.__dict__ for key, made in fx._built.items() if key[1] == sf and key[2] == "forum")
    for name, columns in (("vertices", ["id", "type", "source_id", "vote_type"]), ("edges", ["src", "dst", "relationship"])):
        assert sorted(map(repr, getattr(saved, name).select(*columns).collect())) == sorted(map(repr, getattr(graph, name).select(*columns).collect()))


def test_counts_read_only_kinds_that_can_match(spark, tmp_path):
    graph = fx.forum(spark, source(spark, tmp_path))
    plain = Graph(graph.vertices, graph.edges)
    usable = motifs.passable(graph, graph.short_ids()[1], motifs.clauses("(a)-[e]->(b); (b)-[e2]->(c); (c)-[e3]->(d)"))
    assert usable.kinds["b"] == usable.kinds["c"] == usable.kinds["d"] == {"Post"} and "Vote" in usable.kinds["a"]
    assert usable.of["e"].count() > usable.of["e2"].count() == graph.edges.filter("relationship IN ('Answers', 'Links')").join(
        graph.vertices.filter("type = 'Post'"), F.col("id") == F.col("src"), "left_semi").count()
    assert usable.held(graph.short_ids()[0], "b").filter("type <> 'Post'").isEmpty()
    paths, star = [{"a": "type", "k": "vote_type"}, {"b": "type"}, {"c": "type"}], [{"c": "type"}, {"d": "type"}]
    for count in (lambda g: motifs.path_counts(g, paths[:2]), lambda g: motifs.path_counts(g, paths, where=[F.col("type") == "Vote", None, None]),
                  lambda g: motifs.star_counts(g, {"a": "type"}, [{"b": "type"}], star), lambda g: motifs.star_counts(g, {"a": "type"}, [], star, in_where=F.col("type") == "Vote"),
                  lambda g: motifs.triangle_counts(g, "(a)-[e]->(b); (a)-[e2]->(c); (c)-[e3]->(b)"),
                  lambda g: motifs.triangle_matches(g, "(a)-[e]->(b); (a)-[e2]->(c); (c)-[e3]->(b)"),
                  motifs.four_cycle_counts, lambda g: motifs.multi_paths(g, 1)):
        assert sorted(map(repr, count(graph).collect())) == sorted(map(repr, count(plain).collect()))
    assert motifs.multi_paths(graph, 1).count() > 0


def test_leaves_stand_in_no_ranked_edge(spark, make):
    pairs = [(0, 1), (0, 2), (2, 1)] + [(0, 100 + i) for i in range(20)] + [(200 + i, 1) for i in range(20)]
    steps = motifs.clauses("(a)-[e]->(b); (a)-[e2]->(c); (c)-[e3]->(b)")
    edges, loops = motifs.ranked_edges(make(pairs), "relationship", "type", steps)
    assert edges.count() == 3 and not loops
    # round a self-loop an edge of a leaf is a match
    edges, loops = motifs.ranked_edges(make([*pairs, (1, 1)]), "relationship", "type", steps)
    assert edges.count() == 44 and loops


def test_shuffle_files_go_when_an_action_ends(spark):
    own = tune(spark.newSession())
    held = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before = held()
    table = cut(own.range(20_000).groupBy((F.col("id") % 999).alias("k")).count())
    for _ in range(40):
        if held() <= before:
            break
        time.sleep(0.25)
    assert held() <= before and table.count() == 999
    # a plan whose files are gone makes them anew
    again = own.range(20_000).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(again.collect()) == sorted(again.collect())
