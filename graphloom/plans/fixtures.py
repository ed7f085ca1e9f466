"""Graphs derived from the driver tables, each with the same thing as SQL text.

Every graph covers its whole source tables.  A derived graph is written
once per session and then shared by the queries that read it, as a graph
loaded once would be.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.hashing import entity_text, hashed, stable_id
from graphloom.functions.ordering import next_value
from graphloom.functions.text import split_pipe_tags, vote_type
from graphloom.graph import Graph
from graphloom.operators import etl
from graphloom.session import cut

_built: dict[tuple[str, str, str], object] = {}


def shared(build: Callable) -> Callable:
    """Remember what ``build`` made for this session and folder."""

    def wrapper(spark: SparkSession, sf: str):
        key = (spark.sparkContext.applicationId, sf, build.__name__)
        if key not in _built:
            _built[key] = build(spark, sf)
        return _built[key]

    wrapper.__name__ = build.__name__
    return wrapper


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- copurchase: parts on consecutive lines of an order -----------------------------------

COPURCHASE = """
copurchase_steps AS (
  SELECT l_partkey AS src,
         lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst
  FROM lineitem),
edges AS (SELECT DISTINCT src, dst FROM copurchase_steps WHERE dst IS NOT NULL AND src <> dst),
vertices AS (SELECT p_partkey AS id, p_brand AS brand, p_type AS kind, p_size AS size FROM part)
"""


def parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("kind"),
        F.col("p_size").alias("size"),
    )


@shared
def copurchase(spark: SparkSession, sf: str) -> Graph:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("src"))
    steps = next_value(lines, "l_orderkey", ["l_linenumber"], "src", "dst")
    edges = steps.filter("dst IS NOT NULL AND src <> dst").select("src", "dst").distinct()
    return Graph(parts(spark, sf), cut(edges))


# --- coship: parts sent to one customer in one week, in shipping order (sparse) ------------

COSHIP = """
coship_steps AS (
  SELECT l_partkey AS src,
         lead(l_partkey) OVER (PARTITION BY o_custkey, date_trunc('week', l_shipdate)
                               ORDER BY l_shipdate, l_partkey) AS dst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
edges AS (SELECT DISTINCT src, dst FROM coship_steps WHERE dst IS NOT NULL AND src <> dst),
vertices AS (SELECT p_partkey AS id, p_brand AS brand, p_type AS kind, p_size AS size FROM part)
"""


@shared
def coship(spark: SparkSession, sf: str) -> Graph:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_shipdate", F.col("l_partkey").alias("src"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.struct("o_custkey", F.date_trunc("week", "l_shipdate").alias("week")).alias("parcel"),
            "l_shipdate",
            "src",
        )
    )
    steps = next_value(lines, "parcel", ["l_shipdate"], "src", "dst")
    edges = steps.filter("dst IS NOT NULL AND src <> dst").select("src", "dst").distinct()
    return Graph(parts(spark, sf), cut(edges))


# --- forum: a question-and-answer site told by the order tables ----------------------------
# Users are customers; a customer's first order is a question, later ones answer it;
# order lines vote; events are badges; consecutive orders are linked; conversation
# turns are comments; an order's priority and status are its tags.

FORUM_TABLES = """
first_posts AS (
  SELECT o_custkey AS first_owner, arg_min(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS first_key
  FROM orders GROUP BY o_custkey),
posts AS (
  SELECT o_orderkey AS post_key, o_custkey AS owner_key,
         CASE WHEN first_key <> o_orderkey THEN first_key END AS parent_key,
         o_totalprice AS score, '|' || o_orderpriority || '|' || o_orderstatus || '|' AS raw_tags
  FROM orders JOIN first_posts ON o_custkey = first_owner),
users AS (SELECT c_custkey AS user_key, c_name AS name, c_mktsegment AS segment FROM customer),
votes AS (
  SELECT DISTINCT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag) AS vote_key,
         l_orderkey AS vote_post,
         l_linenumber + CASE WHEN l_returnflag = 'R' THEN 6 ELSE 1 END AS vote_code
  FROM lineitem),
vote_names AS (
  SELECT * FROM (VALUES (2,'UpVote'),(3,'DownVote'),(4,'Favorite'),(5,'Close'),(6,'Reopen'),(7,'BountyStart'),
    (8,'BountyClose'),(9,'Deletion'),(10,'Undeletion'),(11,'Spam'),(12,'InformModerator')) t(code, label)),
post_tags AS (
  SELECT post_key, unnest(string_split(trim(raw_tags, '|'), '|')) AS tag FROM posts),
tags AS (SELECT DISTINCT tag AS tag_name FROM post_tags),
badges AS (SELECT event_id AS badge_key, user_id AS badge_user, event_type AS badge_name FROM events),
links AS (
  SELECT o_orderkey AS link_post,
         lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS link_related
  FROM orders),
comments AS (SELECT conv_id || '-' || turn AS comment_key, conv_id AS comment_post, role FROM conversations)
"""

FORUM = (
    FORUM_TABLES
    + """,
vertices AS MATERIALIZED (
  SELECT DISTINCT sha256('Post:' || post_key) AS id, 'Post' AS type, post_key::VARCHAR AS source_id, NULL AS vote_type FROM posts
  UNION ALL SELECT sha256('User:' || user_key), 'User', user_key::VARCHAR, NULL FROM users
  UNION ALL SELECT sha256('Vote:' || vote_key), 'Vote', vote_key, coalesce(label, 'Unknown')
            FROM votes LEFT JOIN vote_names ON code = vote_code
  UNION ALL SELECT sha256('Tag:' || tag_name), 'Tag', tag_name, NULL FROM tags
  UNION ALL SELECT sha256('Badge:' || badge_key), 'Badge', badge_key::VARCHAR, NULL FROM badges
  UNION ALL SELECT sha256('PostLinks:' || link_post), 'PostLinks', link_post::VARCHAR, NULL FROM links WHERE link_related IS NOT NULL
  UNION ALL SELECT sha256('Comment:' || comment_key), 'Comment', comment_key, NULL FROM comments),
edges AS MATERIALIZED (
  SELECT sha256('Vote:' || vote_key) AS src, sha256('Post:' || post_key) AS dst, 'CastFor' AS relationship
  FROM votes JOIN posts ON vote_post = post_key
  UNION ALL SELECT sha256('User:' || user_key), sha256('Post:' || post_key),
            CASE WHEN parent_key IS NULL THEN 'Asks' ELSE 'Answers' END
            FROM posts JOIN users ON owner_key = user_key
  UNION ALL SELECT sha256('Post:' || a.post_key), sha256('Post:' || q.post_key), 'Answers'
            FROM posts a JOIN posts q ON a.parent_key = q.post_key
  UNION ALL SELECT sha256('Tag:' || tag_name), sha256('Post:' || post_key), 'Tags'
            FROM post_tags JOIN tags ON tag = tag_name
  UNION ALL SELECT sha256('User:' || user_key), sha256('Badge:' || badge_key), 'Earns'
            FROM badges JOIN users ON badge_user = user_key
  UNION ALL SELECT sha256('Post:' || s.post_key), sha256('Post:' || d.post_key), 'Links'
            FROM links JOIN posts s ON link_post = s.post_key JOIN posts d ON link_related = d.post_key)
"""
)


def forum_users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )


@shared
def forum_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Written, as vertices and five kinds of edges read it."""
    orders = table(spark, sf, "orders")
    firsts = orders.groupBy(F.col("o_custkey").alias("first_owner")).agg(
        F.min(F.struct("o_orderdate", "o_orderkey")).getField("o_orderkey").alias("first_key")
    )
    posts = orders.join(firsts, F.col("o_custkey") == F.col("first_owner")).select(
        F.col("o_orderkey").alias("post_key"),
        F.col("o_custkey").alias("owner_key"),
        F.when(F.col("first_key") != F.col("o_orderkey"), F.col("first_key")).alias("parent_key"),
        F.col("o_totalprice").alias("score"),
        F.concat(F.lit("|"), "o_orderpriority", F.lit("|"), "o_orderstatus", F.lit("|")).alias("raw_tags"),
    )
    return cut(posts).withColumn("tags", split_pipe_tags("raw_tags"))


def forum_votes(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return (
        lines.select(
            F.concat_ws("-", *[F.col(c).cast("string") for c in (
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")]).alias("vote_key"),
            F.col("l_orderkey").alias("vote_post"),
            (F.col("l_linenumber") + F.when(F.col("l_returnflag") == "R", 6).otherwise(1)).alias("vote_code"),
        )
        .distinct()
        .withColumn("vote_type", vote_type("vote_code"))
    )


def forum_tags(spark: SparkSession, sf: str) -> DataFrame:
    return etl.explode_tags(forum_posts(spark, sf)).select(F.col("tag").alias("tag_name")).distinct()


def forum_badges(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("badge_key"), F.col("user_id").alias("badge_user"), F.col("event_type").alias("badge_name")
    )


@shared
def forum_links(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("link_post"))
    return next_value(orders, "o_custkey", ["o_orderdate"], "link_post", "link_related").select(
        "link_post", "link_related"
    )


def forum_comments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("comment_key"),
        F.col("conv_id").alias("comment_post"),
        "role",
    )


def _keyed_vertices(spark: SparkSession, sf: str) -> DataFrame:
    return etl.union_vertices(*[t.drop("id") for t in (
        etl.typed(forum_posts(spark, sf).drop("raw_tags"), "Post", "post_key"),
        etl.typed(forum_users(spark, sf), "User", "user_key"),
        etl.typed(forum_votes(spark, sf), "Vote", "vote_key"),
        etl.typed(forum_tags(spark, sf), "Tag", "tag_name"),
        etl.typed(forum_badges(spark, sf), "Badge", "badge_key"),
        etl.typed(forum_links(spark, sf).filter("link_related IS NOT NULL"), "PostLinks", "link_post"),
        etl.typed(forum_comments(spark, sf), "Comment", "comment_key"),
    )], disjoint=True)


def _hashed_vertices(keyed: DataFrame) -> DataFrame:
    return keyed.withColumn("id", stable_id(F.col("type"), "source_id")).select(*sorted(["id", *keyed.columns]))


def _keyed_edges(spark: SparkSession, sf: str, votes: DataFrame | None = None) -> DataFrame:
    posts, users, end = forum_posts(spark, sf), forum_users(spark, sf), etl.entity_key
    return etl.union_edges(
        etl.cast_for_edges(forum_votes(spark, sf) if votes is None else votes, posts, end),
        etl.asks_edges(posts, users, end),
        etl.user_answers_edges(posts, users, end),
        etl.post_answers_edges(posts, end),
        etl.tag_edges(posts, forum_tags(spark, sf), end),
        etl.earns_edges(forum_badges(spark, sf), users, end),
        etl.link_edges(forum_links(spark, sf), posts, end),
    )


def forum_vertices(spark: SparkSession, sf: str) -> DataFrame:
    """Wide union: every entity's own columns, NULL where an entity has none."""
    return _hashed_vertices(_keyed_vertices(spark, sf))


def forum_edges(spark: SparkSession, sf: str) -> DataFrame:
    return etl.hash_ends(_keyed_edges(spark, sf))


class _Forum(Graph):
    """Each table is written when it is first read, by type and source key.

    A hashed id is 64 letters that no codec brings below 32 bytes; it is computed from the
    key as the table is read, so the written graph follows the size of the source tables.
    """

    def __init__(self, spark: SparkSession, sf: str):
        object.__setattr__(self, "_of", (spark, sf))

    def short_ids(self) -> tuple[DataFrame, DataFrame, Callable[[Column], Column]]:
        """Type and source key in one text, which the id is the hash of."""
        short = {f"_{end}": entity_text(F.col(f"{end}.type"), F.col(f"{end}.key")) for end in ("src", "dst")}
        short |= {f"_{end}_kind": F.col(f"{end}.type") for end in ("src", "dst")}
        vertices = self.vertices.withColumn("_id", entity_text(F.col("type"), "source_id")).withColumn("_kind", F.col("type"))
        return vertices, etl.hash_ends(self._keyed_edges.withColumns(short)), hashed

    def __getattr__(self, name: str) -> DataFrame:
        if name == "vertices":
            made = _hashed_vertices(self._written_vertices)
        elif name == "_written_vertices":
            made = cut(_keyed_vertices(*self._of))
        elif name == "_keyed_edges":
            # the votes of the written vertices are without repeats already
            held = self.__dict__.get("_written_vertices")
            votes = None if held is None else held.filter("type = 'Vote'").select(F.col("source_id").alias("vote_key"), "vote_post", "vote_code", "vote_type")
            made = cut(_keyed_edges(*self._of, votes))
        elif name == "edges":
            made = etl.hash_ends(self._keyed_edges)
        else:
            raise AttributeError(name)
        object.__setattr__(self, name, made)
        return made


@shared
def forum(spark: SparkSession, sf: str) -> Graph:
    """The typed graph, written: what a saved and reloaded graph would be."""
    return _Forum(spark, sf)
