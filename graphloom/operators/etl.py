"""From entity tables to a typed property graph."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.hashing import stable_id


def strip_attr_prefix(df: DataFrame, prefix: str = "_") -> DataFrame:
    """Remove the attribute mark that the XML reader puts before column names."""
    return df.toDF(*[c[len(prefix):] if c.startswith(prefix) else c for c in df.columns])


def align_schema(*tables: DataFrame) -> list[DataFrame]:
    """Give every table the same sorted columns, absent ones as typed NULLs.

    Two tables that disagree on a column's type are an error, not a silent cast.
    """
    types: dict[str, T.DataType] = {}
    for table in tables:
        for field in table.schema.fields:
            known = types.setdefault(field.name, field.dataType)
            if known != field.dataType:
                raise TypeError(f"column {field.name} is both {known} and {field.dataType}")
    return [
        table.select(
            *[
                F.col(c) if c in table.columns else F.lit(None).cast(types[c]).alias(c)
                for c in sorted(types)
            ]
        )
        for table in tables
    ]


def typed(df: DataFrame, type_name: str, key: str) -> DataFrame:
    """Stamp the type, name the source key ``source_id`` and add the graph id."""
    return (
        df.withColumnRenamed(key, "source_id")
        .withColumn("source_id", F.col("source_id").cast("string"))
        .withColumn("type", F.lit(type_name))
        .withColumn("id", stable_id(type_name, "source_id"))
    )


def union_vertices(*tables: DataFrame, disjoint: bool = False) -> DataFrame:
    """All vertices once: align columns, union, drop exact duplicates.

    ``disjoint`` tables can share no row, as those of different types: each drops its own
    duplicates before it is widened, so that no column of another table is shuffled with it.
    """
    if disjoint:
        return reduce(DataFrame.unionByName, align_schema(*[t.distinct() for t in tables]))
    return reduce(DataFrame.unionByName, align_schema(*tables)).distinct()


def union_edges(*tables: DataFrame) -> DataFrame:
    """All edges, parallel ones kept."""
    return reduce(DataFrame.unionByName, tables)


Ends = Callable[[str, str], Column]


def entity_key(type_name: str, key: str) -> Column:
    """An edge's end as (type, source key): what its id is the hash of, in a fraction of the bytes."""
    return F.struct(F.lit(type_name).alias("type"), F.col(key).cast("string").alias("key"))


def hash_ends(edges: DataFrame) -> DataFrame:
    """Edges whose ends are entity keys, by their ids."""
    return edges.withColumns({end: stable_id(F.col(f"{end}.type"), F.col(f"{end}.key")) for end in ("src", "dst")})


def _edges(df: DataFrame, src, dst, relationship: str) -> DataFrame:
    return df.select(src.alias("src"), dst.alias("dst"), F.lit(relationship).alias("relationship"))


def _keyed(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(F.col(key).alias(name))


def cast_for_edges(votes: DataFrame, posts: DataFrame, end: Ends = stable_id) -> DataFrame:
    """Vote -CastFor-> Post; votes on unknown posts give no edge."""
    hit = votes.join(_keyed(posts, "post_key", "_p"), F.col("vote_post") == F.col("_p"))
    return _edges(hit, end("Vote", "vote_key"), end("Post", "_p"), "CastFor")


def authored_edges(posts: DataFrame, users: DataFrame, relationship: str, end: Ends = stable_id) -> DataFrame:
    """User -> Post for the given posts; the user is resolved by a join so no edge dangles."""
    hit = posts.join(_keyed(users, "user_key", "_u"), F.col("owner_key") == F.col("_u"))
    return _edges(hit, end("User", "_u"), end("Post", "post_key"), relationship)


def questions(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("parent_key").isNull())


def answers(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("parent_key").isNotNull())


def asks_edges(posts: DataFrame, users: DataFrame, end: Ends = stable_id) -> DataFrame:
    return authored_edges(questions(posts), users, "Asks", end)


def user_answers_edges(posts: DataFrame, users: DataFrame, end: Ends = stable_id) -> DataFrame:
    return authored_edges(answers(posts), users, "Answers", end)


def post_answers_edges(posts: DataFrame, end: Ends = stable_id) -> DataFrame:
    """Answer post -Answers-> question post, a self-join on the parent key."""
    hit = answers(posts).join(_keyed(posts, "post_key", "_q"), F.col("parent_key") == F.col("_q"))
    return _edges(hit, end("Post", "post_key"), end("Post", "_q"), "Answers")


def explode_tags(posts: DataFrame) -> DataFrame:
    """One row per post and tag; posts without tags give none."""
    return posts.select("post_key", F.explode("tags").alias("tag"))


def tag_edges(posts: DataFrame, tags: DataFrame, end: Ends = stable_id) -> DataFrame:
    """Tag -Tags-> Post."""
    hit = explode_tags(posts).join(_keyed(tags, "tag_name", "_t"), F.col("tag") == F.col("_t"))
    return _edges(hit, end("Tag", "_t"), end("Post", "post_key"), "Tags")


def earns_edges(badges: DataFrame, users: DataFrame, end: Ends = stable_id) -> DataFrame:
    """User -Earns-> Badge; badges of unknown users give no edge."""
    hit = badges.join(_keyed(users, "user_key", "_u"), F.col("badge_user") == F.col("_u"))
    return _edges(hit, end("User", "_u"), end("Badge", "badge_key"), "Earns")


def link_edges(links: DataFrame, posts: DataFrame, end: Ends = stable_id) -> DataFrame:
    """Post -Links-> Post; both ends must exist."""
    hit = links.join(_keyed(posts, "post_key", "_s"), F.col("link_post") == F.col("_s")).join(
        _keyed(posts, "post_key", "_d"), F.col("link_related") == F.col("_d")
    )
    return _edges(hit, end("Post", "_s"), end("Post", "_d"), "Links")


def link_coverage(edges: DataFrame, source_rows: DataFrame) -> DataFrame:
    """Share of source rows that became an edge, per relationship, in percent.

    ``source_rows`` has one ``relationship`` row per source row.
    """
    linked = edges.groupBy("relationship").agg(F.count("*").alias("linked"))
    total = source_rows.groupBy("relationship").agg(F.count("*").alias("source_rows"))
    return total.join(linked, "relationship", "left").select(
        "relationship",
        "source_rows",
        F.coalesce("linked", F.lit(0)).alias("linked"),
        (F.coalesce("linked", F.lit(0)) * 100.0 / F.col("source_rows")).alias("percent"),
    )


def table_counts(vertices: DataFrame) -> DataFrame:
    """Rows per entity type and the total, in one aggregate."""
    return vertices.rollup("type").agg(F.count("*").alias("n")).select(
        F.coalesce("type", F.lit("(all)")).alias("type"), "n"
    )


def type_counts(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("type").agg(F.count("*").alias("n"))


def relationship_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("relationship").agg(F.count("*").alias("n"))


def label_set_counts(vertices: DataFrame, labels: str = "labels") -> DataFrame:
    """Distinct label sets, order within the set ignored, most frequent first."""
    return (
        vertices.groupBy(F.array_join(F.array_sort(labels), "|").alias("label_set"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "label_set")
    )


def attach_by_id(vertices: DataFrame, facts: DataFrame, key: str = "id") -> DataFrame:
    """Left join of facts to vertices; unmatched vertices keep NULLs."""
    return vertices.join(facts, key, "left")


def match_report(vertices: DataFrame, facts: DataFrame, key: str = "id") -> DataFrame:
    """How many fact rows find a vertex and how many do not, in one pass."""
    known = vertices.select(key).distinct().withColumn("_known", F.lit(1))
    return facts.join(known, key, "left").agg(
        F.count("_known").alias("hits"), F.count_if(F.col("_known").isNull()).alias("misses")
    )


def fill_blank(df: DataFrame) -> DataFrame:
    """NULL text to '' for consumers that know no NULL."""
    return df.fillna("", subset=[f.name for f in df.schema.fields if f.dataType == T.StringType()])


def clean_text_properties(df: DataFrame, columns: list[str]) -> DataFrame:
    """In text properties NULL, 'null' and '' become '0'; typed columns are left alone."""
    from graphloom.functions.text import missing_to_zero

    text = {f.name for f in df.schema.fields if f.dataType == T.StringType()}
    return df.withColumns({c: missing_to_zero(c) for c in columns if c in text})


def clean_property_map(df: DataFrame, key: str, props: str) -> DataFrame:
    """The same for an untyped map<string,string>: per property the commonest kind of
    value decides; only where that kind is text are missing values replaced.

    Kinds are counted per property before anything is compared, so the work per
    property is a handful of rows however often it occurs.
    """
    rows = df.select(key, F.explode(props).alias("property", "value"))
    kind = (
        F.when(F.col("value").isNull(), "null")
        .when(F.col("value").rlike(r"^-?\d+$"), "int")
        .when(F.col("value").rlike(r"^-?\d+\.\d*$"), "float")
        .otherwise("text")
    )
    counts = rows.groupBy("property", kind.alias("kind")).agg(F.count("*").alias("n"))
    main = counts.groupBy("property").agg(
        F.max(F.struct("n", F.col("kind"))).getField("kind").alias("main_kind")
    )
    missing = F.col("value").isNull() | F.col("value").isin("null", "")
    return rows.join(main, "property").select(
        key,
        "property",
        "main_kind",
        F.when((F.col("main_kind") == "text") & missing, F.lit("0")).otherwise(F.col("value")).alias("value"),
    )
