"""Scans, sinks, projections, joins, unions and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.functions import text
from graphloom.functions.hashing import stable_id
from graphloom.functions.ordering import dense_index
from graphloom.functions.vectors import json_to_vector, or_zeros
from graphloom.graph import Graph, edge_ends, simple_digraph
from graphloom.operators import etl, tabular
from graphloom.plans import fixtures as fx
from graphloom.plans.fixtures import COPURCHASE, FORUM, FORUM_TABLES, table
from graphloom.plans.registry import query
from graphloom.session import shared_path
from graphloom.sources import tables as src

# --- A: scans and sinks ---------------------------------------------------------------------

_ORDERS_SQL = "SELECT o_orderkey AS \"Id\", o_custkey AS \"OwnerUserId\", o_orderpriority AS \"Title\" FROM orders"


def _orders_xml(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Id"), F.col("o_custkey").alias("OwnerUserId"), F.col("o_orderpriority").alias("Title"))
    path = shared_path(spark, "posts-xml")
    src.sink_xml_rows(rows, path, "posts")
    return path


@query("A01_scan_xml_rows", _ORDERS_SQL)
def scan_xml_rows(spark, sf):
    return src.scan_xml_rows(spark, _orders_xml(spark, sf), "_Id bigint, _OwnerUserId bigint, _Title string")


@query("A02_strip_attr_prefix", 'SELECT count(*) AS n, max("Id") AS max_id FROM (' + _ORDERS_SQL + ")")
def strip_attr_prefix(spark, sf):
    raw = (spark.read.format("xml").option("rowTag", "row")
           .schema("_Id bigint, _OwnerUserId bigint, _Title string").load(_orders_xml(spark, sf)))
    return etl.strip_attr_prefix(raw).agg(F.count("Id").alias("n"), F.max("Id").alias("max_id"))


@query("A03_sink_parquet_single", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def sink_parquet(spark, sf):
    path = shared_path(spark, "users")
    src.sink_parquet(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return spark.read.parquet(path)


@query("A04_scan_parquet_typed", "SELECT 'Part' AS type, p_brand, count(*) AS n FROM part GROUP BY ALL")
def scan_parquet_typed(spark, sf):
    return src.scan_parquet_typed(spark, f"{sf}/part.parquet", "Part").groupBy("type", "p_brand").agg(F.count("*").alias("n"))


def _saved_forum(spark, sf):
    path = shared_path(spark, "forum")
    # each table is read once, so it is saved as it is made and not written before
    Graph(fx.forum_vertices(spark, sf).select("id", "type", "source_id", "vote_type"), fx.forum_edges(spark, sf)).save(path)
    return Graph.load(spark, path)


@query("A05_sink_reload_graph", f"WITH {FORUM} SELECT id, type, source_id FROM vertices")
def sink_reload_graph(spark, sf):
    return _saved_forum(spark, sf).vertices.select("id", "type", "source_id")


@query("A13_graph_save_load", f"WITH {FORUM} SELECT src, dst, relationship FROM edges")
def graph_save_load(spark, sf):
    return _saved_forum(spark, sf).edges.select("src", "dst", "relationship")


def _edge_text(spark, sf):
    """The co-purchase edges as padded text with a comment on top, in one order."""
    edges = fx.copurchase(spark, sf).edges
    lines = edges.select(
        F.concat_ws("\t", F.lpad(F.col("src").cast("string"), 7, "0"), F.lpad(F.col("dst").cast("string"), 7, "0")).alias("value"))
    head = spark.range(1).select(F.lit("# from\tto").alias("value"))
    path = shared_path(spark, "edge-text")
    # '#' sorts before every digit, so the comment is the first line of the first file
    head.union(lines).repartitionByRange("value").sortWithinPartitions("value").write.option("compression", "gzip").text(path)
    return path


_EDGE_LINES = f"""WITH {COPURCHASE},
numbered AS (SELECT src, dst, row_number() OVER (ORDER BY lpad(src::VARCHAR, 7, '0'), lpad(dst::VARCHAR, 7, '0')) AS edge_id FROM edges)"""


@query("A06_scan_edge_list", f"{_EDGE_LINES} SELECT edge_id, src, dst FROM numbered")
def scan_edge_list(spark, sf):
    return src.scan_edge_list(spark, _edge_text(spark, sf))


def dense_ids(edges, order="edge_id"):
    """Number vertices by first appearance: earliest line, citing end before cited end."""
    seen = edges.select(order, F.posexplode(F.array("src", "dst")).alias("pos", "file_id"))
    first = seen.groupBy("file_id").agg(F.min(F.struct(order, "pos")).alias("seen")).select("file_id", "seen.*")
    return dense_index(first, [order, "pos"], "sequential_id").select("file_id", "sequential_id")


_DENSE = f"""{_EDGE_LINES},
ends AS (SELECT src AS file_id, edge_id, 0 AS pos FROM numbered UNION ALL SELECT dst, edge_id, 1 FROM numbered),
firsts AS (SELECT file_id, min(edge_id * 2 + pos) AS seen FROM ends GROUP BY file_id),
ids AS (SELECT file_id, row_number() OVER (ORDER BY seen) - 1 AS sequential_id FROM firsts)"""


@query("E02_dense_ids", f"{_DENSE} SELECT file_id, sequential_id FROM ids")
def dense_ids_query(spark, sf):
    return dense_ids(src.scan_edge_list(spark, _edge_text(spark, sf)))


@query("A09_sink_id_map", f"{_DENSE} SELECT file_id, sequential_id FROM ids")
def sink_id_map(spark, sf):
    path = shared_path(spark, "id-map")
    src.sink_parquet(dense_ids(src.scan_edge_list(spark, _edge_text(spark, sf))), path)
    return spark.read.parquet(path)


@query("B28_relabel_ids", f"""{_DENSE}
SELECT s.sequential_id AS src, d.sequential_id AS dst FROM edges JOIN ids s ON s.file_id = src JOIN ids d ON d.file_id = dst""")
def relabel_ids(spark, sf):
    edges = src.scan_edge_list(spark, _edge_text(spark, sf))
    ids = dense_ids(edges)
    return Graph.from_edges(edges.select("src", "dst")).relabel(ids, "file_id", "sequential_id").edges.select("src", "dst")


# paper records: an order told as a paper, with fields missing by status and priority
RECORDS = """
records AS (
  SELECT o_orderkey AS file_id,
    repeat('-', 78) || chr(10) || '\\\\' || chr(10) ||
    'Paper: hep-th/' || (CASE WHEN o_orderstatus = 'P' THEN o_orderkey + 1 ELSE o_orderkey END) || chr(10) ||
    'From: ' || c_name || ' <' || lower(c_mktsegment) || '@example.org>' || chr(10) ||
    CASE WHEN o_orderpriority <> '5-LOW' THEN 'Date: ' || strftime(o_orderdate, '%Y-%m-%d') || ' 10:00:00 GMT   (20kb)' || chr(10) ELSE '' END ||
    'Title: Order of ' || c_mktsegment || chr(10) ||
    CASE WHEN o_orderstatus <> 'F' THEN 'Authors: ' || c_name || chr(10) ELSE 'Author: ' || c_name || chr(10) END ||
    CASE WHEN o_orderpriority <> '1-URGENT' THEN 'Comments: ' || o_orderpriority || ', revised' || chr(10) || '  once' || chr(10) ELSE '' END ||
    CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Report-no: R-' || o_custkey || chr(10) ELSE '' END ||
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'Journal-ref: Nucl.Phys. B' || o_custkey || ' (1997)' || chr(10) ELSE '' END ||
    '\\\\' || chr(10) || '  An order of ' || c_name || chr(10) || 'in  state ' || o_orderstatus || ' is described. ' || chr(10) || '\\\\' || chr(10) AS record
  FROM orders JOIN customer ON o_custkey = c_custkey)
""".replace("\\\\", "\\\\")


@fx.shared
def paper_records(spark, sf):
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    nl = F.lit("\n")

    def line(label, value, keep=None, otherwise=None):
        full = F.concat(F.lit(label), value, nl)
        if keep is None:
            return full
        return F.when(keep, full).otherwise(F.lit("") if otherwise is None else otherwise)

    bars = F.lit("\\\\")
    return orders.select(
        F.col("o_orderkey").alias("file_id"),
        F.concat(
            F.lit("-" * 78), nl, bars, nl,
            line("Paper: hep-th/", (F.col("o_orderkey") + F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).cast("string")),
            line("From: ", F.concat("c_name", F.lit(" <"), F.lower("c_mktsegment"), F.lit("@example.org>"))),
            line("Date: ", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 10:00:00 GMT   (20kb)")),
                 F.col("o_orderpriority") != "5-LOW"),
            line("Title: Order of ", F.col("c_mktsegment")),
            line("Authors: ", F.col("c_name"), F.col("o_orderstatus") != "F", F.concat(F.lit("Author: "), "c_name", nl)),
            line("Comments: ", F.concat("o_orderpriority", F.lit(", revised\n  once")), F.col("o_orderpriority") != "1-URGENT"),
            line("Report-no: R-", F.col("o_custkey").cast("string"), F.col("c_mktsegment") != "BUILDING"),
            line("Journal-ref: Nucl.Phys. B", F.concat(F.col("o_custkey").cast("string"), F.lit(" (1997)")),
                 F.col("c_mktsegment") != "MACHINERY"),
            bars, nl, F.lit("  An order of "), F.col("c_name"), nl, F.lit("in  state "), F.col("o_orderstatus"),
            F.lit(" is described. "), nl, bars, nl,
        ).alias("record"),
    )


def _field_sql(pattern: str, options: str = "", trim: bool = False) -> str:
    got = f"regexp_extract(record, '{pattern}', 1{options})"
    if trim:
        got = f"trim({got})"
    test = f"regexp_matches(record, '{pattern}'{options})"
    return f"CASE WHEN {test} THEN {got} END"


_PAPER_SQL = r"CASE WHEN regexp_matches(record, 'Paper:\s*(.*)') THEN regexp_extract(record, 'Paper:\s*(.*)', 1) END"
_ABSTRACT = r"Journal-ref:[^\\]*\\\\[\n\s]*(.*?)\\\\"
FIELDS_SQL = f"""WITH {RECORDS}
SELECT file_id, {_PAPER_SQL} AS paper,
  {_field_sql(r'From:\s*([^<]*)<', trim=True)} AS "from",
  {_field_sql(r'Date:\s*(.*)(\s*)(\(\d+kb\))', trim=True)} AS date,
  {_field_sql(r'Title:\s*(.*)')} AS title,
  {_field_sql(r'Authors:\s*(.*)')} AS authors,
  {_field_sql(r'Comments:\s*(.*)')} AS comments,
  {_field_sql(r'Report-no:\s*(.*)')} AS report_no,
  {_field_sql(r'Journal-ref:\s*(.*)')} AS journal_ref,
  trim(replace(replace({_field_sql(_ABSTRACT, ", 's'")}, chr(10), ' '), '  ', ' ')) AS abstract
FROM records"""


def _fields(spark, sf):
    return paper_records(spark, sf).select("file_id", *[text.record_field("record", f).alias(f) for f in text.RECORD_PATTERNS])


@query("B09_extract_record_fields", FIELDS_SQL)
def extract_record_fields(spark, sf):
    return _fields(spark, sf)


@query("B10_paper_id_from_path", f"WITH {RECORDS} SELECT file_id, split_part({_PAPER_SQL}, '/', 2)::BIGINT AS paper_id FROM records")
def paper_id_from_path(spark, sf):
    return _fields(spark, sf).select("file_id", text.paper_id("paper").alias("paper_id"))


@query("B11_id_mismatch_check", f"""WITH {RECORDS}
SELECT count(*) AS n, count(*) FILTER (split_part({_PAPER_SQL}, '/', 2)::BIGINT <> file_id) AS mismatches FROM records""")
def id_mismatch_check(spark, sf):
    ids = _fields(spark, sf).withColumn("paper_id", text.paper_id("paper"))
    return ids.agg(F.count("*").alias("n"), F.count_if(F.col("paper_id") != F.col("file_id")).alias("mismatches"))


@query("A07_scan_record_files", "SELECT page_id AS file_id, html || chr(10) AS record FROM pages")
def scan_record_files(spark, sf):
    """One file per page, read back whole with its id from the path."""
    records = table(spark, sf, "pages").select(F.col("page_id").alias("page"), F.col("html").alias("value"))
    path = shared_path(spark, "records")
    records.repartition("page").write.partitionBy("page").text(path)
    return src.scan_record_files(spark, path, r"page=(\d+)/")


@query("A07_scan_record_tars", "SELECT page_id AS file_id, html AS record FROM pages")
def scan_record_tars(spark, sf):
    """Pages packed into tar shards and streamed out of them again."""
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("file_id"), F.col("html").alias("record"))
    return src.untar_records(src.tar_records(pages))


_DATES = "dates AS (SELECT l_partkey AS paper_id, min(l_shipdate)::DATE AS day FROM lineitem GROUP BY ALL)"


def _dates(spark, sf):
    days = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.min("l_shipdate").cast("date").alias("day"))
    lines = days.select(F.concat_ws("\t", F.lpad(F.col("l_partkey").cast("string"), 7, "0"), F.col("day").cast("string")).alias("value"))
    path = shared_path(spark, "dates")
    lines.write.option("compression", "gzip").text(path)
    return src.scan_dates(spark, path)


@query("A08_scan_dates", f"WITH {_DATES} SELECT paper_id, epoch(day)::BIGINT AS published FROM dates")
def scan_dates(spark, sf):
    return _dates(spark, sf)


@query("C10_dates_left_join", f"""WITH {_DATES}, known AS (SELECT p_partkey AS id FROM part WHERE p_size <= 25)
SELECT id, epoch(day)::BIGINT AS published FROM known LEFT JOIN dates ON paper_id = id""")
def dates_left_join(spark, sf):
    known = fx.parts(spark, sf).filter("size <= 25").select("id")
    return etl.attach_by_id(known, _dates(spark, sf).withColumnRenamed("paper_id", "id"))


@query("C09_metadata_left_join", f"""WITH {_DATES}, known AS (SELECT p_partkey AS id FROM part WHERE p_size <= 25)
SELECT count(id) AS hits, count(*) - count(id) AS misses FROM dates LEFT JOIN known ON paper_id = id""")
def metadata_left_join(spark, sf):
    known = fx.parts(spark, sf).filter("size <= 25").select("id")
    return etl.match_report(known, _dates(spark, sf).withColumnRenamed("paper_id", "id"))


_VEC_SQL = "SELECT vec_id AS id, round(list_sum(embedding::DOUBLE[]), 5) AS total, len(embedding) AS width FROM embeddings"


def _vec_summary(df):
    return df.select("id", F.round(F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda a, x: a + x), 5).alias("total"),
                     F.size("v").cast("bigint").alias("width"))


@query("A10_sink_embeddings_json", _VEC_SQL)
def sink_embeddings_json(spark, sf):
    path = shared_path(spark, "vectors-json")
    src.sink_embeddings_json(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), path)
    return _vec_summary(spark.read.schema("id bigint, v array<double>").json(path))


@query("A11_cached_embedding", _VEC_SQL)
def cached_embedding(spark, sf):
    path = shared_path(spark, "vectors")

    def compute():
        return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))

    src.cached_table(spark, path, compute)
    return _vec_summary(src.cached_table(spark, path, compute))


@query("A12_node_table_sink", """SELECT p_partkey AS id, CASE WHEN p_size < 10 THEN '' ELSE p_name END AS title, p_brand AS brand FROM part""")
def node_table_sink(spark, sf):
    nodes = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") >= 10, F.col("p_name")).alias("title"), F.col("p_brand").alias("brand"), "p_type")
    path = shared_path(spark, "nodes")
    src.node_table_sink(nodes, ["id", "title", "brand"], path)
    return spark.read.parquet(path)


@query("A14_node_attrs_to_table", f"""WITH {FORUM} SELECT id AS node, type, coalesce(vote_type, '') AS vote_type FROM vertices""")
def node_attrs_to_table(spark, sf):
    return etl.fill_blank(fx.forum(spark, sf).vertices.select(F.col("id").alias("node"), "type", "vote_type"))


# --- B: projections and scalar functions -----------------------------------------------------


@query("B01_vote_type_case", f"""WITH {FORUM_TABLES}
SELECT vote_code, coalesce(label, 'Unknown') AS vote_type, count(*) AS n FROM votes LEFT JOIN vote_names ON code = vote_code GROUP BY ALL""")
def vote_type_case(spark, sf):
    return fx.forum_votes(spark, sf).groupBy("vote_code", "vote_type").agg(F.count("*").alias("n"))


_PIPES = """SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL WHEN p_size < 10 THEN '' ELSE '|' || replace(p_name, ' ', '|') || '|' END AS pipes FROM part"""


@query("B02_split_pipe_tags", f"""SELECT p_partkey, len(string_split(trim(pipes, '|'), '|')) AS n_tags,
  array_to_string(string_split(trim(pipes, '|'), '|'), ',') AS tags FROM ({_PIPES})""")
def split_pipe_tags(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") < 5, None).when(F.col("p_size") < 10, "").otherwise(
        F.concat(F.lit("|"), F.replace("p_name", F.lit(" "), F.lit("|")), F.lit("|"))).alias("pipes"))
    tags = text.split_pipe_tags("pipes")
    return part.select("p_partkey", F.size(tags).cast("bigint").alias("_n"), F.array_join(tags, ",").alias("tags")).select(
        "p_partkey", F.when(F.col("tags").isNotNull(), F.col("_n")).alias("n_tags"), "tags")


@query("B03_extract_angle_tags", r"""SELECT p_partkey, coalesce(array_to_string(regexp_extract_all(t, '<([^>]+)>', 1), ','), '') AS tags
FROM (SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL WHEN p_size < 10 THEN '' ELSE '<' || replace(p_name, ' ', '><') || '>' END AS t FROM part)""")
def extract_angle_tags(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") < 5, None).when(F.col("p_size") < 10, "").otherwise(
        F.concat(F.lit("<"), F.replace("p_name", F.lit(" "), F.lit("><")), F.lit(">"))).alias("t"))
    return part.select("p_partkey", F.array_join(text.angle_tags("t"), ",").alias("tags"))


@query("B04_align_schema", f"""WITH {FORUM_TABLES}
SELECT 'Post' AS type, post_key::VARCHAR AS source_id, score, NULL AS name, NULL AS segment FROM posts
UNION ALL SELECT 'User', user_key::VARCHAR, NULL, name, segment FROM users""")
def align_schema(spark, sf):
    posts = etl.typed(fx.forum_posts(spark, sf).select("post_key", "score"), "Post", "post_key")
    users = etl.typed(fx.forum_users(spark, sf), "User", "user_key")
    left, right = etl.align_schema(posts, users)
    return left.unionByName(right).select("type", "source_id", "score", "name", "segment")


@query("B05_assign_uuid", "SELECT o_orderkey, sha256('Post:' || o_orderkey) AS id FROM orders")
def assign_id(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", stable_id("Post", "o_orderkey").alias("id"))


@query("B06_filter_by_type", f"WITH {FORUM} SELECT id, source_id FROM vertices WHERE type = 'Post'")
def filter_by_type(spark, sf):
    return fx.forum(spark, sf).vertices.filter("type = 'Post'").select("id", "source_id")


@query("B07_questions_answers", f"""WITH {FORUM_TABLES}
SELECT post_key, CASE WHEN parent_key IS NULL THEN 'question' ELSE 'answer' END AS kind FROM posts""")
def questions_answers(spark, sf):
    posts = fx.forum_posts(spark, sf)
    return etl.questions(posts).select("post_key", F.lit("question").alias("kind")).unionByName(
        etl.answers(posts).select("post_key", F.lit("answer").alias("kind")))


@query("B08_explode_tags", f"WITH {FORUM_TABLES} SELECT post_key, tag FROM post_tags")
def explode_tags(spark, sf):
    return etl.explode_tags(fx.forum_posts(spark, sf))


@query("B12_letters_only", r"""SELECT doc_id, left(k, greatest(length(k) - 1, 0)) AS letters
FROM (SELECT doc_id, trim(regexp_replace(text, '[^a-zA-Z.]', '', 'g')) AS k FROM documents)""")
def letters_only(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.letters_only("text").alias("letters"))


@query("B13_impute_zero", """SELECT count(*) AS n, sum(x) AS total, count(*) FILTER (x = 0) AS zeros
FROM (SELECT coalesce(nullif(v, '')::BIGINT, 0) AS x FROM (SELECT CASE WHEN p_size < 10 THEN '' WHEN p_size >= 20 THEN p_size::VARCHAR END AS v FROM part))""")
def impute_zero(spark, sf):
    x = table(spark, sf, "part").select(F.when(F.col("p_size") < 10, "").when(F.col("p_size") >= 20, F.col("p_size").cast("string")).alias("v")).select(
        text.zero_if_blank("v").alias("x"))
    return x.agg(F.count("*").alias("n"), F.sum("x").alias("total"), F.count_if(F.col("x") == 0).alias("zeros"))


_DIRTY_SQL = """SELECT p_partkey, p_size, p_brand, CASE WHEN p_size < 5 THEN '' WHEN p_size < 10 THEN 'null' WHEN p_size < 15 THEN NULL
  WHEN p_size < 20 THEN '   ' ELSE p_name END AS journal FROM part"""


def _dirty(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_size", "p_brand", F.when(F.col("p_size") < 5, "").when(F.col("p_size") < 10, "null").when(
        F.col("p_size") < 15, None).when(F.col("p_size") < 20, "   ").otherwise(F.col("p_name")).alias("journal"))


@query("B14_drop_blank_rows", f"SELECT p_partkey, journal FROM ({_DIRTY_SQL}) WHERE trim(coalesce(journal, '')) <> '' AND trim(p_brand) <> ''")
def drop_blank_rows(spark, sf):
    return _dirty(spark, sf).filter(~text.is_blank("journal") & ~text.is_blank("p_brand")).select("p_partkey", "journal")


@query("B15_clean_properties", f"""SELECT p_partkey, p_size, CASE WHEN journal IS NULL OR journal IN ('null', '') THEN '0' ELSE journal END AS journal FROM ({_DIRTY_SQL})""")
def clean_properties(spark, sf):
    return etl.clean_text_properties(_dirty(spark, sf), ["journal", "p_size"]).select("p_partkey", "p_size", "journal")


@query("B15_clean_property_map", f"""WITH d AS ({_DIRTY_SQL}),
props AS (SELECT p_partkey AS id, 'journal' AS property, journal AS value FROM d UNION ALL
          SELECT p_partkey, 'size', CASE WHEN p_size < 3 THEN '' ELSE p_size::VARCHAR END FROM d),
kinds AS (SELECT property, CASE WHEN value IS NULL THEN 'null' WHEN regexp_matches(value, '^-?\\d+$') THEN 'int'
            WHEN regexp_matches(value, '^-?\\d+\\.\\d*$') THEN 'float' ELSE 'text' END AS kind, count(*) AS n FROM props GROUP BY ALL),
main AS (SELECT property, arg_max(kind, n) AS main_kind FROM kinds GROUP BY ALL)
SELECT id, property, main_kind, CASE WHEN main_kind = 'text' AND (value IS NULL OR value IN ('null', '')) THEN '0' ELSE value END AS value
FROM props JOIN main USING (property)""".replace("\\\\", "\\"))
def clean_property_map(spark, sf):
    size = F.when(F.col("p_size") < 3, "").otherwise(F.col("p_size").cast("string"))
    props = _dirty(spark, sf).select(F.col("p_partkey").alias("id"), F.create_map(F.lit("journal"), "journal", F.lit("size"), size).alias("props"))
    return etl.clean_property_map(props, "id", "props")


@query("B18_vector_to_json", "SELECT vec_id AS id, 64 AS width, round(list_sum(embedding::DOUBLE[]), 5) AS total FROM embeddings")
def vector_to_json(spark, sf):
    texts = src.vectors_as_json(table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id"), "id", "embedding")
    return _vec_summary(texts.select("id", json_to_vector("vector_json").alias("v")))


@query("B19_dense_feature_fill", """SELECT p_partkey AS id, round(coalesce(list_sum(embedding::DOUBLE[]), 0), 5) AS total, 64 AS width
FROM part LEFT JOIN embeddings ON vec_id = p_partkey""")
def dense_feature_fill(spark, sf):
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    filled = fx.parts(spark, sf).select("id").join(vectors, "id", "left").select("id", or_zeros("v", 64).alias("v"))
    return _vec_summary(filled)


@query("B23_label_encode", "SELECT p_partkey, p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM part")
def label_encode(spark, sf):
    return tabular.label_encode(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", "code")


@query("B24_standard_scale", """SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 6) AS p_size,
  round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 6) AS p_retailprice FROM part""")
def standard_scale(spark, sf):
    scaled = tabular.standard_scale(table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    return scaled.select("p_partkey", F.round("p_size", 6).alias("p_size"), F.round("p_retailprice", 6).alias("p_retailprice"))


@query("B29_zero_index", "SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS idx FROM part WHERE p_size > 10")
def zero_index(spark, sf):
    return dense_index(table(spark, sf, "part").filter("p_size > 10").select("p_partkey"), ["p_partkey"], "idx")


@query("B30_set_node_property", """SELECT p_partkey AS id, coalesce(total, 0.0) AS quantity
FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS total FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) ON l_partkey = p_partkey""")
def set_node_property(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("id")).agg(F.sum("l_quantity").alias("quantity"))
    return fx.copurchase(spark, sf).with_property(returned, "quantity", 0.0).vertices.select("id", "quantity")


# --- C: joins ---------------------------------------------------------------------------------


def _edge_query(name, sql_filter, build):
    @query(name, f"WITH {FORUM} SELECT src, dst, relationship FROM edges WHERE {sql_filter}")
    def run(spark, sf):
        return build(spark, sf)

    return run


_POST = "(SELECT id FROM vertices WHERE type = 'Post')"
_USER = "(SELECT id FROM vertices WHERE type = 'User')"
_edge_query("C01_edges_cast_for", "relationship = 'CastFor'", lambda s, f: etl.cast_for_edges(fx.forum_votes(s, f), fx.forum_posts(s, f)))
_edge_query("C02_edges_asks", "relationship = 'Asks'", lambda s, f: etl.asks_edges(fx.forum_posts(s, f), fx.forum_users(s, f)))
_edge_query("C03_edges_user_answers", f"relationship = 'Answers' AND src IN {_USER}",
            lambda s, f: etl.user_answers_edges(fx.forum_posts(s, f), fx.forum_users(s, f)))
_edge_query("C04_edges_post_answers", f"relationship = 'Answers' AND src IN {_POST}", lambda s, f: etl.post_answers_edges(fx.forum_posts(s, f)))
_edge_query("C05_edges_tags", "relationship = 'Tags'", lambda s, f: etl.tag_edges(fx.forum_posts(s, f), fx.forum_tags(s, f)))
_edge_query("C06_edges_earns", "relationship = 'Earns'", lambda s, f: etl.earns_edges(fx.forum_badges(s, f), fx.forum_users(s, f)))
_edge_query("C07_edges_links", "relationship = 'Links'", lambda s, f: etl.link_edges(fx.forum_links(s, f), fx.forum_posts(s, f)))


@query("C08_link_coverage", f"""WITH {FORUM},
sources AS (SELECT 'CastFor' AS relationship, count(*) AS source_rows FROM votes
  UNION ALL SELECT 'Tags', count(*) FROM post_tags UNION ALL SELECT 'Earns', count(*) FROM badges UNION ALL SELECT 'Links', count(*) FROM links
  UNION ALL SELECT 'Asks', count(*) FROM posts WHERE parent_key IS NULL
  UNION ALL SELECT 'Answers by user', count(*) FROM posts WHERE parent_key IS NOT NULL
  UNION ALL SELECT 'Answers to post', count(*) FROM posts WHERE parent_key IS NOT NULL),
named AS (SELECT src, CASE WHEN relationship <> 'Answers' THEN relationship WHEN src IN (SELECT id FROM vertices WHERE type = 'User') THEN 'Answers by user'
  ELSE 'Answers to post' END AS relationship FROM edges)
SELECT relationship, source_rows, count(src) AS linked, round(count(src) * 100.0 / source_rows, 6) AS percent
FROM sources LEFT JOIN named USING (relationship) GROUP BY relationship, source_rows""")
def link_coverage(spark, sf):
    sources = etl.union_edges(*[df.select(F.lit(name).alias("relationship")) for name, df in (
        ("CastFor", fx.forum_votes(spark, sf)), ("Tags", etl.explode_tags(fx.forum_posts(spark, sf))),
        ("Earns", fx.forum_badges(spark, sf)), ("Links", fx.forum_links(spark, sf)),
        ("Asks", etl.questions(fx.forum_posts(spark, sf))), ("Answers by user", etl.answers(fx.forum_posts(spark, sf))),
        ("Answers to post", etl.answers(fx.forum_posts(spark, sf))))])
    posts, users = fx.forum_posts(spark, sf), fx.forum_users(spark, sf)
    edges = etl.union_edges(
        fx.forum(spark, sf).edges.filter("relationship <> 'Answers'").select("relationship"),
        etl.user_answers_edges(posts, users).select(F.lit("Answers by user").alias("relationship")),
        etl.post_answers_edges(posts).select(F.lit("Answers to post").alias("relationship")))
    covered = etl.link_coverage(edges, sources)
    return covered.withColumn("percent", F.round("percent", 6))


@query("C11_cluster_label_join", """WITH counts AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL),
labels AS (SELECT p_brand, p_type AS brand_label FROM counts QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) = 1)
SELECT p_partkey, p_brand, brand_label FROM part LEFT JOIN labels USING (p_brand)""")
def cluster_label_join(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    labels = tabular.nominate_label(part, "p_brand", "p_type", "brand_label")
    return part.select("p_partkey", "p_brand").join(labels, "p_brand", "left")


@query("C14_induced_subgraph", f"""WITH {COPURCHASE}, keep AS (SELECT id FROM vertices WHERE size <= 25)
SELECT src, dst FROM edges WHERE src IN (SELECT id FROM keep) AND dst IN (SELECT id FROM keep)""")
def induced_subgraph(spark, sf):
    graph = fx.copurchase(spark, sf)
    return graph.induced(graph.vertices.filter("size <= 25")).edges.select("src", "dst")


# --- D: counts over tables --------------------------------------------------------------------


@query("D01_node_type_counts", f"WITH {FORUM} SELECT type, count(*) AS n FROM vertices GROUP BY ALL")
def node_type_counts(spark, sf):
    return etl.type_counts(fx.forum(spark, sf).vertices)


@query("D02_edge_type_counts", f"WITH {FORUM} SELECT relationship, count(*) AS n FROM edges GROUP BY ALL")
def edge_type_counts(spark, sf):
    return etl.relationship_counts(fx.forum(spark, sf).edges)


@query("D08_top_values_per_group", """SELECT p_brand, p_name, n, rank FROM (
  SELECT p_brand, p_name, count(*) AS n, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_name) AS rank
  FROM part GROUP BY p_brand, p_name) WHERE rank <= 5""")
def top_values_per_group(spark, sf):
    return tabular.top_values(table(spark, sf, "part"), "p_brand", "p_name", 5)


@query("D08_top_values_two_columns", """WITH n AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_name) AS rank FROM (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY p_brand, p_name)),
t AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS rank FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY p_brand, p_type))
SELECT * FROM (SELECT p_brand, string_agg(p_name, '|' ORDER BY rank) AS names FROM n WHERE rank <= 5 GROUP BY p_brand)
JOIN (SELECT p_brand, string_agg(p_type, '|' ORDER BY rank) AS types FROM t WHERE rank <= 5 GROUP BY p_brand) USING (p_brand)""")
def top_values_two_columns(spark, sf):
    """The most frequent names and types of every brand, as lists."""
    part = table(spark, sf, "part")
    lists = [tabular.top_value_lists(part, "p_brand", column, name, 5) for column, name in (("p_name", "names"), ("p_type", "types"))]
    return lists[0].join(lists[1], "p_brand").select("p_brand", F.array_join("names", "|").alias("names"), F.array_join("types", "|").alias("types"))


@query("D09_nominate_label", """SELECT source, lang AS label FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) = 1""")
def nominate_label(spark, sf):
    return tabular.nominate_label(table(spark, sf, "documents"), "source", "lang", "label")


@query("D10_value_counts", "SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL")
def value_counts(spark, sf):
    return tabular.value_counts(table(spark, sf, "documents"), "source", "lang")


@query("D14_histogram", """WITH b AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
SELECT least(floor((c_acctbal - lo) / (hi - lo) * 20), 19)::INT AS bin, count(*) AS n FROM customer, b GROUP BY ALL""")
def histogram(spark, sf):
    return tabular.histogram(table(spark, sf, "customer"), "c_acctbal", 20)


@query("D14_histogram_log10", """WITH v AS (SELECT log10(n_chars) AS x FROM documents WHERE n_chars > 0), b AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
SELECT least(floor((x - lo) / (hi - lo) * 30), 29)::INT AS bin, count(*) AS n FROM v, b GROUP BY ALL""")
def histogram_log10(spark, sf):
    return tabular.histogram(table(spark, sf, "documents").filter("n_chars > 0"), "n_chars", 30, log10=True)


@query("D15_table_counts", f"WITH {FORUM} SELECT coalesce(type, '(all)') AS type, count(*) AS n FROM vertices GROUP BY ROLLUP (type)")
def table_counts(spark, sf):
    return etl.table_counts(fx.forum(spark, sf).vertices)


@query("D16_label_set_counts", """SELECT array_to_string(list_sort([c_mktsegment, CASE WHEN c_acctbal >= 0 THEN 'Solvent' ELSE 'Indebted' END]), '|') AS label_set,
  count(*) AS n FROM customer GROUP BY ALL""")
def label_set_counts(spark, sf):
    labelled = table(spark, sf, "customer").select(
        F.array("c_mktsegment", F.when(F.col("c_acctbal") >= 0, "Solvent").otherwise("Indebted")).alias("labels"))
    return etl.label_set_counts(labelled)


@query("D17_schema_labels", f"""WITH {FORUM} SELECT DISTINCT 'node' AS kind, type AS label FROM vertices
UNION ALL SELECT DISTINCT 'edge', relationship FROM edges""")
def schema_labels(spark, sf):
    graph = fx.forum(spark, sf)
    return graph.vertices.select(F.lit("node").alias("kind"), F.col("type").alias("label")).distinct().unionByName(
        graph.edges.select(F.lit("edge").alias("kind"), F.col("relationship").alias("label")).distinct())


_PREDICTED = """SELECT o_orderkey, o_orderpriority AS label, CASE WHEN o_totalprice < 100000 THEN '1-URGENT' WHEN o_totalprice < 200000 THEN '2-HIGH'
  WHEN o_totalprice < 300000 THEN '3-MEDIUM' ELSE o_orderpriority END AS prediction FROM orders"""


def _predicted(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label"), F.when(price < 100000, "1-URGENT").when(
        price < 200000, "2-HIGH").when(price < 300000, "3-MEDIUM").otherwise(F.col("o_orderpriority")).alias("prediction"))


@query("D19_weighted_prf", f"""WITH p AS ({_PREDICTED}), classes AS (SELECT label AS class FROM p UNION SELECT prediction FROM p),
s AS (SELECT class, (SELECT count(*) FROM p WHERE label = class) AS support, (SELECT count(*) FROM p WHERE prediction = class) AS predicted,
  (SELECT count(*) FROM p WHERE prediction = class AND label = class) AS hit FROM classes)
SELECT round(sum(hit) / sum(support), 6) AS accuracy, round(sum(coalesce(hit / nullif(predicted, 0), 0) * support) / sum(support), 6) AS precision,
  round(sum(coalesce(hit / nullif(support, 0), 0) * support) / sum(support), 6) AS recall,
  round(sum(2.0 * hit / (support + predicted) * support) / sum(support), 6) AS f1 FROM s""")
def weighted_prf(spark, sf):
    scores = tabular.weighted_scores(_predicted(spark, sf))
    return scores.select(*[F.round(c, 6).alias(c) for c in scores.columns])


@query("D20_confusion_matrix", f"SELECT label, prediction, count(*) AS n FROM ({_PREDICTED}) GROUP BY ALL")
def confusion_matrix(spark, sf):
    return tabular.confusion_counts(_predicted(spark, sf))


@query("D21_roc_auc", """WITH s AS (SELECT value, event_type = 'purchase' AS y, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS r
  FROM events WHERE value IS NOT NULL)
SELECT round((sum(r) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2.0) / (count(*) FILTER (y) * count(*) FILTER (NOT y)), 6) AS auc FROM s""")
def roc_auc(spark, sf):
    scored = table(spark, sf, "events").filter("value IS NOT NULL").select("value", (F.col("event_type") == "purchase").alias("y"))
    return tabular.roc_auc(scored, "value", "y").select(F.round("auc", 6).alias("auc"))


@query("D22_bce_loss", """SELECT round(avg(greatest(x, 0) - x * y + ln(1 + exp(-abs(x)))), 6) AS bce
FROM (SELECT value / 10.0 AS x, CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM events)""")
def bce_loss(spark, sf):
    scored = table(spark, sf, "events").select((F.col("value") / 10.0).alias("x"), F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0).alias("y"))
    return tabular.bce_loss(scored, "x", "y").select(F.round("bce", 6).alias("bce"))


# --- S: order and limits ----------------------------------------------------------------------


@query("S01_order_by_count_desc", f"WITH {FORUM} SELECT relationship, count(*) AS n FROM edges GROUP BY ALL ORDER BY n DESC, relationship")
def order_by_count_desc(spark, sf):
    return etl.relationship_counts(fx.forum(spark, sf).edges).orderBy(F.desc("n"), "relationship")


@query("S02_limit_n", f"WITH {FORUM_TABLES} SELECT post_key, score FROM posts ORDER BY score DESC, post_key LIMIT 20")
def limit_n(spark, sf):
    return fx.forum_posts(spark, sf).select("post_key", "score").orderBy(F.desc("score"), "post_key").limit(20)


@query("S03_top_k_sizes", "SELECT l_partkey AS cluster, count(*) AS n FROM lineitem GROUP BY ALL ORDER BY n DESC, cluster LIMIT 50")
def top_k_sizes(spark, sf):
    sizes = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("cluster")).agg(F.count("*").alias("n"))
    return sizes.orderBy(F.desc("n"), "cluster").limit(50)


@query("S04_sample_rows", "SELECT p_partkey, p_name FROM part ORDER BY md5(p_partkey || ':31337'), p_partkey LIMIT 30")
def sample_rows(spark, sf):
    return tabular.sample_rows(table(spark, sf, "part").select("p_partkey", "p_name"), 30, 31337, "p_partkey")


@query("S05_sort_by_id", "SELECT vec_id, label FROM embeddings ORDER BY vec_id")
def sort_by_id(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label").orderBy("vec_id")


# --- U: set operations -------------------------------------------------------------------------


@query("U01_union_nodes", f"WITH {FORUM} SELECT id, type, source_id, vote_type FROM vertices")
def union_nodes(spark, sf):
    return fx.forum_vertices(spark, sf).select("id", "type", "source_id", "vote_type")


@query("U02_union_edges", f"WITH {FORUM} SELECT src, dst, relationship FROM edges")
def union_edges(spark, sf):
    return fx.forum_edges(spark, sf)


@query("E01_build_graph", f"""WITH {FORUM} SELECT (SELECT count(*) FROM vertices) AS n_vertices, (SELECT count(*) FROM edges) AS n_edges,
  (SELECT count(*) FROM edges WHERE src NOT IN (SELECT id FROM vertices) OR dst NOT IN (SELECT id FROM vertices)) AS dangling""")
def build_graph(spark, sf):
    """Sizes, and that no edge dangles."""
    vertices, edges, _ = fx.forum(spark, sf).short_ids()
    ends = edge_ends(edges.select(F.col("_src").alias("src"), F.col("_dst").alias("dst")))
    ids = vertices.select(F.col("_id").alias("id"))
    return vertices.agg(F.count("*").alias("n_vertices")).join(F.broadcast(edges.agg(F.count("*").alias("n_edges")))).join(
        F.broadcast(ends.join(ids, "id", "left_anti").agg(F.count("*").alias("dangling"))))


@query("U03_unique_nodes_from_edges", f"WITH {COPURCHASE} SELECT src AS id FROM edges UNION SELECT dst FROM edges")
def unique_nodes_from_edges(spark, sf):
    return edge_ends(fx.copurchase(spark, sf).edges)


@query("U04_neighbor_intersection", f"""WITH {COPURCHASE} SELECT src AS id, dst AS neighbor FROM edges
WHERE dst IN (SELECT id FROM vertices WHERE size <= 10)""")
def neighbor_intersection(spark, sf):
    graph = fx.copurchase(spark, sf)
    sample = graph.vertices.filter("size <= 10").select(F.col("id").alias("dst"))
    return graph.edges.join(sample, "dst", "left_semi").select(F.col("src").alias("id"), F.col("dst").alias("neighbor"))


_TEST_EDGE = "('0x' || substr(md5(src || ':' || dst || ':31337'), 1, 15))::BIGINT % 100 < 10"


@query("U05_remove_edges", f"WITH {COPURCHASE} SELECT src, dst FROM edges WHERE NOT {_TEST_EDGE}")
def remove_edges(spark, sf):
    edges = fx.copurchase(spark, sf).edges
    held_out = tabular.split_rows(edges, 10, 31337, "src", "dst").filter("split = 'test'")
    return edges.join(held_out.select("src", "dst"), ["src", "dst"], "left_anti")


@query("U07_multigraph_to_simple", "SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem WHERE l_suppkey <> l_partkey")
def multigraph_to_simple(spark, sf):
    return simple_digraph(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")))
