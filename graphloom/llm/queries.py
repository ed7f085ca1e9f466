"""The registered corpus queries, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphloom.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    html_extract,
    langid,
    licenses,
    ngram_join,
    prefix_trie,
    sentencepiece_fst,
    sharding,
    substring_dedup,
    toxicity,
    vector_codes,
)
from graphloom.llm.common import table

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_exact_dedup", r"""
    WITH d AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body,
               length(coalesce(text, '')) AS points
        FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, sha256(body) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY body ORDER BY points DESC, doc_id)""")
def op1(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("row").withColumnRenamed("id", "doc_id")


@query("op10_sharding")
def op10(spark, sf_dir):
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


@query("op6_license_scan")
def op6(spark, sf_dir):
    scanned = licenses.license_scan(table(spark, sf_dir, "documents"))
    return scanned.drop("spans").withColumnRenamed("id", "doc_id")


@query("op8_decontaminate")
def op8(spark, sf_dir):
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "matched", "overlap")


@query("op7_language_id")
def op7(spark, sf_dir):
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), langid.held_out("id").alias("held_out"), "lang_pred", "score")


@query("op2_sentencepiece")
def op2(spark, sf_dir):
    return sentencepiece_fst.round_trip(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op5_substring_dedup", r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
        SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS c
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)),
    later AS (
        SELECT doc_id, s FROM (
            SELECT doc_id, s, row_number() OVER (PARTITION BY c ORDER BY doc_id, s) AS r FROM windows) WHERE r > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later),
    words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k, count(*) AS n
        FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (doc_id)""")
def op5(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text").withColumnRenamed("id", "doc_id")


@query("op9_ngram_join")
def op9(spark, sf_dir):
    found = ngram_join.similar_documents(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links")


@query("op4_toxicity")
def op4(spark, sf_dir):
    found = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), toxicity.held_out("id").alias("held_out"), "score", "predicted")


@query("op3_html_extract")
def op3(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query("op11_bpe")
def op11(spark, sf_dir):
    found = bpe.round_trip(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


@query("op12_prefix_trie", r"""
    WITH table_ AS (
        SELECT list(list_reduce(list_concat([n], range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY n) AS t
        FROM range(256) AS bytes(n)),
    own AS MATERIALIZED (
        SELECT conv_id AS c, list(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))
                   ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own_turns,
               list(length(coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own_sizes
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    hashed AS MATERIALIZED (
        SELECT own.*, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT)),
                   lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) % 6 AS h
        FROM own, table_),
    conv AS MATERIALIZED (
        SELECT a.c, list_concat(coalesce(g.own_turns[1:a.h], []), a.own_turns[a.h + 1:]) AS turns,
               list_concat(coalesce(g.own_sizes[1:a.h], []), a.own_sizes[a.h + 1:]) AS sizes
        FROM hashed a LEFT JOIN own g ON g.c = a.c - a.c % 100),
    member AS MATERIALIZED (
        SELECT c, d, turns[1:d] AS path, len(turns) = d AS ends, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size
        FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM conv)),
    node AS MATERIALIZED (
        SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
               sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
        FROM member GROUP BY d, path),
    children AS (SELECT path[1:d - 1] AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
    weighed AS (
        SELECT d, node.path, (n_convs - 1) * size AS weight, n IS NULL AS leaf FROM node LEFT JOIN children USING (path)),
    below AS (
        SELECT path[1:up] AS path, sum(weight) AS saved, sum(leaf::BIGINT) AS leaves
        FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM weighed) GROUP BY path[1:up])
    SELECT node.conv_id, node.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(children.n, 0)::BIGINT AS n_children,
           leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, node.ends_sha256
    FROM node LEFT JOIN node parent ON node.d > 0 AND parent.d = node.d - 1 AND parent.path = node.path[1:node.d - 1]
    LEFT JOIN children ON children.path = node.path JOIN below ON below.path = node.path""")
def op12(spark, sf_dir):
    return prefix_trie.shared_head_trie(table(spark, sf_dir, "conversations"))


def _quantised(rounds: int) -> str:
    """SQL of the codes, one table for each round's codebooks."""
    def nearest(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
        SELECT r, p, arg_min(k, gap * 16 + k) AS k, min(gap) AS gap FROM (
            SELECT r, part.p, k, list_sum(list_transform(list_zip(part.v, b{n}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS gap
            FROM part JOIN b{n} USING (p)) GROUP BY r, p),"""

    steps = "".join(nearest(n) + f"""
    m{n} AS (
        SELECT p, k, list((s - ((s % c) + c) % c) // c ORDER BY i)::BIGINT[] AS v FROM (
            SELECT p, k, i, sum(x) AS s, count(*) AS c FROM (
                SELECT p, k, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM a{n} JOIN part USING (r, p)) GROUP BY p, k, i) GROUP BY p, k),
    b{n + 1} AS MATERIALIZED (SELECT p, k, coalesce(m{n}.v, b{n}.v) AS v FROM b{n} LEFT JOIN m{n} USING (p, k)),
    """ for n in range(rounds))
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
               list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    part AS MATERIALIZED (SELECT r, p, e[p * len(e) // 8 + 1:(p + 1) * len(e) // 8] AS v FROM kept, range(8) AS of(p)),
    b0 AS (SELECT p, r - 1 AS k, v FROM part WHERE r <= 16),
    {steps}{nearest(rounds)}
    book AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b{rounds}),
    coded AS (
        SELECT r, string_agg(lpad(lower(hex(k)), 2, '0'), '' ORDER BY p) AS code, sum(gap)::BIGINT AS error
        FROM (SELECT r, p, k::BIGINT AS k, gap FROM a{rounds}) GROUP BY r)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (r), book"""


@query("op13_vector_codes", _quantised(6))
def op13(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).drop("label").withColumnRenamed("id", "vec_id")
