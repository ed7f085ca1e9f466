"""The registered queries and the pipeline on the smallest tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def test_all_queries_are_registered():
    from __spark_entry__ import queries

    names = list(queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op5_substring_dedup"])
def test_query_equals_sql(spark, name):
    from graphloom.llm.queries import ORACLES, QUERIES
    from tools.compare import compare, connect

    verdict, _, _, good = compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF)
    assert good, verdict


def test_stages_keep_columns_and_what_is_clean(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= before and docs.count() == len(now)
        if name != "sentencepiece":
            assert docs.columns == columns
        before = now
    assert docs.filter("not exact").count() == 0 and docs.count() > 100
