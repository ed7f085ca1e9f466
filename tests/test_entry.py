"""The driver contract, on the smallest tables where they are present."""

import os

import pytest

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    from __spark_entry__ import oracle_sql, queries

    assert set(oracle_sql()) <= set(queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
@pytest.mark.parametrize("name", ["M03_motif_g5", "M06_motif_g14", "E09_clustering_directed", "L07_pair_feature_table"])
def test_query_equals_sql(spark, name):
    from __spark_entry__ import oracle_sql, queries
    from tools.compare import compare, connect

    verdict, _, _, good = compare(spark, connect(SF), name, queries()[name], oracle_sql()[name], SF)
    assert good, verdict
