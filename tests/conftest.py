import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))  # for Spark's workers


@pytest.fixture(scope="session")
def spark():
    from graphloom.session import build_session

    session = build_session("local[4]", "graphloom-tests", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Graph from (src, dst) pairs and, if wanted, further isolated vertices."""
    from graphloom.graph import Graph

    def build(pairs, extra=()):
        ids = sorted({v for p in pairs for v in p} | set(extra))
        vertices = spark.createDataFrame([(i, "N") for i in ids], "id bigint, type string")
        edges = spark.createDataFrame([(s, d, "R") for s, d in pairs], "src bigint, dst bigint, relationship string")
        return Graph(vertices, edges)

    return build
