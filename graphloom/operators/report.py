"""One-row description of a graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.ordering import exact_median
from graphloom.graph import Graph
from graphloom.operators.components import connected_components, strongly_connected_components
from graphloom.operators.structure import clustering_directed, degree_summary
from graphloom.session import cut


def describe_graph(graph: Graph) -> DataFrame:
    """Sizes, degrees, components and clustering of a directed graph in one row."""
    sizes = cut(connected_components(graph)).groupBy("component").agg(F.count("*").alias("n"))
    weak = sizes.agg(F.count("*").alias("weak_components"), F.max("n").alias("largest_component"))
    strong = strongly_connected_components(graph).select("scc").distinct().agg(F.count("*").alias("strong_components"))
    c = cut(clustering_directed(graph))
    rows = [
        degree_summary(graph), weak, strong,
        c.agg(F.avg("clustering").alias("mean_clustering")), exact_median(c, "clustering", "median_clustering"),
    ]
    return reduce(lambda a, b: a.join(F.broadcast(b)), rows)
