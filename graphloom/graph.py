"""The property graph: one DataFrame of vertices, one of edges."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.session import cut


@dataclass(frozen=True)
class Graph:
    """Vertices carry ``id``; edges carry ``src`` and ``dst``; the rest are properties."""

    vertices: DataFrame
    edges: DataFrame

    @classmethod
    def from_edges(cls, edges: DataFrame) -> Graph:
        return cls(edge_ends(edges), edges)

    def short_ids(self) -> tuple[DataFrame, DataFrame, Callable[[Column], Column]]:
        """Vertices with a further ``_id``, edges with ``_src`` and ``_dst``, and what makes an id of these.

        Two of them are equal exactly when the ids are, so joins may carry them in their place: a graph
        whose ids are long texts made of short ones overrides this.  Where an id tells its vertex's kind, the
        vertices also have ``_kind`` and the edges ``_src_kind`` and ``_dst_kind``.
        """
        edges = self.edges.withColumns({"_src": F.col("src"), "_dst": F.col("dst")})
        return self.vertices.withColumn("_id", F.col("id")), edges, lambda short: short

    def persist(self) -> Graph:
        return Graph(self.vertices.persist(), self.edges.persist())

    def unpersist(self) -> None:
        self.vertices.unpersist()
        self.edges.unpersist()

    def save(self, path: str) -> None:
        """Two Parquet tables; ids keep their type.  Types become directories when known."""
        writer = self.vertices.write.mode("overwrite").option("compression", "zstd")
        if "type" in self.vertices.columns:
            writer = writer.partitionBy("type")
        writer.parquet(f"{path}/vertices")
        self.edges.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/edges")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Graph:
        return cls(spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/edges"))

    def induced(self, ids: DataFrame) -> Graph:
        """Keep the given vertices and the edges with both ends among them."""
        return Graph(
            self.vertices.join(ids.select("id"), "id", "left_semi"),
            induced_edges(self.edges, ids),
        )

    def without_isolates(self) -> Graph:
        """Drop vertices that no edge touches."""
        return Graph(self.vertices.join(edge_ends(self.edges), "id", "left_semi"), self.edges)

    def without_supernodes(self, cutoff: int) -> Graph:
        """Drop vertices whose total degree is above ``cutoff``, and their edges."""
        heavy = cut(endpoint_rows(self.edges).groupBy("id").count().filter(F.col("count") > cutoff).select("id"))
        kept = self.vertices.join(heavy, "id", "left_anti")
        edges = self.edges.join(heavy.withColumnRenamed("id", "src"), "src", "left_anti").join(
            heavy.withColumnRenamed("id", "dst"), "dst", "left_anti"
        )
        return Graph(kept, edges)

    def relabel(self, id_map: DataFrame, old: str = "id", new: str = "new_id") -> Graph:
        """Replace ids through a two-column map; rows without a mapping go."""
        pairs = id_map.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
        vertices = (
            self.vertices.join(pairs, F.col("id") == F.col("_old"))
            .withColumn("id", F.col("_new"))
            .drop("_old", "_new")
        )
        edges = self.edges
        for end in ("src", "dst"):
            edges = (
                edges.join(pairs, F.col(end) == F.col("_old"))
                .withColumn(end, F.col("_new"))
                .drop("_old", "_new")
            )
        return Graph(vertices, edges)

    def ids_as_long(self) -> Graph:
        """Text ids to integers; an id that is no number fails the job."""
        return Graph(
            self.vertices.withColumn("id", F.col("id").cast("bigint")),
            self.edges.withColumn("src", F.col("src").cast("bigint")).withColumn(
                "dst", F.col("dst").cast("bigint")
            ),
        )

    def with_property(self, values: DataFrame, name: str, default) -> Graph:
        """Set ``name`` from an (id, name) table, ``default`` where it has no row."""
        found = values.select("id", F.col(name).alias("_value"))
        vertices = (
            self.vertices.drop(name)
            .join(found, "id", "left")
            .withColumn(name, F.coalesce("_value", F.lit(default)))
            .drop("_value")
        )
        return Graph(vertices, self.edges)


def endpoint_rows(edges: DataFrame) -> DataFrame:
    """One ``id`` row per edge end, so a self-loop yields two."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id"))


def edge_ends(edges: DataFrame) -> DataFrame:
    """The distinct vertices that edges touch."""
    return endpoint_rows(edges).distinct()


def undirected_pairs(edges: DataFrame) -> DataFrame:
    """Simple undirected form: one (src < dst) row per linked pair, no loops."""
    return (
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct()
    )


def both_ways(pairs: DataFrame) -> DataFrame:
    """Every edge and its reverse, further columns kept; built with one scan."""
    rest = [c for c in pairs.columns if c not in ("src", "dst")]
    ends = F.array(
        F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
    )
    return pairs.select(F.explode(ends).alias("_end"), *rest).select("_end.src", "_end.dst", *rest)


def simple_digraph(edges: DataFrame) -> DataFrame:
    """Parallel edges and self-loops removed, direction kept."""
    return edges.select("src", "dst").filter(F.col("src") != F.col("dst")).distinct()


def induced_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with both ends in ``ids``: two semi-joins."""
    return edges.join(ids.select(F.col("id").alias("src")), "src", "left_semi").join(
        ids.select(F.col("id").alias("dst")), "dst", "left_semi"
    )
