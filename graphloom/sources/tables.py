"""Readers and writers.  Writers keep the job's own parallelism: one file per task,
never the whole table through a single one."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.vectors import vector_to_json
from graphloom.operators.etl import fill_blank, strip_attr_prefix

_ROW_BITS = 33


def scan_xml_rows(spark: SparkSession, path: str, schema: T.StructType | str, row_tag: str = "row") -> DataFrame:
    """Rows of an XML dump; the schema names attributes with a leading underscore."""
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    return strip_attr_prefix(rows)


def sink_xml_rows(df: DataFrame, path: str, root_tag: str, row_tag: str = "row") -> None:
    """Write columns as attributes of row elements."""
    attributes = df.toDF(*[f"_{c}" for c in df.columns])
    attributes.write.mode("overwrite").format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(path)


def sink_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def scan_parquet_typed(spark: SparkSession, path: str, type_name: str) -> DataFrame:
    """An entity table with its type stamped on."""
    return spark.read.parquet(path).withColumn("type", F.lit(type_name))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their line number from 0, files in path order.

    Every split counts its own lines; one row per split carries the offsets, so
    nothing is sorted and no task sees the whole text.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
    )
    split = ["_file", "_block"]
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        lines.groupBy(*split)
        .agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
        .select(*split, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return lines.join(offsets, split).select(
        (F.col("_offset") + F.col("_place") - F.col("_first")).alias("line"), "value"
    )


def scan_edge_list(spark: SparkSession, path: str, comment: str = "#") -> DataFrame:
    """Tab-separated id pairs; ``edge_id`` is the physical line, comments counted."""
    pair = F.split(F.trim("value"), "\t")
    return numbered_lines(spark, path).filter(~F.col("value").startswith(comment)).select(
        F.col("line").alias("edge_id"), pair[0].cast("bigint").alias("src"), pair[1].cast("bigint").alias("dst")
    )


def scan_record_files(spark: SparkSession, path: str, id_pattern: str = r"(\d+)\.[^./]*$") -> DataFrame:
    """One whole text per file; the id is read from the file's path."""
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return whole.select(
        F.regexp_extract(F.col("_metadata.file_path"), id_pattern, 1).cast("bigint").alias("file_id"),
        F.col("value").alias("record"),
    )


def scan_record_tars(spark: SparkSession, path: str) -> DataFrame:
    """The same from a folder of tar archives, one archive per row; shard archives well below 2 GB,
    the most that a row can hold (Spark raises beyond that)."""
    return untar_records(spark.read.format("binaryFile").load(path).select("content"))


def untar_records(archives: DataFrame, at_once: int = 500) -> DataFrame:
    """Records of tar archives in the column ``content``; members are streamed in batches."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[int] = []
        records: list[str] = []
        for batch in batches:
            for content in batch["content"]:
                with tarfile.open(fileobj=io.BytesIO(content), mode="r|*") as archive:
                    for member in archive:
                        if not member.isfile():
                            continue
                        ids.append(int(member.name.rsplit("/", 1)[-1].split(".")[0]))
                        records.append(archive.extractfile(member).read().decode("utf-8", "replace"))
                        if len(ids) == at_once:
                            yield pd.DataFrame({"file_id": ids, "record": records})
                            ids, records = [], []
        yield pd.DataFrame({"file_id": pd.Series(ids, dtype="int64"), "record": pd.Series(records, dtype="object")})

    return archives.select("content").mapInPandas(members, "file_id bigint, record string")


def tar_records(records: DataFrame, members: int = 500) -> DataFrame:
    """(content): rows (file_id, record) as tar archives of up to ``members`` files each."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), members):
                held = io.BytesIO()
                with tarfile.open(fileobj=held, mode="w") as archive:
                    for row in batch.iloc[low:low + members].itertuples():
                        body = row.record.encode()
                        entry = tarfile.TarInfo(f"records/{row.file_id}.txt")
                        entry.size = len(body)
                        archive.addfile(entry, io.BytesIO(body))
                yield pd.DataFrame({"content": [held.getvalue()]})

    return records.select("file_id", "record").mapInPandas(pack, "content binary")


def scan_dates(spark: SparkSession, path: str, comment: str = "#") -> DataFrame:
    """Tab-separated (id, ISO date) as UTC epoch seconds."""
    pair = F.split(F.trim("value"), "\t")
    # a date is a day number, so its epoch seconds do not depend on the session's time zone
    day = F.unix_date(F.to_date(pair[1]))
    return spark.read.text(path).filter(~F.col("value").startswith(comment)).select(
        pair[0].cast("bigint").alias("paper_id"), (day.cast("bigint") * 86400).alias("published")
    )


def sink_embeddings_json(df: DataFrame, path: str) -> None:
    """(id, vector) rows as gzipped JSON lines."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def cached_table(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """Read the table at ``path`` if it is there, else compute, write and read it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    sink_parquet(compute(), path)
    return spark.read.parquet(path)


def node_table_sink(vertices: DataFrame, columns: list[str], path: str) -> None:
    """Chosen columns, NULL text as '', to Parquet."""
    sink_parquet(fill_blank(vertices.select(*columns)), path)


def vectors_as_json(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(key, vector_to_json(vector).alias("vector_json"))
