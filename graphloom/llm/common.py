"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: characters that separate words where a contract says so: space and \t \n \v \f \r
BLANKS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str) -> str:
    """A column name that no caller's column can clash with."""
    return f"_{name}_{uuid.uuid4().hex[:12]}"


def text_of(column: str) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def document_key(id_column: str, text_column: str) -> list[Column]:
    """(id, key of the text): rows that repeat both are one document, rows that repeat only the id are two."""
    return [F.col(id_column).alias("id"), F.xxhash64(text_of(text_column)).alias("text_key")]


#: bytes that Spark hands to a Python worker at a time, whatever the length of the texts
ARROW_BYTES = 4 << 20


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, from whose session Python workers get at most ``ARROW_BYTES`` at a time, or one row.

    They also find this library where the driver found it, unless they have a path of their own.
    """
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df


def row_batches(batches: Iterator[pa.RecordBatch], rows: int = 2000, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded bytes, so that very long texts do not pile up in memory."""
    for batch in batches:
        step = max(1, min(rows, int(rows * size / max(size, batch.nbytes / max(1, batch.num_rows) * rows))))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
