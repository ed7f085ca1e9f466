"""Sharding by a two-pass external shuffle, in DataFrame operations only.

Pass 1 scatters the records into memory-sized buckets by a seeded hash of their key.  Pass 2 shuffles
each bucket by Fisher-Yates (``shuffle()`` draws that permutation of the bucket's places) and writes it.
The buckets laid end to end are a uniform permutation of all records; shard s takes the s-th of equal
stretches of it, so a bucket is written into one shard or two and counts are at most one apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.ordering import running_totals
from graphloom.llm.common import fresh, shuffle_partitions, text_of
from graphloom.session import cut, shared_path

BUCKET_BYTES = 32 << 20


def record_size(text: str = "text"):
    """Bytes of the text in UTF-8 (null: none) plus 1."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 17, id_column: str = "doc_id",
                 text_column: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` as a seeded random permutation, partitioned by ``shard``, and return the written table.

    Columns ``shard`` (0 ..) and ``slot`` (gapless from 0 in each shard) are added; columns of the input with
    those names come back as ``input_shard`` and ``input_slot``.  Law: rows; shard sizes differ by one at most.
    The permutation depends on ids, texts, seed and the number of buckets, never on the partitioning.
    Null ids and null texts are keys like others, repeated rows are kept and tie arbitrarily (they are equal),
    an empty table gives an empty one.  A bucket is sorted with spilling, so a very long text needs no more
    than a row's memory.
    """
    spark = docs.sparkSession
    for name in ("shard", "slot"):
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, f"input_{name}")
    sizes = docs.agg(F.count("*").alias("n"), F.sum(record_size(text_column)).alias("bytes")).first()
    rows = sizes["n"]
    buckets = max(shuffle_partitions(spark), -(-(sizes["bytes"] or 0) // bucket_bytes))

    crc, bucket, row, before, order, position, n, upto = map(fresh, ("crc", "bucket", "row", "before", "order", "position", "n", "upto"))
    scattered = docs.withColumn(crc, F.crc32(F.encode(text_of(text_column), "UTF-8"))).withColumn(
        bucket, F.pmod(F.xxhash64(F.lit(seed), F.col(id_column), F.col(crc)), F.lit(buckets)).cast("int"))

    # one row per bucket from here: its permutation and the number of records before it
    counts = scattered.groupBy(bucket).agg(F.count("*").alias(n))
    totals = running_totals(counts, [bucket], {n: upto})
    # partition b holds bucket b alone, and a partition draws by seed and its own number; written once, so
    # a task that runs again reads the same permutation
    plan = cut(totals.repartitionById(buckets, bucket).select(bucket, (F.col(upto) - F.col(n)).alias(before),
               F.shuffle(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")), seed).alias(order)))

    inside = Window.partitionBy(bucket).orderBy(F.col(id_column), F.col(crc))
    placed = (
        scattered.repartition(buckets, bucket)
        .withColumn(row, F.row_number().over(inside))
        .join(plan.hint("merge"), bucket)
        .withColumn(position, F.col(before) + F.element_at(order, F.col(row)))
    )
    shard = F.expr(f"cast({position} * {shards} div {max(rows, 1)} as int)")
    first = F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")
    out = placed.withColumn("shard", shard).withColumn("slot", F.col(position) - first)
    out.drop(bucket, crc, row, before, order, position).write.partitionBy("shard").parquet(path)
    schema = T.StructType([*docs.schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def shard_digest(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per record of the written shards: where it lies, its size and checksum."""
    written = write_shards(docs.select("doc_id", "text"), shared_path(docs.sparkSession, "shards"), shards)
    return written.select(
        "doc_id", record_size().alias("size"), F.crc32(F.encode(text_of("text"), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
