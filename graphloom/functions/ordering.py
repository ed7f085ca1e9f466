"""Global numbering and running totals without a single-task window.

A window with no partition key sends everything to one task.  Both helpers
range-partition instead, keep the partition number with the row, and add the
totals of the partitions before it; only one row per partition meets on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.session import cut

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def dense_index(df: DataFrame, keys: list, name: str) -> DataFrame:
    """Number rows 0..n-1 by ``keys``, which must order the rows fully."""
    placed = cut(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _ROW_BITS).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # one row per partition: bounded by the partition count, never by the data
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_part", "_place", "_offset")
    )


def first_by_key(df: DataFrame, key: Column, ties: list[str], n: int) -> DataFrame:
    """The n rows of smallest ``key``, an md5 text, with ``ties`` to decide between equal ones.

    The same rows as a sorted limit, which would bring all n to one task.  As the key is uniform, a threshold
    on it leaves a few more rows than asked for; these are numbered and cut exactly.
    """
    rows = df.withColumn("_key", key)
    total = df.count()
    if n >= total:
        return df
    share = (n + 6 * n**0.5 + 10) / total
    while True:
        near = rows
        if share < 1:
            near = rows.filter(F.substring("_key", 1, 12) <= f"{int(share * 16**12):012x}")
        near = cut(near)
        if near.count() >= n:
            break
        share *= 2
    return dense_index(near, ["_key", *ties], "_at").filter(F.col("_at") < n).drop("_key", "_at")


def running_totals(df: DataFrame, keys: list, values: dict[str, str], total: str = "sum") -> DataFrame:
    """Inclusive running sum (or ``bit_xor``) of each column in ``values`` (source -> result) by ``keys``.

    ``keys`` must be unique per row; callers group by them first, which also
    turns a value that holds a third of all rows into one row.
    """
    add = getattr(F, total)
    placed = cut(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_part").agg(*[add(c).alias(f"_s_{c}") for c in values])
    offsets = sums.select(
        "_part", *[F.coalesce(add(f"_s_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in values]
    )
    upto = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.join(F.broadcast(offsets), "_part")
    for source, result in values.items():
        here, offset = add(source).over(upto), F.col(f"_o_{source}")
        out = out.withColumn(result, here + offset if total == "sum" else here.bitwiseXOR(offset))
    return out.drop("_part", *[f"_o_{c}" for c in values])


def exact_median(df: DataFrame, col: str, name: str) -> DataFrame:
    """Exact median as a one-row table, from value counts rather than a sort in one task."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count("*").alias("_n"))
    ranked = running_totals(counts, ["_v"], {"_n": "_upto"})
    total = df.filter(F.col(col).isNotNull()).agg(F.count("*").alias("_all"))
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    first = F.col("_upto") - F.col("_n") + 1
    holds_low = (first <= low) & (low <= F.col("_upto"))
    holds_high = (first <= high) & (high <= F.col("_upto"))
    return (
        ranked.join(F.broadcast(total))
        .filter(holds_low | holds_high)
        .agg(
            (
                (F.max(F.when(holds_low, F.col("_v"))) + F.max(F.when(holds_high, F.col("_v")))) / 2.0
            ).alias(name)
        )
    )


def next_value(df: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """Value of the following row of the same group, NULL on the group's last row.

    Rows are range-partitioned by (group, order), so a group that holds a third
    of all rows spreads over many tasks; a partition's last row looks up the
    first row of the next partition.  Rows that tie on ``order`` may swap.
    """
    keys = list(dict.fromkeys([group, *order, value]))
    placed = cut(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part", group).orderBy(*order, value)
    firsts = placed.groupBy("_part").agg(F.min(F.struct(*keys)).alias("_first"))
    following = firsts.select(
        "_part", F.lead("_first").over(Window.orderBy("_part")).alias("_next")
    )
    # one row per partition: bounded by the partition count, never by the data
    crossing = F.when(F.col(f"_next.{group}") == F.col(group), F.col(f"_next.{value}"))
    return (
        placed.withColumn("_inside", F.lead(value).over(inside))
        .withColumn("_last", F.lead(F.lit(1)).over(inside).isNull())
        .join(F.broadcast(following), "_part")
        .withColumn(name, F.when(F.col("_last"), crossing).otherwise(F.col("_inside")))
        .drop("_part", "_inside", "_last", "_next")
    )
