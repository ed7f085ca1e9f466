"""Exact dedup by distributed MSD radix partitioning.

A document's digits are stretches of its normalised bytes, 16 bytes first and eight times as many each
time.  On the cluster, the rows are counted by their first digit (map-side combined).  A branch that holds
more than its share of all rows is split by the next digit, until it is small enough for one task or its
texts have ended: then they are equal, and one small aggregate finds the row that stays.  Every other branch
goes to one task, which goes on splitting by successive digits until groups are singleton or ended.
Equality is that of the bytes; no digest decides it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.pandas.types import to_arrow_schema

from graphloom.llm.common import BLANKS, fresh, in_small_batches, row_batches, shuffle_partitions, text_of

FIRST_DIGIT, GROWTH = 16, 8
#: a branch may hold this part of a mean task's rows before it is split on the cluster
BRANCHES_PER_TASK = 4


def radix_groups(texts: list[bytes]) -> Iterator[list[int]]:
    """Groups of equal texts, by splitting on successive digits until a group is singleton or ended."""
    stack = [(list(range(len(texts))), 0, FIRST_DIGIT)]
    while stack:
        members, start, width = stack.pop()
        branches: dict[bytes, list[int]] = {}
        for i in members:
            branches.setdefault(texts[i][start:start + width], []).append(i)
        for digit, group in branches.items():
            if len(group) == 1 or len(digit) < width:
                yield group
            else:
                stack.append((group, start + width, width * GROWTH))


def _resolve(schema: T.StructType):
    """Answers for rows sorted by branch; one branch and one batch are in memory at a time."""
    arrow = to_arrow_schema(schema)

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        for group in radix_groups([r[4] for r in rows]):
            def rank(i: int) -> tuple:
                _, key, row, points, _ = rows[i]
                return (-points, 1, row) if key is None else (-points, 0, key, row)

            best = min(group, key=rank)
            digest = hashlib.sha256(rows[group[0]][4]).hexdigest()
            out += [(rows[i][1], rows[best][1], len(group), i == best, digest, rows[i][2]) for i in group]
        columns = zip(*out, strict=True)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in row_batches(batches):
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("bucket", "id", "row", "points", "body")], strict=True))
            if held and held[-1][0] != rows[0][0]:
                yield answer(held)
                held = []
            last = rows[-1][0]
            if rows[0][0] != last:
                cut_at = next(i for i in range(len(rows) - 1, -1, -1) if rows[i][0] != last) + 1
                yield answer(held + rows[:cut_at])
                held, rows = [], rows[cut_at:]
            held += rows
        if held:
            yield answer(held)

    return resolve


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, row.

    Texts are equal when identical after deleting blanks (space, \\t to \\r).  The row with the most code
    points, then the smallest id stays; null ids come last, and of rows that repeat an id one stays.  A null
    text is an empty one; all empty texts are one group.  Very long texts are only read further while they
    still agree with another.  Columns beside the two named ones play no part.  An empty table gives an empty
    one.  Rows are told apart by ``row``, their place in the scan, so ``docs`` is a table read from files.
    """
    spark = docs.sparkSession
    rows = in_small_batches(docs).select(F.col(id_column).alias("id"), text_of(text_column).alias("_t")).select(
        "id", F.monotonically_increasing_id().alias("row"), F.length("_t").alias("points"),
        F.encode(F.regexp_replace("_t", BLANKS, ""), "UTF-8").alias("body"),
        F.lit(0).alias("branch"), F.lit(0).alias("start"), F.lit(FIRST_DIGIT).alias("width"), F.lit(False).alias("ended"))
    n = docs.count()
    most = max(1, n // (BRANCHES_PER_TASK * shuffle_partitions(spark)))

    known, level, start, width, any_ended = 0, 0, 0, FIRST_DIGIT, False
    while True:
        # branches over their share are fewer than n / most, so what comes to the driver and is broadcast is bounded
        heavy = (
            rows.filter((F.col("branch") >= level) & ~F.col("ended"))
            .groupBy("branch", F.substring("body", start + 1, width).alias("digit"))
            .agg(F.count("*").alias("n")).filter(F.col("n") > most).select("branch", "digit").collect()
        )
        if not heavy:
            break
        level = known + 1
        found = [(h["branch"], h["digit"], level + i, len(h["digit"]) < width) for i, h in enumerate(heavy)]
        known += len(found)
        start, width = start + width, width * GROWTH
        split = spark.createDataFrame(found, "branch int, digit binary, node int, over boolean")
        digit = F.expr("substring(body, start + 1, width)")
        rows = rows.withColumn("digit", digit).join(F.broadcast(split), ["branch", "digit"], "left").select(
            "id", "row", "points", "body", F.coalesce("node", "branch").alias("branch"),
            F.when(F.col("node").isNull(), F.col("start")).otherwise(start).alias("start"),
            F.when(F.col("node").isNull(), F.col("width")).otherwise(width).alias("width"),
            (F.col("ended") | F.coalesce("over", F.lit(False))).alias("ended"))
        any_ended = any_ended or any(over for *_, over in found)
        if all(over for *_, over in found):
            break

    schema = T.StructType([
        T.StructField("id", docs.schema[id_column].dataType), T.StructField("keep_id", docs.schema[id_column].dataType),
        T.StructField("group_size", T.LongType()), T.StructField("kept", T.BooleanType()),
        T.StructField("text_sha256", T.StringType()), T.StructField("row", T.LongType())])
    answers = (
        rows.filter(~F.col("ended"))
        .select(F.xxhash64("branch", F.expr("substring(body, start + 1, width)")).alias("bucket"), "id", "row", "points", "body")
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_resolve(schema), schema)
    )
    if any_ended:
        hot = rows.filter("ended")
        best = hot.groupBy("branch").agg(
            F.count("*").alias("group_size"),
            F.min(F.struct((-F.col("points")).alias("points"), F.col("id").isNull().alias("none"), "id", "row")).alias("best"))
        # one row per ended branch: fewer than n / most
        answers = answers.unionByName(hot.join(F.broadcast(best), "branch").select(
            "id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
            F.sha2("body", 256).alias("text_sha256"), "row"))
    return answers


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The row of every group of equal texts that stays, with all its columns."""
    row = fresh("row")
    kept = exact_duplicates(docs, id_column, text_column).filter("kept").select(F.col("row").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(kept, row, "left_semi").drop(row)
