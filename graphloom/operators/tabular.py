"""Grouped summaries, scores and row selection that several parts share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.hashing import bucket60, order_key
from graphloom.functions.ordering import dense_index, first_by_key, running_totals


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, group: str, value: str, n: int = 5) -> DataFrame:
    """The n most frequent values per group, with their rank and count.

    Rows are counted before the window, and the rank filter is applied per task
    before the shuffle, so a group of any size sends n rows per task.
    """
    counts = df.groupBy(group, value).agg(F.count("*").alias("n"))
    order = Window.partitionBy(group).orderBy(F.desc("n"), F.asc(value))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def top_value_lists(df: DataFrame, group: str, value: str, name: str, n: int = 5) -> DataFrame:
    """The n most frequent values per group as one list, most frequent first."""
    ranked = top_values(df, group, value, n)
    listed = F.array_sort(F.collect_list(F.struct("rank", F.col(value).alias("value"))))
    return ranked.groupBy(group).agg(F.transform(listed, lambda x: x["value"]).alias(name))


def nominate_label(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """The most frequent value stands for the group; ties go to the smaller value."""
    return top_values(df, group, value, 1).select(group, F.col(value).alias(name))


def histogram(df: DataFrame, col: str, bins: int, log10: bool = False) -> DataFrame:
    """Equal-width bins over the column's range (or over its log10); empty bins are left out."""
    x = F.log10(col) if log10 else F.col(col).cast("double")
    values = df.select(x.alias("x")).filter("x IS NOT NULL")
    bounds = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    place = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    )
    # the joined side is one row
    return (
        values.join(F.broadcast(bounds))
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def share_of_total(df: DataFrame, col: str, name: str) -> DataFrame:
    """Each row's part of the column's total."""
    total = df.agg(F.sum(col).alias("_total"))
    return df.join(F.broadcast(total)).withColumn(name, F.try_divide(F.col(col), F.col("_total"))).drop("_total")


def sample_rows(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows in a seeded random order, the same ones on every run."""
    return first_by_key(df, order_key(seed, *keys), list(keys), n)


def split_rows(df: DataFrame, test_percent: int, seed: int, *keys: str) -> DataFrame:
    """Mark each row train or test by its key, whatever the partitioning."""
    is_test = F.pmod(bucket60(seed, *keys), F.lit(100)) < test_percent
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def label_encode(df: DataFrame, col: str, name: str) -> DataFrame:
    """Code of each value in sorted order, numbered over the distinct values."""
    codes = dense_index(df.select(col).filter(F.col(col).isNotNull()).distinct(), [col], name)
    return df.join(codes, col, "left")


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    facts = df.agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols]
    )
    scaled = {
        c: F.when(F.col(f"_s_{c}") == 0, 0.0).otherwise((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
        for c in cols
    }
    return df.join(F.broadcast(facts)).withColumns(scaled).select(*df.columns)


# --- scores of predictions -------------------------------------------------------------------


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def weighted_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1; micro F1 equals accuracy."""
    pairs = confusion_counts(df, label, prediction)
    per_class = (
        pairs.select(
            F.explode(
                F.array(
                    F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                             F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
                    F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                             F.lit(0).cast("bigint").alias("hit")),
                )
            ).alias("r")
        )
        .groupBy("r.class")
        .agg(F.sum("r.support").alias("support"), F.sum("r.predicted").alias("predicted"), F.sum("r.hit").alias("hit"))
        .withColumn("precision", F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0)))
        .withColumn("recall", F.coalesce(F.try_divide("hit", "support"), F.lit(0.0)))
        .withColumn("f1", F.coalesce(F.try_divide(2.0 * F.col("hit"), F.col("support") + F.col("predicted")), F.lit(0.0)))
    )

    def weighted(c: str) -> Column:
        return (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)

    return per_class.agg(
        (F.sum("hit") / F.sum("support")).alias("accuracy"), weighted("precision"), weighted("recall"), weighted("f1")
    )


def roc_auc(df: DataFrame, score: str, positive: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Rows fold to (score, positives, negatives) first, and the negatives below
    each score come from a distributed running total.
    """
    by_score = df.groupBy(F.col(score).alias("_score")).agg(
        F.count_if(F.col(positive)).alias("_pos"), F.count_if(~F.col(positive)).alias("_neg")
    )
    ranked = running_totals(by_score, ["_score"], {"_neg": "_upto"})
    wins = F.sum(F.col("_pos") * (F.col("_upto") - F.col("_neg") * 0.5))
    return ranked.agg(F.try_divide(wins, F.sum("_pos") * F.sum("_neg").cast("double")).alias("auc"))


def bce_loss(df: DataFrame, logit: str, target: str) -> DataFrame:
    """Mean binary cross-entropy of logits, in the form that cannot overflow."""
    x, y = F.col(logit), F.col(target)
    return df.agg(F.avg(F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))).alias("bce"))


def union_labelled(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """Positives labelled 1, negatives labelled 0."""
    return reduce(
        DataFrame.unionByName, [positives.withColumn("label", F.lit(1)), negatives.withColumn("label", F.lit(0))]
    )
