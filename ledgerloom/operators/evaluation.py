"""Errors of predictions, metrics of binary scores, shuffled batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arrays import clipped
from .running import ROWS_BEFORE, STEPS_PER_DOUBLING, numbered, value_step

# Decision threshold of the binary metrics.
THRESHOLD = 0.5


def regression_error(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    """Mean absolute error and root mean squared error."""
    miss = predicted - actual
    return df.agg(
        F.count(miss).alias("n"),
        F.try_divide(F.sum(F.abs(miss)).cast("double"), F.count(miss)).alias("mae"),
        F.sqrt(F.try_divide(F.sum(miss * miss).cast("double"), F.count(miss))).alias("rmse"),
    )


def area_under_roc(df: DataFrame, label: str, probability: str) -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counted half; one row, ``auc``.

    Rows are counted per distinct score first.  Pairs are then counted inside steps of the
    score range, and between neighbours on each coarser level, so no task sees all scores.
    """
    positive = F.col(label) == 1
    pairs = (
        df.groupBy(F.col(probability).alias("score"))
        .agg(F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives"))
        .withColumn("won", F.col("positives") * F.col("negatives").cast("double") / 2)
        .withColumn("step", value_step(F.col("score")))
        .withColumn("doubling", F.floor(F.col("step") / STEPS_PER_DOUBLING))
    )
    for parent, child in ((["doubling", "step"], "score"), (["doubling"], "step"), ([], "doubling")):
        earlier = Window.partitionBy(*parent).orderBy(child).rowsBetween(*ROWS_BEFORE)
        below = F.coalesce(F.sum("negatives").over(earlier), F.lit(0))
        pairs = (
            pairs.withColumn("won", F.col("won") + F.col("positives").cast("double") * below)
            .groupBy(*parent)
            .agg(F.sum("won").alias("won"), F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"))
        )
    return pairs.select(F.try_divide("won", F.col("positives").cast("double") * F.col("negatives")).alias("auc"))


def binary_metrics(df: DataFrame, label: str, probability: str, threshold: float = THRESHOLD) -> DataFrame:
    """One row: n, loss, accuracy, precision, recall, auc."""
    positive, called = F.col(label) == 1, F.col(probability) > threshold
    p = clipped(F.col(probability))
    counts = df.agg(
        F.count("*").alias("n"),
        F.avg(F.when(positive, -F.ln(p)).otherwise(-F.ln(1 - p))).alias("loss"),
        F.count_if(positive & called).alias("_tp"),
        F.count_if(~positive & called).alias("_fp"),
        F.count_if(positive & ~called).alias("_fn"),
        F.count_if(~positive & ~called).alias("_tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("_tp", "_fp", "_fn", "_tn"))
    none = F.lit(0.0)
    return counts.select(
        "n",
        "loss",
        F.try_divide(tp + tn, F.col("n")).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), none).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), none).alias("recall"),
        area_under_roc(df, label, probability).scalar().alias("auc"),
    )


def shuffled_batches(df: DataFrame, key: str, seed: int, size: int = 32) -> DataFrame:
    """Number the rows in a random but repeatable order and cut them into batches.

    The order is that of a hash of the (unique) key, so its leading digits split the rows evenly.
    ``df`` is read twice; store it first if it is costly to work out.
    """
    mixed = df.withColumn("_hash", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(seed).cast("string"))))
    levels = mixed.withColumn("_two", F.substring("_hash", 1, 2)).withColumn("_four", F.substring("_hash", 1, 4))
    placed = numbered(levels, ["_hash", key], "position", ["_two", "_four"])
    batch = F.floor((F.col("position") - 1) / size)
    return placed.withColumn("batch", batch).drop("_hash", "_two", "_four")
