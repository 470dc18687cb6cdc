"""Predictions against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clockwright.functions.numbers import ratio_or_zero
from clockwright.errors import TransformationError


def by_punch(scores: DataFrame, labels: DataFrame, punches: DataFrame) -> DataFrame:
    """(punch_id, punches, scores, actual_anomaly, predicted_anomaly): what the three tables say of each punch_id.

    The tables are put one below the other, each row with the side it is from,
    and counted per key.  Keys are combined before they are exchanged, once, so a
    repeated key is seen rather than multiplied, and a hot one costs one row a task.
    """
    def side(table: DataFrame, punch: int, score: int, actual: Column, predicted: Column) -> DataFrame:
        return table.select("punch_id", F.lit(punch).alias("punch"), F.lit(score).alias("score"),
                            actual.alias("actual"), predicted.alias("predicted"))

    no = F.lit(False)
    sides = (side(punches, 1, 0, no, no)
             .unionByName(side(scores, 0, 1, no, F.col("predicted_anomaly")))
             .unionByName(side(labels.where(F.col("is_anomaly")), 0, 0, F.lit(True), no)))
    return sides.groupBy("punch_id").agg(
        F.sum("punch").alias("punches"), F.sum("score").alias("scores"),
        F.max("actual").alias("actual_anomaly"), F.max("predicted").alias("predicted_anomaly"))


def truth_and_prediction(scores: DataFrame, labels: DataFrame, punches: DataFrame) -> DataFrame:
    """One row per scored clean punch: actual and predicted flag."""
    return (by_punch(scores, labels, punches).where((F.col("punches") > 0) & (F.col("scores") > 0) & F.col("punch_id").isNotNull())
            .select("punch_id", "actual_anomaly", "predicted_anomaly"))


def _confusion_counts() -> list[Column]:
    actual, predicted = F.col("actual_anomaly"), F.col("predicted_anomaly")
    return [
        F.count_if(actual & predicted).alias("true_positives"),
        F.count_if(~actual & predicted).alias("false_positives"),
        F.count_if(actual & ~predicted).alias("false_negatives"),
        F.count_if(~actual & ~predicted).alias("true_negatives"),
    ]


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.agg(*_confusion_counts())


def metrics(counts: DataFrame) -> DataFrame:
    hit, false_alarm, missed = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives"))
    return counts.select(
        ratio_or_zero(hit, hit + false_alarm).alias("precision"),
        ratio_or_zero(hit, hit + missed).alias("recall"),
        ratio_or_zero(2 * hit, 2 * hit + false_alarm + missed).alias("f1"),
        "true_positives", "false_positives", "false_negatives", "true_negatives",
    )


def checked_confusion(scores: DataFrame, labels: DataFrame, punches: DataFrame) -> DataFrame:
    """The four counts, and how many keys of punches and of scores are NULL or repeat: one row, one exchange by key."""
    def faulty(side: str) -> Column:
        return F.count_if((F.col(side) > 1) | (F.col("punch_id").isNull() & (F.col(side) > 0))).alias(f"bad_{side}")

    found = by_punch(scores, labels, punches)
    both = (F.col("punches") > 0) & (F.col("scores") > 0)
    flags = {c: F.when(both, F.col(c)) for c in ("actual_anomaly", "predicted_anomaly")}
    return found.withColumns(flags).agg(*_confusion_counts(), faulty("punches"), faulty("scores"))


def evaluate(scores: DataFrame, labels: DataFrame, punches: DataFrame) -> DataFrame:
    """Precision, recall, F1 and the four counts; punches and scores must match one to one.

    Counts and checks come from one job; only its one row reaches the driver.
    """
    counts = checked_confusion(scores, labels, punches)
    row = counts.first()
    for side in ("punches", "scores"):
        if row[f"bad_{side}"]:
            raise TransformationError(f"{side}: {row[f'bad_{side}']} values of punch_id are NULL or repeat")
    return metrics(scores.sparkSession.createDataFrame([row], counts.schema))
