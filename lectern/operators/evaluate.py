"""Confusion counts, metrics, thresholds, worst errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import scores as sc
from lectern.operators.ranking import top_k


def _cells(predicted: Column) -> dict[str, Column]:
    """Conditional counts.  A row without label or prediction fits no condition,
    so nulls need no filter, which would evaluate a model a second time."""
    label, predicted = F.col("label").cast("int"), predicted.cast("int")
    return {
        "tp": F.count_if((label == 1) & (predicted == 1)),
        "tn": F.count_if((label == 0) & (predicted == 0)),
        "fp": F.count_if((label == 0) & (predicted == 1)),
        "fn": F.count_if((label == 1) & (predicted == 0)),
    }


def confusion_matrix(predictions: DataFrame, *by: str) -> DataFrame:
    """tp, tn, fp, fn per group ``by``, in one aggregation; zeros when empty."""
    cells = [c.alias(name) for name, c in _cells(F.col("prediction")).items()]
    return predictions.groupBy(*by).agg(*cells)


def with_metrics(confusion: DataFrame) -> DataFrame:
    """Adds total, accuracy, precision, recall and F1 of class 1; a ratio with
    denominator zero is 0."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    total = tp + tn + fp + fn
    # 2pr/(p+r) equals 2tp/(2tp+fp+fn), and both are 0 when tp is.
    return confusion.select(
        "*",
        total.alias("total"),
        sc.ratio_or_zero(tp + tn, total).alias("accuracy"),
        sc.ratio_or_zero(tp, tp + fp).alias("precision"),
        sc.ratio_or_zero(tp, tp + fn).alias("recall"),
        sc.ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def classification_metrics(predictions: DataFrame, *by: str) -> DataFrame:
    return with_metrics(confusion_matrix(predictions, *by))


def metrics_at_thresholds(
    scored: DataFrame, thresholds: Sequence[float], score_col: str = "score"
) -> DataFrame:
    """Metrics of ``score >= t`` for every threshold, in one pass.

    Each threshold has its own four counters, so no row is multiplied.
    """
    score = F.col(score_col)
    counters = []
    for i, t in enumerate(thresholds):
        predicted = sc.decide(score, t)
        counters += [c.alias(f"{name}_{i}") for name, c in _cells(predicted).items()]
    one_row = scored.agg(*counters)
    per_threshold = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            *(F.col(f"{name}_{i}").alias(name) for name in ("tp", "tn", "fp", "fn")),
        )
        for i, t in enumerate(thresholds)
    ]
    return with_metrics(one_row.select(F.inline(F.array(*per_threshold))))


def top_errors(predictions: DataFrame, k: int = 5, score_col: str = "score", key: str = "id") -> DataFrame:
    """The k most confident false positives and the k most confident false
    negatives, ties by key."""
    label, predicted = F.col("label").cast("int"), F.col("prediction").cast("int")
    # Each row meets one of the two conditions on the prediction, not both.
    wrong = predictions.filter(
        ((label == 0) & (predicted == 1)) | ((label == 1) & (predicted == 0))
    ).withColumn("error", F.when(label == 0, "false_positive").otherwise("false_negative"))
    return top_k(wrong, [F.desc(F.abs(F.col(score_col))), key], k, by=["error"])


def false_positives(predictions: DataFrame, k: int = 5) -> DataFrame:
    return top_errors(predictions, k).filter(F.col("error") == "false_positive")


def false_negatives(predictions: DataFrame, k: int = 5) -> DataFrame:
    return top_errors(predictions, k).filter(F.col("error") == "false_negative")
