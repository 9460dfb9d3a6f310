"""Score expressions: sigmoid, thresholds, guarded ratios, sparse-vector sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(margin: Column) -> Column:
    """Logistic function.  ``exp`` of a large value is infinity, whose inverse
    is 0, so both tails are safe without a branch."""
    return 1.0 / (1.0 + F.exp(-margin))


def decide(score: Column, threshold: float) -> Column:
    """1.0 from the threshold upwards, 0.0 below, null without a score."""
    return (score >= F.lit(float(threshold))).cast("double")


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(0.0)


def vector_entries(vector: Column) -> Column:
    """The stored entries of a sparse ML vector as array<struct<idx, value>>."""
    raw = F.unwrap_udt(vector)
    return F.arrays_zip(raw["indices"].alias("idx"), raw["values"].alias("value"))


def vector_total(vector: Column) -> Column:
    """Sum of a vector's stored values, without making it dense."""
    return F.aggregate(F.unwrap_udt(vector)["values"], F.lit(0.0), lambda acc, v: acc + v)
