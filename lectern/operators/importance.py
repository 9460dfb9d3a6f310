"""Concentration and agreement of feature importances.

Input rows are (model, idx, importance).  Totals, sums of squares and the
largest shares are partial sums and a top-k; ranks and running sums are taken over
ranges of a model.  No task holds a whole one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.ranking import numbered, top_k
from lectern.plans.storage import materialize


def normalize_importances(importances: DataFrame) -> DataFrame:
    """Adds ``p``: the share of the model's total; unchanged if that is not positive."""
    totals = importances.groupBy("model").agg(F.sum("importance").alias("_total"))
    total = F.col("_total")
    share = F.when(total > 0, F.col("importance") / total).otherwise(F.col("importance"))
    return importances.join(totals, "model").withColumn("p", share).drop("_total")


def cumulative_importance(importances: DataFrame) -> DataFrame:
    """Adds rank by falling share and the running sum up to it."""
    shares = normalize_importances(importances)
    return numbered(shares, [F.desc("p"), "idx"], ["model"], "p").withColumnRenamed("running", "cumulative")


def importance_concentration(importances: DataFrame, k: int = 50) -> DataFrame:
    """Per model: sum of squared shares, effective number of features, and the
    share of the k most important ones."""
    shares = normalize_importances(importances).select("model", "idx", "p")
    first = top_k(shares, [F.desc("p"), "idx"], k, by=["model"])
    hhi = F.sum(F.col("p") * F.col("p"))
    spread = shares.groupBy("model").agg(hhi.alias("hhi"), F.when(hhi > 0, 1.0 / hhi).alias("n_eff"))
    return spread.join(first.groupBy("model").agg(F.sum("p").alias("top_share")), "model")


def importance_spearman(importances: DataFrame, first: str, second: str) -> DataFrame:
    """Rank correlation of two models, ties ranked by index; NaN without variance."""
    chosen = importances.filter(F.col("model").isin(first, second))
    ranked = materialize(numbered(chosen, ["importance", "idx"], ["model"]), "ranks")
    a = ranked.filter(F.col("model") == first).select("idx", F.col("rank").alias("a"))
    b = ranked.filter(F.col("model") == second).select("idx", F.col("rank").alias("b"))
    joined = a.join(b, "idx").agg(
        F.count(F.lit(1)).alias("n_features"), F.corr("a", "b").alias("r")
    )
    return joined.select(
        F.lit(first).alias("model_a"),
        F.lit(second).alias("model_b"),
        "n_features",
        F.coalesce("r", F.lit(float("nan"))).alias("spearman"),
    )
