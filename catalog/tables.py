"""The test tables seen as a labelled corpus."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import clean as cl
from lectern.operators import sampling as sm
from lectern.operators.features import FeatureSpec, FittedFeatures, fit_features, term_entries
from lectern.operators.scoring import LinearScorer
from lectern.operators.trees import Ensemble, node_id, walk
from lectern.plans.storage import materialize, spread
from lectern.sources.schema import normalize_schema

CHECK_SPEC = FeatureSpec(vocab_size=2000, min_df=5, binary_tf=True)
COUNT_SPEC = FeatureSpec(vocab_size=2000, min_df=5, binary_tf=False)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as id, title (first line), text, subject; the scan alone."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        "text",
        F.col("source").alias("subject"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("label")
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents in the corpus schema.

    The label table grows with the documents, so the join is left to the
    optimizer; when it shuffles, the result lies by id and the de-duplication
    after it moves no text again.
    """
    return normalize_schema(spread(documents(spark, sf_dir)).join(labels(spark, sf_dir), "id"))


def class_sources(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """The labelled documents as two sources without a label, one per class."""
    docs, marks = documents(spark, sf_dir), labels(spark, sf_dir)
    return {
        value: docs.join(marks.filter(F.col("label") == value), "id", "left_semi")
        for value in (1, 0)
    }


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).join(labels(spark, sf_dir), "id", "left_anti")


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents, cleaned and de-duplicated.

    Hashes are taken before the label join, so that only one of the two reads of
    the documents carries texts through a shuffle.
    """
    keys = cl.content_keys(cl.clean_text(spread(documents(spark, sf_dir))))
    keys = keys.join(labels(spark, sf_dir), "id", "left_semi")
    return cl.clean_and_dedup(corpus(spark, sf_dir), keys=keys)


@dataclass(frozen=True)
class Demo:
    """A linear model that SQL can repeat: smoothed log odds of the words."""

    docs: DataFrame  # prepared documents with their split
    fitted: FittedFeatures
    weights: DataFrame
    intercept: float

    def scorer(self, logistic: bool) -> LinearScorer:
        vocabulary = self.fitted.vocabulary
        return LinearScorer.build(
            vocabulary.table, self.weights, self.intercept, self.fitted.spec, logistic,
            size=vocabulary.size,
        )

    def importances(self) -> DataFrame:
        """Two importance columns over the vocabulary, as two models."""
        vocabulary = self.fitted.vocabulary.table
        a = self.weights.select(
            F.lit("log_odds").alias("model"), "idx",
            F.round(F.abs("coefficient"), 9).alias("importance"),
        )
        b = vocabulary.select(
            F.lit("idf_mass").alias("model"), "idx",
            F.round(F.col("doc_freq") * F.col("idf"), 9).alias("importance"),
        )
        return a.unionByName(b)


DEMO_TREES = 20


def demo_trees(spark: SparkSession, sf_dir: str) -> tuple[FittedFeatures, Ensemble]:
    """Trees that SQL can repeat: each asks for one word, then for one of two others.

    Tree t splits on the words 3t, 3t + 1 (where the first is absent) and 3t + 2; a leaf
    votes by the smoothed class shares of the training rows that reach it.
    """
    docs, fitted = fit_train(spark, sf_dir)
    # Numbers of the nodes: a root 0, its children 1 and 4, and two leaves below each.
    tree, place = F.floor(F.col("idx") / 3).cast("int"), F.pmod("idx", F.lit(3))
    number = F.when(place == 0, 0).when(place == 1, 1).otherwise(4)
    right = F.when(place == 0, 4).otherwise(number + 2)
    whole = fitted.vocabulary.table.filter(F.col("idx") < 3 * DEMO_TREES)
    splits = whole.select(
        tree.alias("tree"), node_id(tree, number).alias("node"), "idx", F.lit(0.0).alias("threshold"),
        node_id(tree, number + 1).alias("left"), node_id(tree, right).alias("right"),
    )
    leaves = splits.filter(F.pmod("idx", F.lit(3)) > 0).select("tree", F.explode(F.array("left", "right")).alias("node"))

    def table(for_0, for_1, rows):
        return rows.select(
            "*", for_0.alias("for_0"), for_1.alias("for_1"), F.lit(2).alias("levels"), F.lit(False).alias("boosted")
        )

    none = F.lit(None).cast("double")
    grown = table(none, none, splits)
    bare = materialize(grown.unionByName(table(F.lit(0.5), F.lit(0.5), leaves), allowMissingColumns=True), "nodes")
    train = fitted.transform(docs.filter(F.col("split") == "train"))
    reached = walk(train, Ensemble.build(bare), "label", "id")
    held = reached.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("real"))
    n, real = (F.coalesce(F.col(c), F.lit(0)) for c in ("n", "real"))
    voting = leaves.join(held, "node", "left").select("tree", "node", n.alias("n"), real.alias("real"))
    share = (F.col("real") + 1.0) / (F.col("n") + 2.0)
    voting = table(1.0 - share, share, voting).drop("n", "real")
    return fitted, Ensemble.build(materialize(grown.unionByName(voting, allowMissingColumns=True), "nodes"))


def split_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(sm.assign_split(prepared(spark, sf_dir)), "documents")


def fit_train(spark: SparkSession, sf_dir: str, spec: FeatureSpec = CHECK_SPEC):
    """(prepared documents with split, features fitted on the train rows)."""
    docs = split_docs(spark, sf_dir)
    return docs, fit_features(docs.filter(F.col("split") == "train"), spec)


def demo_model(spark: SparkSession, sf_dir: str, spec: FeatureSpec = CHECK_SPEC) -> Demo:
    docs, fitted = fit_train(spark, sf_dir, spec)
    train = docs.filter(F.col("split") == "train")
    n = train.agg(
        F.count_if(F.col("label") == 1).alias("real"), F.count_if(F.col("label") == 0).alias("fake")
    ).first()
    per_word = (
        term_entries(train, fitted.vocabulary, spec, "label")
        .groupBy("idx")
        .agg(
            F.count_if(F.col("label") == 1).alias("real"),
            F.count_if(F.col("label") == 0).alias("fake"),
        )
    )
    odds = F.log((F.col("real") + 1.0) / (n["real"] + 2.0)) - F.log(
        (F.col("fake") + 1.0) / (n["fake"] + 2.0)
    )
    weights = materialize(
        per_word.select("idx", F.round(0.1 * odds, 9).alias("coefficient")), "weights"
    )
    intercept = round(math.log((n["real"] + 1.0) / (n["fake"] + 1.0)), 9)
    return Demo(docs, fitted, weights, intercept)
