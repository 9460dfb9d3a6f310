"""Tree ensembles as node tables, and texts scored by walking them.

A row per node: ``node`` (the tree in the upper 32 bits, the node's number in the
lower), ``idx`` and ``threshold`` with the children ``left`` and ``right`` of a split,
or what a leaf adds to the scores ``for_0`` and ``for_1``.  ``levels`` and ``boosted``
are the same in all rows, so that the table says by itself how it is used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import scores as sc
from lectern.operators.features import FittedFeatures
from lectern.plans.storage import LookupSize, fresh_path, lookup_join, materialize

NODE_COLUMNS = ("tree", "node", "idx", "threshold", "left", "right", "for_0", "for_1", "levels", "boosted")

# Bytes of a node in a join: eight fixed-width columns.
NODE_BYTES = 64


def node_id(tree: Column, number: Column) -> Column:
    """The number of a node among those of all trees; null where ``number`` is negative."""
    return F.when(number >= 0, F.shiftleft(tree.cast("bigint"), 32) + number)


def node_table(model: Model) -> DataFrame:
    """The nodes of a fitted binary forest or of boosted trees, as a written table.

    The model is saved and its node data read back, so nothing but the weight of each
    tree passes through the driver.
    """
    if not hasattr(model, "treeWeights"):
        raise ValueError(f"{type(model).__name__} has no trees")
    if model.numClasses != 2:
        raise ValueError(f"{model.numClasses} classes: only two are supported")
    spark = SparkSession.active()
    boosted = isinstance(model, GBTClassificationModel)
    path = fresh_path(spark, "tree-model")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    tree, split, stats = F.col("treeID"), F.col("split"), F.col("impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda acc, v: acc + v)
    weights = F.array(*(F.lit(float(w)) for w in model.treeWeights))
    vote = F.col("prediction") * F.get(weights, tree)
    leaf = F.col("leftChild") < 0
    # A category split would need a set of values where these have a threshold.
    categories = F.raise_error(F.lit("splits by category are not supported")).cast("double")
    threshold = F.when(split["numCategories"] < 0, split["leftCategoriesOrThreshold"][0]).otherwise(categories)
    share = {c: F.when(total > 0, F.get(stats, F.lit(c)) / total).otherwise(0.0) for c in (0, 1)}
    table = nodes.select(
        tree.alias("tree"),
        node_id(tree, F.col("id")).alias("node"),
        F.when(~leaf, split["featureIndex"]).alias("idx"),
        F.when(~leaf, threshold).alias("threshold"),
        node_id(tree, F.col("leftChild")).alias("left"),
        node_id(tree, F.col("rightChild")).alias("right"),
        F.when(leaf, -vote if boosted else share[0]).alias("for_0"),
        F.when(leaf, vote if boosted else share[1]).alias("for_1"),
        F.lit(max(t.depth for t in model.trees)).alias("levels"),
        F.lit(boosted).alias("boosted"),
    )
    return materialize(table, "nodes")


@dataclass(frozen=True)
class Ensemble:
    table: DataFrame  # NODE_COLUMNS, written
    n_trees: int
    levels: int
    boosted: bool
    size: LookupSize

    @classmethod
    def build(cls, table: DataFrame) -> Ensemble:
        """Measure a written node table, in one small job, and check that it is whole."""
        lost = F.count_if(F.col("idx").isNull() & F.col("for_1").isNull())
        row = table.agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("tree").alias("trees"),
            F.max("tree").alias("last"), F.max("levels").alias("levels"),
            F.max("boosted").alias("boosted"), F.min("boosted").alias("all_boosted"), lost.alias("lost"),
        ).first()
        whole = row["n"] and row["trees"] == row["last"] + 1 and not row["lost"]
        if not whole or row["boosted"] != row["all_boosted"]:
            raise ValueError(f"not the nodes of one ensemble: {row.asDict()}")
        size = LookupSize(row["n"], row["n"] * NODE_BYTES)
        return cls(table, row["trees"], row["levels"], row["boosted"], size)


def _value_at(vector: Column, idx: Column) -> Column:
    """A component of a sparse or dense vector; entries that are not stored are 0."""
    raw = F.unwrap_udt(vector)
    place = F.array_position(raw["indices"], idx).cast("int") - 1
    stored = F.when(raw["indices"].isNull(), F.get(raw["values"], idx)).otherwise(F.get(raw["values"], place))
    return F.coalesce(stored, F.lit(0.0))


def walk(rows: DataFrame, ensemble: Ensemble, *keep: str, features_col: str = "features") -> DataFrame:
    """(keep..., node): the leaf that each row reaches in each tree.

    One join with the splits per level.  While the node table is below the lookup
    bounds these are broadcast joins of one and the same table, and all levels run
    within the rows' own tasks.  Beyond, a level is a join spread over salts, since every
    row meets the root; ``keep`` then has to tell the rows apart.
    """
    roots = F.transform(F.sequence(F.lit(0), F.lit(ensemble.n_trees - 1)), lambda t: node_id(t, F.lit(0)))
    at = rows.select(*keep, F.col(features_col).alias("_vector"), F.explode(roots).alias("node"))
    splits = ensemble.table.filter(F.col("idx").isNotNull()).select("node", "idx", "threshold", "left", "right")
    goes_left = _value_at(F.col("_vector"), F.col("idx")) <= F.col("threshold")
    for _ in range(ensemble.levels):
        met = lookup_join(at, splits, "node", ensemble.size, "left", spread_by=keep)
        child = F.when(F.col("idx").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = met.select(*keep, "_vector", child.alias("node"))
        if not ensemble.size.small:
            at = materialize(at, "level")  # the next join reads it twice
    return at.select(*keep, "node")


def score_by_trees(
    docs: DataFrame, features: FittedFeatures, ensemble: Ensemble, threshold: float | None = None
) -> DataFrame:
    """Adds score, probability and prediction to ``docs``, as the model itself would.

    The score is the model's raw value of class 1: the votes of a forest, the margin of
    boosted trees.  Class 1 is predicted where it is above that of class 0, or where
    the probability reaches ``threshold``.  Rows are numbered and written first, so
    repeated and null ids do not matter; a null text is scored as an empty one.
    """
    text = features.spec.input_col
    numbered = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    rows = numbered.select("_row", F.coalesce(text, F.lit("")).alias(text))
    reached = walk(features.transform(rows), ensemble, "_row", features_col=features.spec.output_col)
    leaves = ensemble.table.filter(F.col("idx").isNull()).select("node", "for_0", "for_1")
    votes = lookup_join(reached, leaves, "node", ensemble.size, spread_by=("_row",))
    # The leaves of a row lie together: one short row for each is shuffled.
    sums = votes.groupBy("_row").agg(F.sum("for_0").alias("_for_0"), F.sum("for_1").alias("score"))
    against, score = F.col("_for_0"), F.col("score")
    probability = sc.sigmoid(2.0 * score) if ensemble.boosted else score / (score + against)
    scored = numbered.join(sums, "_row").withColumn("probability", probability)
    above = (score > against).cast("double")
    decided = above if threshold is None else sc.decide(F.col("probability"), threshold)
    return scored.select(*docs.columns, "score", "probability", decided.alias("prediction"))
