"""Scoring of texts by a linear model kept as tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import scores as sc
from lectern.functions import text as tx
from lectern.operators.features import FeatureSpec, token_stages
from lectern.plans.storage import LookupSize, lookup_join, materialize, measure_lookup

# Decision threshold of each kind of linear model.
LOGISTIC_THRESHOLD = 0.5
MARGIN_THRESHOLD = 0.0


@dataclass(frozen=True)
class LinearScorer:
    """A linear model as a table (idx, word, idf, coefficient) and an intercept."""

    table: DataFrame
    intercept: float
    spec: FeatureSpec
    logistic: bool
    size: LookupSize
    threshold: float

    @classmethod
    def build(
        cls,
        vocabulary: DataFrame,
        weights: DataFrame,
        intercept: float,
        spec: FeatureSpec,
        logistic: bool,
        threshold: float | None = None,
        size: LookupSize | None = None,
    ) -> LinearScorer:
        """Join two written artefact tables on idx and measure the result, unless
        the size of the vocabulary is known.  A word without a weight is an error
        when the model is used."""
        absent = F.raise_error(F.concat(F.lit("no weight for the word "), F.col("word")))
        table = (
            vocabulary.select("idx", "word", "idf")
            .join(weights.select("idx", "coefficient"), "idx", "left")
            .withColumn("coefficient", F.coalesce("coefficient", absent.cast("double")))
        )
        if threshold is None:
            threshold = LOGISTIC_THRESHOLD if logistic else MARGIN_THRESHOLD
        size = size or measure_lookup(table, "word")
        return cls(table, intercept, spec, logistic, size, threshold)


def _decided(docs: DataFrame, scorer: LinearScorer, margin: Column, *keep: str) -> DataFrame:
    scored = docs.select(*keep, margin.alias("score"))
    probability = sc.sigmoid(F.col("score")) if scorer.logistic else F.lit(None).cast("double")
    scored = scored.withColumn("probability", probability)
    judged = F.col("probability" if scorer.logistic else "score")
    return scored.withColumn("prediction", sc.decide(judged, scorer.threshold))


def score_texts(docs: DataFrame, scorer: LinearScorer) -> DataFrame:
    """Adds score, probability (logistic models only) and prediction.

    Whichever form the size of the model asks for, rows and columns are the same:
    every row is scored by its own text, whatever its id, and a null text scores
    the intercept.
    """
    return (score_texts_in_place if scorer.size.small else score_texts_by_join)(docs, scorer)


def score_texts_in_place(docs: DataFrame, scorer: LinearScorer) -> DataFrame:
    """Every task holds the model and the scan is scored in place: no shuffle,
    whole texts pass through, streams work too.  Refused beyond the lookup bounds, where
    ``score_texts`` joins instead."""
    if not scorer.size.small:
        raise ValueError(f"a model of {scorer.size.rows} words, {scorer.size.nbytes} bytes is scored by a join")
    rows = scorer.table.orderBy("idx").collect()
    if not rows:
        return _decided(docs, scorer, F.lit(float(scorer.intercept)), *docs.columns)
    per_word = [r["idf"] * r["coefficient"] for r in rows]
    text = F.coalesce(F.col(scorer.spec.input_col), F.lit(""))
    stages = token_stages(replace(scorer.spec, input_col="_text")) + [
        CountVectorizerModel.from_vocabulary(
            [r["word"] for r in rows], inputCol="filtered_tokens", outputCol="_tf"
        ).setBinary(scorer.spec.binary_tf),
        ElementwiseProduct(scalingVec=Vectors.dense(per_word), inputCol="_tf", outputCol="_parts"),
    ]
    weighted = PipelineModel(stages=stages).transform(docs.withColumn("_text", text))
    margin = F.lit(float(scorer.intercept)) + sc.vector_total(F.col("_parts"))
    return _decided(weighted, scorer, margin, *docs.columns)


def score_texts_by_join(docs: DataFrame, scorer: LinearScorer) -> DataFrame:
    """Scores from a join of tokens with the model, for a model of any size.

    The rows are written with a number of their own, so neither repeated nor null
    ids matter.  A token occurrence contributes idf times coefficient, so summing
    over occurrences needs no count per word; a binary model drops repetitions
    inside the document first.  A document's rows lie together, so the map-side
    partial sum leaves one short row per document; documents without a known word
    have none and score the intercept.
    """
    spec = scorer.spec
    numbered = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    tokens = tx.split_words(F.col(spec.input_col), spec.pattern)
    if spec.binary_tf:
        tokens = F.array_distinct(tokens)
    word = F.col("word")
    usable = tx.is_token(word, spec.min_token_length) & ~tx.is_stop_word(word, spec.stop_words)
    rows = numbered.select("_row", F.explode(tokens).alias("word")).filter(usable)
    weights = scorer.table.select("word", (F.col("idf") * F.col("coefficient")).alias("part"))
    matched = lookup_join(rows, weights, "word", scorer.size, spread_by=("_row",))
    margins = matched.groupBy("_row").agg(F.sum("part").alias("_margin"))
    margin = F.lit(float(scorer.intercept)) + F.coalesce(F.col("_margin"), F.lit(0.0))
    return _decided(numbered.join(margins, "_row", "left"), scorer, margin, *docs.columns)


def score_by_lookup(docs: DataFrame, scorer: LinearScorer) -> DataFrame:
    """id, score, probability, prediction by ``score_texts_by_join``."""
    scored = score_texts_by_join(docs.select("id", scorer.spec.input_col), scorer)
    return scored.select("id", "score", "probability", "prediction")


def check_artifacts(vocabulary: DataFrame, weights: DataFrame) -> DataFrame:
    """One row: table sizes, missing idf values, entries without a partner."""
    paired = vocabulary.select("idx", "word", "idf").join(
        weights.select(F.col("idx").alias("w_idx"), "coefficient"),
        F.col("idx") == F.col("w_idx"),
        "full_outer",
    )
    return paired.agg(
        F.count("idx").alias("n_vocabulary"),
        F.count("idf").alias("n_idf"),
        F.count("coefficient").alias("n_coefficients"),
        F.count_if(F.col("w_idx").isNull()).alias("words_without_weight"),
        F.count_if(F.col("idx").isNull()).alias("weights_without_word"),
    )


def require_consistent(vocabulary: DataFrame, weights: DataFrame) -> None:
    """Raise unless vocabulary, idf and coefficients cover the same indices."""
    row = check_artifacts(vocabulary, weights).first()
    sizes = {row["n_vocabulary"], row["n_idf"], row["n_coefficients"]}
    if len(sizes) > 1 or row["words_without_weight"] or row["weights_without_word"]:
        raise ValueError(f"artefact tables do not match: {row.asDict()}")
