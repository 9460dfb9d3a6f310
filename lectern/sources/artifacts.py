"""Readers of feature and model artefacts: own tables and JSON documents."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.features import FeatureSpec, FittedFeatures, Vocabulary, with_stages
from lectern.operators.scoring import LinearScorer, require_consistent
from lectern.operators.trees import Ensemble
from lectern.plans.storage import materialize, measure_lookup


def _document(spark: SparkSession, path: str) -> DataFrame:
    """Each file under ``path`` as one string; artefacts are vocabulary-sized."""
    return spark.read.text(path, wholetext=True)


def _indexed(values: Column, name: str) -> Column:
    return F.transform(values, lambda v, i: F.struct(i.alias("idx"), v.alias(name)))


def import_vocabulary_json(spark: SparkSession, path: str) -> DataFrame:
    """(idx, word) from a JSON array of words, from word -> index, or from
    index -> word.  Any other document raises when the result is evaluated."""
    doc = F.col("value")
    as_list = F.from_json(doc, "array<string>")
    word_to_idx = F.from_json(doc, "map<string,int>")
    idx_to_word = F.from_json(doc, "map<string,string>")
    entries_a = F.transform(
        F.map_entries(word_to_idx),
        lambda e: F.struct(e["value"].alias("idx"), e["key"].alias("word")),
    )
    entries_b = F.transform(
        F.map_entries(idx_to_word),
        lambda e: F.struct(e["key"].cast("int").alias("idx"), e["value"].alias("word")),
    )
    # Indices are JSON numbers in one layout and strings of digits in the other;
    # a map of ints reads only the former.
    numbers = F.size(F.map_keys(word_to_idx)) > 0
    numbers = numbers & F.forall(F.map_values(word_to_idx), lambda v: v.isNotNull())
    digits = F.size(F.map_keys(idx_to_word)) > 0
    digits = digits & F.forall(F.map_keys(idx_to_word), lambda k: k.rlike("^[0-9]+$"))
    entries = (
        F.when(F.ltrim(doc).startswith("["), _indexed(as_list, "word"))
        .when(numbers, entries_a)
        .when(digits, entries_b)
        .otherwise(
            F.raise_error(F.lit("vocabulary must be a list of words or a map of words and indices"))
        )
    )
    return _document(spark, path).select(F.inline(entries))


def import_idf_json(spark: SparkSession, path: str) -> DataFrame:
    values = F.from_json(F.col("value"), "array<double>")
    return _document(spark, path).select(F.inline(_indexed(values, "idf")))


def import_feature_tables(spark: SparkSession, vocabulary_path: str, idf_path: str) -> DataFrame:
    """(idx, word, idf); an index known to one file only keeps a null, which
    ``require_consistent`` reports."""
    words = import_vocabulary_json(spark, vocabulary_path)
    return words.join(import_idf_json(spark, idf_path), "idx", "full_outer")


def import_weights_json(spark: SparkSession, path: str) -> tuple[DataFrame, float]:
    """(model, idx, coefficient) and the intercept of a linear model's JSON."""
    schema = "model string, coefficients array<double>, intercept double"
    doc = _document(spark, path).select(F.from_json("value", schema).alias("d")).select("d.*")
    head = doc.select("intercept", F.col("coefficients").isNotNull().alias("ok")).first()
    if head is None or head["intercept"] is None or not head["ok"]:
        raise ValueError(f"{path} lacks coefficients or intercept")
    table = doc.select("model", F.inline(_indexed(F.col("coefficients"), "coefficient")))
    return table, float(head["intercept"])


def import_importances_json(spark: SparkSession, path: str) -> DataFrame:
    """(model, idx, importance) of a tree model's JSON."""
    schema = "model string, feature_importances array<double>"
    doc = _document(spark, path).select(F.from_json("value", schema).alias("d")).select("d.*")
    return doc.select("model", F.inline(_indexed(F.col("feature_importances"), "importance")))


def load_stages(spark: SparkSession, folder: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/stages")


def load_spec(spark: SparkSession, folder: str) -> FeatureSpec:
    """The saved settings, so that scoring tokenises and counts as training did."""
    meta = spark.read.json(f"{folder}/meta").first().asDict()
    names = (
        "pattern", "min_token_length", "vocab_size", "min_df", "binary_tf", "input_col", "output_col",
    )
    return replace(FeatureSpec(), **{n: meta[n] for n in names})


def load_spec_json(spark: SparkSession, path: str) -> FeatureSpec:
    """Settings from a JSON document.  Without ``binary_tf`` terms are counted;
    other settings it lacks keep their defaults."""
    default = FeatureSpec()
    schema = (
        "min_df double, vocab_size int, binary_tf boolean, pattern string, "
        "min_token_length int, text_col string"
    )
    head = _document(spark, path).select(F.from_json("value", schema).alias("d")).select("d.*").first()
    meta = {k: v for k, v in (head.asDict() if head else {}).items() if v is not None}
    meta["input_col"] = meta.pop("text_col", default.input_col)
    return replace(default, **({"binary_tf": False} | meta))


def load_scorer_json(
    spark: SparkSession, folder: str, model: str, threshold: float | None = None
) -> LinearScorer:
    """A linear model from a folder of JSON documents, after checking that they match.

    ``feature_artifacts`` holds vocabulary, idf values and settings,
    ``model_weights`` the coefficients.  The tables are written first, as every
    reading of them would parse the documents again.
    """
    features = f"{folder}/feature_artifacts"
    vocabulary = import_feature_tables(
        spark, f"{features}/cv_vocabulary.json", f"{features}/idf_values.json"
    )
    weights, intercept = import_weights_json(spark, f"{folder}/model_weights/{model}_weights.json")
    vocabulary, weights = materialize(vocabulary, "vocabulary"), materialize(weights, "weights")
    require_consistent(vocabulary, weights)
    spec = load_spec_json(spark, f"{features}/features_meta.json")
    return LinearScorer.build(vocabulary, weights, intercept, spec, model == "logreg", threshold)


def load_scorer(
    spark: SparkSession,
    features_folder: str,
    weights_path: str,
    logistic: bool,
    threshold: float | None = None,
) -> LinearScorer:
    """A linear model from saved tables, after checking that they match."""
    vocabulary = spark.read.parquet(f"{features_folder}/vocabulary")
    weights = spark.read.parquet(weights_path)
    intercept = weights.filter(F.col("idx") == -1).first()
    if intercept is None:
        raise ValueError(f"{weights_path} lacks an intercept")
    weights = weights.filter(F.col("idx") >= 0)
    require_consistent(vocabulary, weights)
    return LinearScorer.build(
        vocabulary, weights, float(intercept["coefficient"]), load_spec(spark, features_folder),
        logistic, threshold,
    )


def load_features(spark: SparkSession, folder: str) -> FittedFeatures:
    """Saved features: the vocabulary table and the settings, whatever its size."""
    table = spark.read.parquet(f"{folder}/vocabulary")
    n_docs = spark.read.json(f"{folder}/meta").first()["n_docs"]
    return with_stages(load_spec(spark, folder), Vocabulary(table, n_docs, measure_lookup(table, "word")))


def load_ensemble(spark: SparkSession, path: str) -> Ensemble:
    """A saved node table, measured and checked."""
    return Ensemble.build(spark.read.parquet(path))
