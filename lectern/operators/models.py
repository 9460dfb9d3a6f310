"""Training, comparison and batch scoring of the four classifiers."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.evaluate import classification_metrics
from lectern.operators.features import FeatureSpec, Vocabulary, hashing_stages
from lectern.operators.ranking import top_k

ESTIMATORS = {
    "logreg": LogisticRegression,
    "linearsvc": LinearSVC,
    "randomforest": RandomForestClassifier,
    "gbt": GBTClassifier,
}
LINEAR_MODELS = ("logreg", "linearsvc")

# Fewer rows than this are not worth a task of their own in each iteration.
LINEAR_ROWS_PER_TASK = 5000

# Trees keep a bin, four bytes, for every feature of every row.  A task of theirs
# holds and reads no more of these than this.
TREE_MODELS = ("randomforest", "gbt")
TREE_BYTES_PER_TASK = 64 << 20


@dataclass(frozen=True)
class ModelSpec:
    name: str
    params: Mapping[str, object] = field(default_factory=dict)

    def estimator(self, features_col: str = "features", label_col: str = "label"):
        if self.name not in ESTIMATORS:
            raise ValueError(f"unknown model {self.name!r}; known: {sorted(ESTIMATORS)}")
        return ESTIMATORS[self.name](
            featuresCol=features_col, labelCol=label_col, **dict(self.params)
        )


@dataclass(frozen=True)
class Trained:
    spec: ModelSpec
    model: Model
    predictions: DataFrame
    train_seconds: float
    fit_rows: DataFrame | None = None  # scored like the predictions

    @property
    def name(self) -> str:
        return self.spec.name


def check_specs(specs: Sequence[ModelSpec]) -> None:
    """Reject unknown names before anything is trained."""
    unknown = sorted({s.name for s in specs} - set(ESTIMATORS))
    if unknown:
        raise ValueError(f"unknown models {unknown}; known: {sorted(ESTIMATORS)}")


def as_training_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Only what the estimators read, the label as double."""
    return df.select(*keep, F.col("label").cast("double").alias("label"), "features")


def _sized_tasks(train: DataFrame, spec: ModelSpec, n_rows: int | None = None) -> DataFrame:
    """Training rows in tasks that suit the model.

    Every iteration of a linear model is a job whose tasks cost some milliseconds
    each, whatever they do: partitions of a small training set are merged.  Trees hold
    a dense row of bins per document, many times its sparse vector in a file: they
    get more partitions than the files have, by rows times features.
    """
    if spec.name in TREE_MODELS:
        first = train.select("features").first()
        n_rows = train.count() if n_rows is None else n_rows
        nbytes = 4 * first["features"].size * n_rows if first else 0
        tasks = -(-nbytes // TREE_BYTES_PER_TASK)
        return train.repartition(tasks) if tasks > train.rdd.getNumPartitions() else train
    if n_rows is None or spec.name not in LINEAR_MODELS:
        return train
    tasks = max(1, -(-n_rows // LINEAR_ROWS_PER_TASK))
    return train.coalesce(tasks)


def fit_models(
    train: DataFrame, test: DataFrame, specs: Sequence[ModelSpec], n_rows: int | None = None
) -> list[Trained]:
    """Fit each spec on ``train`` and attach lazy predictions for ``test``, with
    ``score`` as the raw value of class 1.

    Each estimator caches its own blocks or tree points while it iterates, so
    pass tables that are cheap to read once (written features), not cached ones.
    Fits run one after the other: each already uses every executor.  ``n_rows``,
    if known, sizes the tasks.
    """
    check_specs(specs)
    results = []
    for spec in specs:
        began = time.perf_counter()
        model = spec.estimator().fit(_sized_tasks(train, spec, n_rows))
        seconds = time.perf_counter() - began
        results.append(Trained(spec, model, _scored(model, test), seconds, _scored(model, train)))
    return results


def _scored(model: Model, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("score", vector_to_array("rawPrediction")[1])


def fit_grid(
    train: DataFrame, test: DataFrame, spec: ModelSpec, grid: Sequence[Mapping[str, object]]
) -> dict[str, Trained]:
    """Fit one kind of model under each set of parameters of ``grid``, over those of
    ``spec``: name of the set -> trained.

    All fits read the same written features.  Sets that repeat are fitted once.
    """
    check_specs([spec])
    sets = {grid_name(spec.name, params): dict(params) for params in grid}
    estimator = spec.estimator()
    unknown = sorted({p for params in sets.values() for p in params if not estimator.hasParam(p)})
    if unknown:
        raise ValueError(f"{spec.name} has no parameters {unknown}")
    maps = [{estimator.getParam(p): value for p, value in params.items()} for params in sets.values()]
    found: dict[str, Trained] = {}
    began = time.perf_counter()
    names = list(sets)
    for i, model in estimator.fitMultiple(_sized_tasks(train, spec), maps):
        seconds, began = time.perf_counter() - began, time.perf_counter()
        own = ModelSpec(spec.name, {**spec.params, **sets[names[i]]})
        found[names[i]] = Trained(own, model, _scored(model, test), seconds, _scored(model, train))
    return {name: found[name] for name in names}


def grid_name(model: str, params: Mapping[str, object]) -> str:
    return f"{model}({', '.join(f'{p}={params[p]}' for p in sorted(params))})"


def grid_table(grid: Mapping[str, Trained], test_rows: DataFrame, metric: str = "f1") -> DataFrame:
    """Metrics of every set of parameters from one aggregation over one scan of the test
    rows, which pass through the models side by side; ``best`` marks the largest
    ``metric``, the first of the grid on ties."""
    cells = test_rows
    for i, trained in enumerate(grid.values()):
        own = {"predictionCol": f"_p{i}", "rawPredictionCol": f"_raw{i}"}
        if trained.model.hasParam("probabilityCol"):
            own["probabilityCol"] = f"_prob{i}"
        model = trained.model.copy({trained.model.getParam(p): v for p, v in own.items()})
        cells = model.transform(cells)
    sets = F.array(
        *(F.struct(F.lit(name).alias("model"), F.col(f"_p{i}").alias("prediction")) for i, name in enumerate(grid))
    )
    table = classification_metrics(cells.select("label", F.inline(sets)), "model")
    place = F.element_at(F.create_map(*(x for i, name in enumerate(grid) for x in (F.lit(name), F.lit(i)))), F.col("model"))
    first = table.agg(F.max(F.struct(F.col(metric), (-place).alias("place"))).alias("best")).first()["best"]
    best = list(grid)[-first["place"]] if first else None
    return table.withColumn("best", F.col("model") == F.lit(best))


def _by_model(parts: dict[str, DataFrame], *columns: str) -> DataFrame:
    named = [df.select(F.lit(name).alias("model"), *columns) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, named)


def score_margins(trained: Sequence[Trained]) -> DataFrame:
    """Per model, how far the mean score of class 1 lies above that of class 0 on
    the rows it was fitted on; null if one class is absent."""
    rows = _by_model({t.name: t.fit_rows for t in trained}, "label", "score")
    mean = lambda label: F.avg(F.when(F.col("label") == label, F.col("score")))
    return rows.groupBy("model").agg((mean(1) - mean(0)).alias("margin"))


def comparison_table(trained: Sequence[Trained]) -> DataFrame:
    """One row per model: training time and metrics, one scan of the test rows
    per model and one shuffle for all of them."""
    union = _by_model({t.name: t.predictions for t in trained}, "label", "prediction")
    seconds = F.create_map(
        *(c for t in trained for c in (F.lit(t.name), F.lit(float(t.train_seconds))))
    )
    return classification_metrics(union, "model").withColumn(
        "train_seconds", F.element_at(seconds, F.col("model"))
    )


def timed_metrics(trained: Trained) -> dict:
    """Metrics of one model as a dict, with the time to score and count.

    The clock covers the aggregation that uses the predictions; a bare count
    would let Catalyst drop the model from the plan.
    """
    began = time.perf_counter()
    row = classification_metrics(trained.predictions).first().asDict()
    row["score_seconds"] = time.perf_counter() - began
    row["train_seconds"] = trained.train_seconds
    return {"model": trained.name, **row}


def hashing_model(
    spec: ModelSpec, features: FeatureSpec = FeatureSpec(binary_tf=False), num_features: int = 1 << 16
) -> Pipeline:
    """Tokens, hashed counts and a classifier as one estimator."""
    return Pipeline(stages=hashing_stages(features, num_features) + [spec.estimator()])


def batch_score(model: PipelineModel | Model, df: DataFrame, *keep: str) -> DataFrame:
    """Apply a fitted model: narrow, reads the kept columns and the text only."""
    scored = model.transform(df)
    extra = [F.col("prediction")]
    if "probability" in scored.columns:
        extra.insert(0, vector_to_array("probability")[1].alias("probability"))
    return scored.select(*keep, *extra)


def linear_weights(model: Model, name: str, vocabulary: Vocabulary) -> DataFrame:
    """Coefficients by vocabulary index.  Row idx -1 holds the intercept."""
    if not (hasattr(model, "coefficients") and hasattr(model, "intercept")):
        raise ValueError(f"{type(model).__name__} has no coefficients")
    values = [(-1, float(model.intercept))]
    values += [(i, float(c)) for i, c in enumerate(model.coefficients.toArray())]
    spark = vocabulary.table.sparkSession
    table = spark.createDataFrame(values, "idx int, coefficient double")
    return table.join(vocabulary.table.select("idx", "word"), "idx", "left").select(
        F.lit(name).alias("model"), "idx", "word", "coefficient"
    )


def tree_importances(model: Model, name: str, vocabulary: Vocabulary) -> DataFrame:
    """Importance of every vocabulary index; zero where no tree splits on it."""
    if not hasattr(model, "featureImportances"):
        raise ValueError(f"{type(model).__name__} has no feature importances")
    found = model.featureImportances
    pairs = [(int(i), float(v)) for i, v in zip(found.indices, found.values)]
    spark = vocabulary.table.sparkSession
    nonzero = spark.createDataFrame(pairs, "idx int, importance double")
    return vocabulary.table.select("idx", "word").join(nonzero, "idx", "left").select(
        F.lit(name).alias("model"),
        "idx",
        "word",
        F.coalesce("importance", F.lit(0.0)).alias("importance"),
    )


def model_params(spark: SparkSession, model: Model, name: str) -> DataFrame:
    """The parameters set on a model, as one row with a map of strings."""
    known = {p.name: str(model.getOrDefault(p)) for p in model.params if model.isDefined(p)}
    return spark.createDataFrame([(name, known)], "model string, params map<string,string>")


def prediction_sample(predictions: DataFrame, k: int = 200, key: str = "id") -> DataFrame:
    """The first k predictions by key, as text, label and whole-number prediction.

    The keys are ranked alone; texts are read and scored for the chosen ones only.
    """
    first = top_k(predictions.select(key), [key], k).select(key).distinct()
    chosen = predictions.join(F.broadcast(first), key, "left_semi")  # k keys
    return top_k(chosen, [key], k).select(
        key,
        "text",
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
    )
