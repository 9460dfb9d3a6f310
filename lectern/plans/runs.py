"""Whole runs: from a labelled corpus to trained models, reports and artefacts."""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import clean as cl
from lectern.operators import evaluate as ev
from lectern.operators import models as md
from lectern.operators import sampling as sm
from lectern.operators.explore import require_both_classes
from lectern.operators.features import FeatureSpec, FittedFeatures, fit_features
from lectern.operators.scoring import score_texts
from lectern.operators.trees import node_table, score_by_trees
from lectern.plans import presets as ps
from lectern.plans.storage import materialize
from lectern.sources import sinks
from lectern.sources.artifacts import load_ensemble, load_features, load_scorer
from lectern.sources.readers import load_corpus
from lectern.sources.schema import drop_invalid


# Settings that a run report repeats.
REPORTED_CONF = (
    "spark.master",
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.coalescePartitions.enabled",
    "spark.serializer",
)


@dataclass
class Run:
    """What a run leaves behind: tables and models, all lazy or written."""

    features: FittedFeatures
    documents: DataFrame
    trained: list[md.Trained]
    seconds: dict[str, float] = field(default_factory=dict)
    dataset: dict = field(default_factory=dict)

    @cached_property
    def metrics(self) -> list[dict]:
        """Metrics of every model on the test rows, scored when first asked for."""
        with _timed(self.seconds, "evaluate"):
            return [md.timed_metrics(t) for t in self.trained]


@contextmanager
def _timed(seconds: dict[str, float], stage: str):
    began = time.perf_counter()
    yield
    seconds[stage] = round(time.perf_counter() - began, 3)


def prepare(corpus: DataFrame, preset: ps.Preset, key: str | None = "id") -> DataFrame:
    """Clean, de-duplicate and split a corpus, then sample its training rows.

    Without a key column (``key=None``) the content hash of each text becomes its
    ``id``: stable, and unique after de-duplication.  Copies that are kept share
    an id, hence a side of the split.  All test rows stay.
    """
    docs = drop_invalid(corpus)
    if preset.clean and key is None:
        docs = cl.dedup_text(cl.clean_text(docs, preset.min_text_length), None)
    elif preset.clean:
        docs = cl.clean_and_dedup(docs, preset.min_text_length, key)
    docs = docs.withColumn("id", tx.content_hash(F.col("text")) if key is None else F.col(key))
    return _sampled(sm.assign_split(docs, seed=preset.seed), preset)


def _sampled(docs: DataFrame, preset: ps.Preset) -> DataFrame:
    """All test rows, and those of the training rows that the preset takes."""
    if not _samples(preset):
        return docs
    # The split looks at the same draw, so the sample takes another.
    fit, draw = docs.filter(F.col("split") == "train"), preset.seed + 1
    if preset.sample_fraction is not None:
        fit = sm.sample_rows(fit, preset.sample_fraction, draw)
    if preset.sample_rows is not None:
        fit = sm.random_rows(fit, preset.sample_rows, draw)
    return fit.unionByName(docs.filter(F.col("split") != "train"))


def _samples(preset: ps.Preset) -> bool:
    return preset.sample_fraction is not None or preset.sample_rows is not None


def exploration_frame(spark: SparkSession, folder: str, key: str | None = None) -> DataFrame:
    """Loaded, labelled, cleaned and de-duplicated corpus of a dataset folder.
    Persist it yourself if several queries follow."""
    return cl.dedup_text(cl.clean_text(load_corpus(spark, folder)), key)


def train(
    corpus: DataFrame, preset: ps.Preset, key: str | None = "id", account: bool = False
) -> Run:
    """Prepare, fit the features on the training rows only, fit the models.

    Two tables are written on the way, the prepared documents and their features
    (by split).  Each is read a fixed number of times, and losing executors
    costs the tasks they ran, not the plan before them.

    The rows of both splits are counted per label.  ``account`` adds the rows
    before and after cleaning: a count of the source, and one of the cleaned documents
    as they were written, so that no text is cleaned twice.  A preset that samples has
    them written before the sample is drawn, which reads them more than once.
    Documents are numbered when written (``_row``), so that rows of one id stay apart.
    """
    md.check_specs(preset.models)
    seconds: dict[str, float] = {}
    with _timed(seconds, "clean"):
        whole = replace(preset, sample_fraction=None, sample_rows=None)
        docs = cleaned = prepare(corpus, whole, key)
        if _samples(preset):
            cleaned = materialize(docs, "cleaned")
            docs = _sampled(cleaned, preset)
        docs = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "documents")
        train_docs = require_both_classes(docs.filter(F.col("split") == "train"))
    with _timed(seconds, "features"):
        fitted = fit_features(train_docs, preset.features)
        rows = md.as_training_rows(fitted.transform(docs), "id", "_row", "split")
        rows = materialize(rows, "features", ["split"])
    parts = {s: rows.filter(F.col("split") == s).drop("split") for s in ("train", "test")}
    with _timed(seconds, "train"):
        trained = md.fit_models(
            parts["train"].drop("id", "_row"), parts["test"], preset.models, fitted.vocabulary.n_docs
        )
    run = Run(fitted, docs, trained, seconds, split_counts(docs))
    if account:
        run.dataset["rows_before"] = corpus.count()
    if account and preset.clean:
        after = (cleaned if _samples(preset) else docs).count()  # written: read from the footers
        before = run.dataset["rows_before"]
        run.dataset |= {
            "rows_after": after, "dropped": before - after,
            "min_text_length": preset.min_text_length, "dedup": True,
        }
    return run


def split_counts(docs: DataFrame) -> dict[str, int]:
    """Rows of each split and class of written documents, in one narrow job."""
    names = {"real": 1, "fake": 0}
    counts = [
        F.count_if((F.col("split") == split) & (F.col("label") == label)).alias(f"{split}_{name}")
        for split in ("train", "test")
        for name, label in names.items()
    ]
    return docs.agg(*counts).first().asDict()


def _with_text(run: Run, rows: DataFrame, *columns: str) -> DataFrame:
    """Attach texts to a few rows (a top-k) by their number."""
    texts = run.documents.select("_row", *columns)
    return texts.join(F.broadcast(rows), "_row").drop("_row")


def worst_errors(run: Run, model: md.Trained, k: int = 5) -> DataFrame:
    """False positives and negatives of a model with title and text; 2k rows."""
    rows = model.predictions.select("id", "_row", "label", "prediction", "score")
    return _with_text(run, ev.top_errors(rows, k), "title", "text")


def sample_predictions(run: Run, model: md.Trained, k: int = 200) -> DataFrame:
    first = sm.first_rows(model.predictions.select("id", "_row", "label", "prediction"), k)
    return md.prediction_sample(_with_text(run, first, "text"), k)


def new_run_id() -> str:
    """The time in UTC, which sorts by itself, and some letters that tell runs of one
    second apart."""
    return f"{time.strftime('%Y%m%dT%H%M%SZ', time.gmtime())}-{uuid.uuid4().hex[:6]}"


def save_run(run: Run, folder: str, run_id: str | None = None) -> dict:
    """Write every artefact and report of a run; returns the report.

    Artefacts are those of the latest run.  Reports stay: each run has a name of its own
    unless it is given one, and adds its rows to the tables ``comparisons`` and ``runs``
    (``read_reports``), where a run of the same name replaces only itself.
    """
    spark = run.documents.sparkSession
    run_id = run_id or new_run_id()
    sinks.save_features(run.features, f"{folder}/feature_artifacts")
    for model, row in zip(run.trained, run.metrics):
        name = model.name
        sinks.write_metrics(spark.createDataFrame([row]), folder, name)
        sinks.save_model(model.model, f"{folder}/models", name)
        if hasattr(model.model, "coefficients"):
            weights = md.linear_weights(model.model, name, run.features.vocabulary)
            sinks.save_weights(weights, f"{folder}/model_weights", name)
        else:
            importances = md.tree_importances(model.model, name, run.features.vocabulary)
            params = md.model_params(spark, model.model, name)
            sinks.save_importances(importances, params, f"{folder}/tree_artifacts", name)
            sinks.save_trees(node_table(model.model), f"{folder}/tree_artifacts", name)
            sample = sample_predictions(run, model)
            sinks.write_prediction_sample(sample, f"{folder}/predictions", name)
    fit_seconds = run.seconds.get("features", 0.0)
    rows = [{**row, "features_fit_seconds": fit_seconds} for row in run.metrics]
    comparison = spark.createDataFrame(rows)
    sinks.write_comparison(comparison, folder, run_id)
    sinks.record_report(comparison, f"{folder}/comparisons", run_id)
    report = {
        "run_id": run_id,
        "spark_conf": {name: spark.conf.get(name, None) for name in REPORTED_CONF},
        "dataset": run.dataset,
        "features": run.features.meta(),
        "times_sec": run.seconds,
        "params": {m.name: dict(m.spec.params) for m in run.trained},
        "models": {row["model"]: row for row in run.metrics},
    }
    sinks.write_run_report(spark, report, f"{folder}/run_report")
    rows = spark.createDataFrame([(json.dumps(report),)], "report string")
    sinks.record_report(rows, f"{folder}/runs", run_id)
    return report


def train_hashed(
    corpus: DataFrame,
    model: str,
    debug_rows: int | None = None,
    num_features: int = ps.HASHED_NUM_FEATURES,
    key: str | None = "id",
    seed: int = 42,
) -> tuple[PipelineModel, dict]:
    """One classifier on hashed counts, no idf: (fitted stages, report row).

    ``debug_rows`` bounds the rows it is fitted on.
    """
    spec = ps.HASHED_MODELS.get(model) or md.ModelSpec(model)
    md.check_specs([spec])
    shape = ps.Preset(
        features=FeatureSpec(), models=(spec,), clean=False,
        sample_rows=debug_rows, seed=seed,
    )
    docs = prepare(corpus, shape, key)
    docs = docs.withColumn("label", F.col("label").cast("double"))
    docs = materialize(docs.select("id", "text", "label", "split"), "documents")
    train_docs = docs.filter(F.col("split") == "train")
    began = time.perf_counter()
    fitted = md.hashing_model(spec, ps.HASHED_FEATURES, num_features).fit(train_docs)
    seconds = time.perf_counter() - began
    predictions = fitted.transform(docs.filter(F.col("split") == "test"))
    metrics = md.timed_metrics(md.Trained(spec, fitted, predictions, seconds))
    counts = split_counts(docs)
    return fitted, {**metrics, **counts, "debug_rows": debug_rows, "num_features": num_features}


def save_hashed(
    fitted: PipelineModel, report: dict, folder: str, run_id: str | None = None
) -> str:
    """Write the fitted stages and the report of a hashed run, under a name of its own."""
    name, run_id = report["model"], run_id or new_run_id()
    sinks.save_model(fitted, f"{folder}/models", f"{name}_hashed")
    spark = SparkSession.active()
    return sinks.write_run_report(spark, report, f"{folder}/{name}_{run_id}")


def score_saved(
    docs: DataFrame, folder: str, model: str, threshold: float | None = None, clean: bool = True
) -> DataFrame:
    """Score texts with a saved model, linear or of trees, prepared as the training
    texts were."""
    spark = docs.sparkSession
    if clean:
        docs = docs.withColumn("text", tx.clean_body(F.col("text")))
    if model not in md.LINEAR_MODELS:
        features = load_features(spark, f"{folder}/feature_artifacts")
        ensemble = load_ensemble(spark, f"{folder}/tree_artifacts/{model}_nodes")
        return score_by_trees(docs, features, ensemble, threshold)
    scorer = load_scorer(
        spark, f"{folder}/feature_artifacts", f"{folder}/model_weights/{model}_weights",
        logistic=(model == "logreg"), threshold=threshold,
    )
    return score_texts(docs, scorer)
