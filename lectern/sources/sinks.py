"""Sinks: metrics, reports, predictions, feature and model artefacts.

Small report frames are written as one file; predictions keep the partitioning
of their input.
"""

from __future__ import annotations

import json

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.features import FittedFeatures, Vocabulary

# Column order of the model comparison report.
COMPARISON_COLUMNS = (
    "model", "features_fit_seconds", "train_seconds", "score_seconds",
    "accuracy", "f1", "precision", "recall", "tp", "tn", "fp", "fn",
)


def write_report_rows(rows: DataFrame, path: str) -> str:
    """A handful of rows as one JSON-lines file."""
    rows.coalesce(1).write.mode("overwrite").json(path)
    return path


def save_by_key(df: DataFrame, table: str, buckets: int, key: str = "id") -> str:
    """A table bucketed and sorted by its key.  Joins and de-duplication by the
    key then move none of its rows."""
    df.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)
    return table


def write_metrics(metrics: DataFrame, folder: str, model: str) -> str:
    """Metrics of one model, with the four counts also as a nested struct."""
    cells = F.struct("tp", "tn", "fp", "fn").alias("confusion_matrix")
    names = ("accuracy", "precision", "recall", "f1")
    return write_report_rows(metrics.select(*names, cells, "total"), f"{folder}/metrics_{model}")


def write_comparison(rows: DataFrame, folder: str, run_id: str) -> tuple[str, str]:
    """The model comparison as JSON and as CSV, under one run id."""
    table = rows.select(*(c for c in COMPARISON_COLUMNS if c in rows.columns)).coalesce(1)
    json_path, csv_path = (f"{folder}/model_comparison_{run_id}_{f}" for f in ("json", "csv"))
    table.write.mode("overwrite").json(json_path)
    table.write.mode("overwrite").csv(csv_path, header=True)
    return json_path, csv_path


def record_report(rows: DataFrame, folder: str, run_id: str) -> str:
    """Add the rows of a run to a table of reports, partitioned by run.

    A run that is recorded again replaces its own rows and no others.  Fields may differ
    between runs: rows are JSON, and a reader sees null where a run has none.
    """
    rows = rows.drop("run_id").withColumn("run_id", F.lit(run_id)).coalesce(1)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id").json(folder)
    return folder


def write_run_report(spark: SparkSession, report: dict, path: str) -> str:
    """A nested report as one JSON document."""
    line = spark.createDataFrame([(json.dumps(report),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(path)
    return path


def write_predictions_csv(predictions: DataFrame, path: str, logistic: bool) -> str:
    """id, text, probability or margin, prediction; quotes doubled, so that
    ``read_csv`` reads the texts back unchanged."""
    score = F.col("probability") if logistic else F.col("score").alias("margin")
    ids = ["id"] if "id" in predictions.columns else []
    predictions.select(*ids, "text", score, "prediction").write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', escapeQuotes=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return path


def write_prediction_sample(sample: DataFrame, folder: str, model: str) -> str:
    return write_report_rows(sample, f"{folder}/{model}_pred_sample")


def save_features(fitted: FittedFeatures, folder: str) -> str:
    """The fitted stages, the vocabulary table with idf, and one row of settings
    that includes whether term counts are binary.  A vocabulary that no task may
    hold has no stages; its tables are all that scoring needs."""
    if fitted.pipeline is not None:
        fitted.pipeline.write().overwrite().save(f"{folder}/stages")
    fitted.vocabulary.table.write.mode("overwrite").parquet(f"{folder}/vocabulary")
    spark = fitted.vocabulary.table.sparkSession
    meta = spark.createDataFrame([tuple(fitted.meta().values())], list(fitted.meta()))
    write_report_rows(meta, f"{folder}/meta")
    return folder


def save_weights(weights: DataFrame, folder: str, model: str) -> str:
    weights.write.mode("overwrite").parquet(f"{folder}/{model}_weights")
    return f"{folder}/{model}_weights"


def save_importances(importances: DataFrame, params: DataFrame, folder: str, model: str) -> str:
    importances.write.mode("overwrite").parquet(f"{folder}/{model}_importances")
    write_report_rows(params, f"{folder}/{model}_params")
    return f"{folder}/{model}_importances"


def save_trees(nodes: DataFrame, folder: str, model: str) -> str:
    """The node table of a tree model: all that scoring needs of it."""
    nodes.write.mode("overwrite").parquet(f"{folder}/{model}_nodes")
    return f"{folder}/{model}_nodes"


def save_model(model: Model, folder: str, name: str) -> str:
    model.write().overwrite().save(f"{folder}/{name}")
    return f"{folder}/{name}"


def _write_json_array(vocabulary: Vocabulary, column: str, path: str) -> str:
    # One array per file: as many elements as the vocabulary has words.
    entries = F.array_sort(F.collect_list(F.struct("idx", column)))
    values = F.transform(entries, lambda e: e[column])
    vocabulary.table.agg(F.to_json(values).alias("value")).coalesce(1).write.mode(
        "overwrite"
    ).text(path)
    return path


def export_features_json(fitted: FittedFeatures, folder: str) -> str:
    """Vocabulary, idf values and settings as JSON documents."""
    export_vocabulary_json(fitted.vocabulary, folder)
    meta = fitted.meta() | {"input_col": "filtered_tokens", "text_col": fitted.spec.input_col}
    write_run_report(fitted.vocabulary.table.sparkSession, meta, f"{folder}/features_meta.json")
    return folder


def export_weights_json(weights: DataFrame, folder: str, model: str) -> str:
    """(idx, coefficient), with the intercept at idx -1, as one JSON document.

    The coefficients are one array, as long as the vocabulary of the model.
    """
    path = f"{folder}/{model}_weights.json"
    inner = F.when(F.col("idx") >= 0, F.struct("idx", "coefficient"))
    entries = F.array_sort(F.collect_list(inner))
    document = F.struct(
        F.lit(model).alias("model"),
        F.transform(entries, lambda e: e["coefficient"]).alias("coefficients"),
        F.max(F.when(F.col("idx") == -1, F.col("coefficient"))).alias("intercept"),
    )
    weights.agg(F.to_json(document).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return path


def export_vocabulary_json(vocabulary: Vocabulary, folder: str) -> tuple[str, str]:
    """Words and idf values as two JSON arrays in index order."""
    return (
        _write_json_array(vocabulary, "word", f"{folder}/cv_vocabulary.json"),
        _write_json_array(vocabulary, "idf", f"{folder}/idf_values.json"),
    )
