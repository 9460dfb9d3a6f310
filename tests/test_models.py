import json
from dataclasses import replace
from pathlib import Path
from random import Random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from catalog import queries as catalog_queries
from lectern.operators import models as md
from lectern.operators.features import FeatureSpec
from lectern.plans import presets as ps
from lectern.plans import runs
from lectern.sources import artifacts as af

SMALL = ps.Preset(
    features=FeatureSpec(vocab_size=40, min_df=2),
    models=(
        md.ModelSpec("logreg", {"maxIter": 8, "regParam": 0.1}),
        md.ModelSpec("linearsvc", {"maxIter": 8, "regParam": 0.1}),
        md.ModelSpec("randomforest", {"numTrees": 5, "maxDepth": 4, "seed": 42}),
        md.ModelSpec("gbt", {"maxIter": 3, "maxDepth": 3, "seed": 42}),
    ),
)


@pytest.fixture(scope="module")
def run(articles):
    return runs.train(articles, SMALL, account=True)


def test_dataset_counts(run):
    assert (run.dataset["rows_before"], run.dataset["rows_after"], run.dataset["dropped"]) == (120, 120, 0)


def test_exploration_frame(spark, articles, tmp_path):
    for label, name in ((1, "True.csv"), (0, "Fake.csv")):
        part = articles.filter(F.col("label") == label).drop("label", "id")
        part.write.csv(str(tmp_path / name), header=True, quote='"', escape='"')
    df = runs.exploration_frame(spark, str(tmp_path))
    assert df.count() == 120 and df.filter("label = 0").count() == 40


def test_every_model_beats_the_majority_class(run):
    assert [m["model"] for m in run.metrics] == ["logreg", "linearsvc", "randomforest", "gbt"]
    for m in run.metrics:
        total = m["tp"] + m["tn"] + m["fp"] + m["fn"]
        assert m["total"] == total > 0
        share = (m["tp"] + m["fn"]) / total
        assert m["f1"] >= 2 * share / (1 + share)
        assert m["train_seconds"] > 0 and m["score_seconds"] > 0


def test_comparison_table_agrees_with_single_metrics(run):
    rows = {r["model"]: r for r in md.comparison_table(run.trained).collect()}
    for m in run.metrics:
        assert all(rows[m["model"]][c] == m[c] for c in ("tp", "tn", "fp", "fn", "total"))


def test_features_see_the_training_rows_only(run):
    train = run.documents.filter("split = 'train'")
    assert run.features.vocabulary.n_docs == train.count() < run.documents.count()


def test_names_are_checked_before_any_work(articles):
    with pytest.raises(ValueError, match="perceptron"):
        runs.train(articles, replace(SMALL, models=(md.ModelSpec("perceptron"),)))
    with pytest.raises(ValueError, match="perceptron"):
        runs.train_hashed(articles, "perceptron")
    with pytest.raises(ValueError, match="two classes"):
        runs.train(articles.filter("label = 1"), SMALL)


def test_artifact_tables(run):
    logreg, _, forest, _ = run.trained
    weights = md.linear_weights(logreg.model, "logreg", run.features.vocabulary)
    by_idx = {r["idx"]: r["coefficient"] for r in weights.collect()}
    assert by_idx.pop(-1) == logreg.model.intercept
    assert [by_idx[i] for i in range(len(by_idx))] == list(logreg.model.coefficients)
    table = md.tree_importances(forest.model, "rf", run.features.vocabulary)
    got = {r["idx"]: r["importance"] for r in table.collect()}
    assert [got[i] for i in range(len(got))] == list(forest.model.featureImportances.toArray())
    with pytest.raises(ValueError, match="no coefficients"):
        md.linear_weights(forest.model, "rf", run.features.vocabulary)
    with pytest.raises(ValueError, match="no feature importances"):
        md.tree_importances(logreg.model, "lr", run.features.vocabulary)


def test_saved_run_scores_as_the_model_did(spark, run, articles, tmp_path):
    folder = str(tmp_path / "out")
    report = runs.save_run(run, folder, "r1")
    docs = articles.select("id", "text")
    stages = PipelineModel(stages=[*run.features.pipeline.stages, run.trained[0].model])
    cleaned = docs.withColumn("text", F.lower("text"))
    want = {r["id"]: r for r in md.batch_score(stages, cleaned, "id").collect()}
    for r in runs.score_saved(docs, folder, "logreg").collect():
        assert r["probability"] == pytest.approx(want[r["id"]]["probability"], abs=1e-9)
        assert r["prediction"] == want[r["id"]]["prediction"]
    margins = runs.score_saved(docs, folder, "linearsvc").collect()
    assert all((r["score"] >= 0) == (r["prediction"] == 1.0) for r in margins)
    # Files on disk.
    assert af.load_spec(spark, f"{folder}/feature_artifacts").binary_tf is True
    loaded = af.load_stages(spark, f"{folder}/feature_artifacts")
    assert loaded.transform(docs).count() == 120
    text = spark.read.text(f"{folder}/run_report").first()["value"]
    assert json.loads(text)["dataset"]["rows_before"] == 120
    assert json.loads(text)["models"]["gbt"]["tp"] == report["models"]["gbt"]["tp"]
    header = next(Path(f"{folder}/model_comparison_r1_csv").glob("*.csv")).read_text().splitlines()
    assert header[0] == (
        "model,features_fit_seconds,train_seconds,score_seconds,accuracy,f1,precision,recall,tp,tn,fp,fn"
    )
    assert len(header) == 5
    metrics = spark.read.json(f"{folder}/metrics_logreg").first()
    assert metrics["confusion_matrix"]["tp"] == run.metrics[0]["tp"]
    sample = spark.read.json(f"{folder}/predictions/gbt_pred_sample")
    test_rows = run.documents.filter("split = 'test'").count()
    assert sample.count() == min(200, test_rows)
    params = spark.read.json(f"{folder}/tree_artifacts/gbt_params").first()
    assert params["params"]["maxDepth"] == "3"


def test_worst_errors_carry_texts(run):
    for model in run.trained:
        m = next(x for x in run.metrics if x["model"] == model.name)
        rows = runs.worst_errors(run, model, 3).collect()
        assert len(rows) == min(3, m["fp"]) + min(3, m["fn"])
        assert all(r["text"] for r in rows)


def test_corpus_without_ids_is_keyed_by_content(articles):
    preset = replace(SMALL, models=SMALL.models[:1], sample_rows=60)
    run = runs.train(articles.drop("id"), preset, key=None)
    assert dict(run.documents.dtypes)["id"] == "string"
    assert run.documents.filter("split = 'train'").count() == 60
    assert run.documents.count() == run.documents.select("id").distinct().count()
    counts = run.dataset
    assert counts["train_real"] + counts["train_fake"] == 60
    assert counts["test_real"] + counts["test_fake"] == run.documents.count() - 60


def test_samples_bound_the_fit_rows_alone(articles):
    whole = runs.prepare(articles, SMALL)
    for bound in ({"sample_fraction": 0.5}, {"sample_rows": 40}):
        docs = runs.prepare(articles, replace(SMALL, **bound))
        sides = {split: docs.filter(F.col("split") == split).count() for split in ("train", "test")}
        assert sides["test"] == whole.filter("split = 'test'").count()
        assert 25 < sides["train"] < 75 and sides["train"] == bound.get("sample_rows", sides["train"])


def test_copies_without_ids_stay_apart(articles):
    copies = articles.drop("id").unionByName(articles.drop("id"))
    preset = replace(SMALL, models=SMALL.models[:1], clean=False)
    run = runs.train(copies, preset, key=None)
    model, m = run.trained[0], run.metrics[0]
    assert m["total"] == run.documents.filter("split = 'test'").count()
    assert runs.worst_errors(run, model, 3).count() == min(3, m["fp"]) + min(3, m["fn"])
    assert runs.sample_predictions(run, model, 10).count() == 10


def test_hashed_run(articles, tmp_path):
    fitted, metrics = runs.train_hashed(articles, "logreg", num_features=256)
    assert metrics["model"] == "logreg" and metrics["f1"] > 0.8
    assert len(fitted.stages) == 4
    path = runs.save_hashed(fitted, metrics, str(tmp_path / "hashed"), "r2")
    report = json.loads(articles.sparkSession.read.text(path).first()["value"])
    assert report["num_features"] == 256 and report["tp"] == metrics["tp"]
    again = PipelineModel.load(str(tmp_path / "hashed/models/logreg_hashed"))
    assert again.transform(articles).count() == 120


def test_presets_hold_the_published_sizes():
    assert ps.LINEAR["full"].features.vocab_size == 20000 and ps.LINEAR["full"].features.min_df == 10
    assert [m.name for m in ps.LINEAR["debug"].models] == ["linearsvc"]
    assert ps.TREES["full"].models[0].params["numTrees"] == 120
    assert ps.COMPARISON["full"].features.binary_tf is False and len(ps.COMPARISON["full"].models) == 4


def test_whole_presets_on_a_small_corpus(articles):
    shrink = {"vocab_size": 30, "min_df": 2}
    for preset in (ps.LINEAR["full"], ps.COMPARISON["debug"]):
        models = tuple(
            replace(m, params={**m.params, **{k: 2 for k in ("maxIter", "numTrees") if k in m.params}})
            for m in preset.models
        )
        small = replace(preset, features=replace(preset.features, **shrink), models=models)
        assert len(runs.train(articles, small).metrics) == len(models)


def test_tree_tasks_hold_a_bounded_number_of_bins(spark, monkeypatch):
    rows = [(float(i % 2), Vectors.sparse(40, [i % 40], [1.0])) for i in range(60)]
    train = spark.createDataFrame(rows, ["label", "features"]).coalesce(1)
    fit, seen = GBTClassifier.fit, []
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: seen.append(df.rdd.glom().map(len).collect()) or fit(self, df))
    monkeypatch.setattr(md, "TREE_BYTES_PER_TASK", 10 * 4 * 40, raising=False)  # ten rows
    spec = md.ModelSpec("gbt", {"maxIter": 2, "maxDepth": 2, "seed": 42})
    for n_rows in (None, 60):
        trained = md.fit_models(train, train, [spec], n_rows)[0]
        assert trained.predictions.count() == 60
    assert [sum(n) for n in seen] == [60, 60] and max(map(max, seen)) <= 15  # dealt round robin
    small = train.limit(10).coalesce(1)
    md.fit_models(small, small, [spec])
    assert seen[-1] == [10]  # nothing to spread


def test_train_gbt_fits_a_whole_ensemble(spark, tmp_path, monkeypatch):
    draw = Random(0)  # labels by chance, which no shallow tree parts
    words = [f"x{''.join('abcdefghij'[int(c)] for c in str(w))}" for w in range(2100)]
    docs = [(i, " ".join(draw.sample(words, 300)), f"s{i % 4}") for i in range(120)]
    marks = [(i, draw.randrange(2)) for i in range(120)]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    train, seen = runs.train, []
    monkeypatch.setattr(runs, "train", lambda *a, **k: seen.append(train(*a, **k)) or seen[-1])
    (row,) = catalog_queries.train_gbt(spark, str(tmp_path)).collect()
    ((trained,),) = (run.trained for run in seen)
    assert row["learns"] and row["n_train"] + row["n_test"] == 120
    assert trained.model.numFeatures > 2000  # nor a cut vocabulary
    assert trained.model.getNumTrees == 60 and max(t.depth for t in trained.model.trees) == 7
