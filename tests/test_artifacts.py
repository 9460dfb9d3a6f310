import json

import pytest

from lectern.operators import features as ft
from lectern.operators import scoring as so
from lectern.sources import artifacts as af
from lectern.sources import readers as rd
from lectern.sources import sinks


def write(tmp_path, name, obj):
    path = tmp_path / name
    path.write_text(obj if isinstance(obj, str) else json.dumps(obj, indent=2))
    return str(path)


@pytest.mark.parametrize(
    "layout",
    [
        ["w0", "w1", "2020"],
        {"w1": 1, "w0": 0, "2020": 2},
        {"2": "2020", "0": "w0", "1": "w1"},
    ],
)
def test_three_vocabulary_layouts(spark, tmp_path, layout):
    df = af.import_vocabulary_json(spark, write(tmp_path, "v.json", layout))
    assert sorted(map(tuple, df.collect())) == [(0, "w0"), (1, "w1"), (2, "2020")]
    assert df.columns == ["idx", "word"]


def test_all_digit_words_are_told_from_indices(spark, tmp_path):
    df = af.import_vocabulary_json(spark, write(tmp_path, "v.json", {"2020": 0, "1999": 1}))
    assert sorted(map(tuple, df.collect())) == [(0, "2020"), (1, "1999")]


@pytest.mark.parametrize("bad", [{"a": "b"}, "3", "{}", "nonsense"])
def test_other_documents_raise(spark, tmp_path, bad):
    with pytest.raises(Exception, match="list of words or a map"):
        af.import_vocabulary_json(spark, write(tmp_path, "v.json", bad)).collect()


def test_weights_and_importances(spark, tmp_path):
    doc = {"type": "X", "model": "logreg", "coefficients": [0.5, -1.0], "intercept": 0.25}
    table, intercept = af.import_weights_json(spark, write(tmp_path, "w.json", doc))
    assert intercept == 0.25
    assert sorted(map(tuple, table.collect())) == [("logreg", 0, 0.5), ("logreg", 1, -1.0)]
    for gone in ("coefficients", "intercept"):
        broken = {k: v for k, v in doc.items() if k != gone}
        with pytest.raises(ValueError, match="lacks"):
            af.import_weights_json(spark, write(tmp_path, f"{gone}.json", broken))
    doc = {"model": "rf", "num_features": 2, "feature_importances": [0.9, 0.1], "params": {}}
    table = af.import_importances_json(spark, write(tmp_path, "i.json", doc))
    assert sorted(map(tuple, table.collect())) == [("rf", 0, 0.9), ("rf", 1, 0.1)]


def test_scoring_from_json_documents(spark, tmp_path):
    words = write(tmp_path, "v.json", ["budget", "aliens"])
    idf = write(tmp_path, "i.json", [1.0, 2.0])
    weights, intercept = af.import_weights_json(
        spark,
        write(tmp_path, "w.json", {"model": "linearsvc", "coefficients": [0.5, -1.0], "intercept": 0.1}),
    )
    vocabulary = af.import_feature_tables(spark, words, idf)
    so.require_consistent(vocabulary, weights)
    spec = ft.FeatureSpec(binary_tf=False)
    scorer = so.LinearScorer.build(vocabulary, weights, intercept, spec, logistic=False)
    docs = rd.literal_text(spark, "Budget budget talks", "aliens!", "nothing")
    got = {r["id"]: (round(r["score"], 9), r["prediction"]) for r in so.score_texts(docs, scorer).collect()}
    assert got == {0: (1.1, 1.0), 1: (-1.9, 0.0), 2: (0.1, 1.0)}
    short = write(tmp_path, "short.json", [1.0])
    with pytest.raises(ValueError, match="do not match"):
        so.require_consistent(af.import_feature_tables(spark, words, short), weights)


def test_scorer_from_a_json_folder(spark, tmp_path):
    features, models = tmp_path / "feature_artifacts", tmp_path / "model_weights"
    features.mkdir(), models.mkdir()
    write(features, "cv_vocabulary.json", {"budget": 0, "aliens": 1})
    write(features, "idf_values.json", [1.0, 2.0])
    write(features, "features_meta.json", {"num_features": 2, "min_df": 3.0, "input_col": "filtered_tokens"})
    for name in ("logreg", "linearsvc"):
        document = {"model": name, "coefficients": [0.5, -1.0], "intercept": 0.1}
        write(models, f"{name}_weights.json", document)
    docs = rd.literal_text(spark, "Budget budget talks", "aliens!")
    scorer = af.load_scorer_json(spark, str(tmp_path), "logreg")
    assert scorer.spec.binary_tf is False and scorer.spec.min_df == 3.0 and scorer.logistic
    got = {r["id"]: (round(r["score"], 9), r["prediction"]) for r in so.score_texts(docs, scorer).collect()}
    assert got == {0: (1.1, 1.0), 1: (-1.9, 0.0)}
    assert not af.load_scorer_json(spark, str(tmp_path), "linearsvc").logistic
    write(features, "idf_values.json", [1.0])
    with pytest.raises(ValueError, match="do not match"):
        af.load_scorer_json(spark, str(tmp_path), "logreg")


def test_a_word_without_weight_is_an_error(spark):
    words = spark.createDataFrame([(0, "a", 1.0), (1, "b", 1.0)], "idx int, word string, idf double")
    weights = spark.createDataFrame([(0, 0.5)], "idx int, coefficient double")
    with pytest.raises(Exception, match="no weight for the word b"):
        scorer = so.LinearScorer.build(words, weights, 0.0, ft.FeatureSpec(), logistic=True)
        so.score_texts(rd.literal_text(spark, "a b"), scorer).collect()


def test_exported_arrays_read_back(spark, articles, tmp_path):
    vocabulary = ft.fit_vocabulary(articles, ft.FeatureSpec(vocab_size=25, min_df=2))
    words, idf = sinks.export_vocabulary_json(vocabulary, str(tmp_path / "out"))
    back = af.import_feature_tables(spark, words, idf)
    want = sorted(map(tuple, vocabulary.table.select("idx", "word", "idf").collect()))
    assert sorted(map(tuple, back.collect())) == want


def test_predictions_csv_keeps_texts(spark, tmp_path):
    rows = [(1, ' He said ""hi"",\n and\tleft ', 0.25, 0.56, 1.0), (2, "plain", -0.5, 0.38, 0.0)]
    df = spark.createDataFrame(rows, "id bigint, text string, score double, probability double, prediction double")
    for logistic, name in ((True, "probability"), (False, "margin")):
        path = sinks.write_predictions_csv(df, str(tmp_path / name), logistic)
        back = rd.read_csv(spark, path)
        assert back.columns == ["id", "text", name, "prediction"]
        assert {r["id"]: r["text"] for r in back.collect()} == {"1": rows[0][1], "2": "plain"}
    path = sinks.write_predictions_csv(df.drop("id"), str(tmp_path / "noid"), True)
    assert rd.read_csv(spark, path).columns == ["text", "probability", "prediction"]
