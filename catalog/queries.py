"""One function per registered query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import tables as tb
from lectern.functions import scores as sc
from lectern.functions import text as tx
from lectern.operators import clean as cl
from lectern.operators import evaluate as ev
from lectern.operators import explore as ex
from lectern.operators import features as ft
from lectern.operators import importance as im
from lectern.operators import models as md
from lectern.operators import sampling as sm
from lectern.operators import scoring as so
from lectern.operators import trees as tr
from lectern.plans import presets as ps
from lectern.plans import runs
from lectern.plans.storage import MAX_LOOKUP_BYTES, fresh_path, materialize
from lectern.sources import artifacts as af
from lectern.sources import readers as rd
from lectern.sources import schema as sh
from lectern.sources import sinks

THRESHOLDS = (0.1, 0.3, 0.5, 0.7, 0.9)
SAMPLE_ROWS = 100

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


# --- sources, schema, filters -------------------------------------------------


@query
def labelled_union(spark, sf):
    return sh.union_labelled(tb.class_sources(spark, sf))


@query
def labelled_union_strict(spark, sf):
    return sh.union_labelled_strict(tb.class_sources(spark, sf))


@query
def csv_sources(spark, sf):
    """The two class sources written as CSV and loaded as a dataset folder."""
    folder = fresh_path(spark, "csv-sources")
    for label, df in tb.class_sources(spark, sf).items():
        df.write.csv(
            f"{folder}/{rd.CLASS_FILES[label]}", header=True, quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    back = rd.load_corpus(spark, folder)
    return back.withColumn("id", F.col("id").cast("bigint"))


@query
def normalize_schema(spark, sf):
    """A source with other column names and neither title nor date."""
    source = tb.corpus(spark, sf).select(
        "id", F.col("text").alias("Content"), F.col("subject").alias("CATEGORY"), "label"
    )
    return sh.normalize_schema(source)


@query
def drop_invalid(spark, sf):
    """Documents with or without a label; as invalid rows, real Spanish texts are
    replaced by blanks and German ones by null."""
    lang = F.col("lang")
    text = F.when(lang == "es", "   ").when(lang != "de", F.col("text"))
    docs = tb.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), text.alias("text"))
    return sh.drop_invalid(docs.join(tb.labels(spark, sf), "id", "left"))


@query
def unlabelled_docs(spark, sf):
    return tb.unlabelled(spark, sf)


@query
def score_inputs(spark, sf):
    return rd.scoring_input(tb.table(spark, sf, "benchmark"), "text", "item_id")


# --- cleaning -----------------------------------------------------------------


@query
def clean_text(spark, sf):
    return cl.clean_text(tb.documents(spark, sf))


@query
def dedup_text(spark, sf):
    return cl.dedup_text(cl.clean_text(tb.documents(spark, sf)))


@query
def dedup_colliding_ids(spark, sf):
    """De-duplication where two documents share each id, as when sources number alike."""
    docs = cl.clean_text(tb.documents(spark, sf)).select(F.floor(F.col("id") / 2).alias("id"), "text")
    return cl.dedup_text(docs)


@query
def duplicate_groups(spark, sf):
    docs = cl.clean_text(tb.documents(spark, sf))
    return cl.duplicate_groups(docs.join(tb.labels(spark, sf), "id", "left"))


@query
def clean_meta(spark, sf):
    return cl.clean_report(tb.documents(spark, sf))


@query
def strip_html(spark, sf):
    return tb.table(spark, sf, "pages").select(
        "page_id", tx.strip_markup(F.col("html")).alias("text")
    )


@query
def clip_text(spark, sf):
    return tb.documents(spark, sf).select("id", tx.clip(F.col("text"), 2000).alias("text"))


@query
def parse_date(spark, sf):
    """Event times spelled in four ways, and one text that is no date."""
    ts = F.col("ts")
    spellings = {
        "day_iso": ts.cast("string"),
        "day_plain": F.date_format(ts, "yyyy-MM-dd"),
        "day_long": F.date_format(ts, "MMMM d, yyyy"),
        "day_short": F.date_format(ts, "d-MMM-yy"),
        "day_none": F.col("event_type"),
    }
    return tb.table(spark, sf, "events").select(
        "event_id", *(tx.parse_date(raw).alias(name) for name, raw in spellings.items())
    )


# --- samples and splits -------------------------------------------------------


@query
def hash_sample(spark, sf):
    return sm.sample_rows(tb.prepared(spark, sf), 0.10).select("id", "label", "text")


@query
def random_n(spark, sf):
    return sm.random_rows(tb.prepared(spark, sf), SAMPLE_ROWS).select("id", "label", "text")


@query
def train_test_split(spark, sf):
    return sm.assign_split(tb.prepared(spark, sf)).select("id", "label", "split")


# --- exploration --------------------------------------------------------------


@query
def class_balance(spark, sf):
    return ex.class_balance(tb.prepared(spark, sf))


@query
def length_stats(spark, sf):
    return rounded(ex.length_stats(tb.prepared(spark, sf)), "avg_len")


@query
def length_median(spark, sf):
    return rounded(ex.length_median(tb.prepared(spark, sf)), "median_len", "avg_len")


@query
def top_subjects(spark, sf):
    return ex.top_subjects(tb.prepared(spark, sf))


@query
def top_subject_docs(spark, sf):
    return ex.restrict_to_top_subjects(tb.prepared(spark, sf)).select("id", "subject", "label")


@query
def subject_label_pivot(spark, sf):
    return ex.subject_label_pivot(tb.prepared(spark, sf))


@query
def word_counts(spark, sf):
    return ex.word_counts(tb.prepared(spark, sf))


@query
def top_words_per_label(spark, sf):
    return ex.top_words_per_label(tb.prepared(spark, sf))


# --- tokens and features ------------------------------------------------------


def _token_rows(docs: DataFrame, column: str) -> DataFrame:
    return docs.select("id", F.posexplode(column).alias("pos", "word"))


@query
def tokenize(spark, sf):
    """Tokens of the \\W+ pattern, in order."""
    spec = replace(tb.CHECK_SPEC, pattern=tx.NON_WORD)
    stages = PipelineModel(stages=ft.token_stages(spec)[:1])
    return _token_rows(stages.transform(tb.prepared(spark, sf)), "tokens")


@query
def remove_stopwords(spark, sf):
    """Letters-only tokens without stop words, in order."""
    stages = PipelineModel(stages=ft.token_stages(tb.CHECK_SPEC))
    return _token_rows(stages.transform(tb.prepared(spark, sf)), "filtered_tokens")


@query
def tokenize_expression(spark, sf):
    """The same tokens as ``remove_stopwords`` by column expressions."""
    tokens = tx.drop_stop_words(tx.tokenize(F.col("text")))
    return _token_rows(tb.prepared(spark, sf).withColumn("t", tokens), "t")


@query
def vocabulary_table(spark, sf):
    _, fitted = tb.fit_train(spark, sf)
    return fitted.vocabulary.table.select("idx", "word", "corpus_count", "doc_freq")


@query
def idf_values(spark, sf):
    _, fitted = tb.fit_train(spark, sf)
    return rounded(fitted.vocabulary.table.select("idx", "word", "idf"), "idf")


@query
def term_frequency(spark, sf):
    docs, fitted = tb.fit_train(spark, sf, tb.COUNT_SPEC)
    return ft.term_frequency(docs, fitted.vocabulary, fitted.spec)


@query
def tfidf_weights(spark, sf):
    docs, fitted = tb.fit_train(spark, sf)
    return rounded(ft.tfidf_weights(docs, fitted.vocabulary, fitted.spec), "idf", "tfidf")


@query
def large_vocabulary_features(spark, sf):
    """Feature vectors as they are made when no task may hold the vocabulary."""
    docs, fitted = tb.fit_train(spark, sf)
    beyond = replace(fitted.vocabulary.size, nbytes=MAX_LOOKUP_BYTES + 1)
    large = replace(fitted, vocabulary=replace(fitted.vocabulary, size=beyond), pipeline=None)
    entries = sc.vector_entries(F.col(fitted.spec.output_col))
    vectors = large.transform(docs).select("id", F.inline(entries))
    return rounded(vectors.withColumnRenamed("value", "tfidf"), "tfidf")


@query
def hashing_tf(spark, sf):
    """Hashed counts add up to the number of tokens of each document."""
    hashed = ft.hashed_features(tb.prepared(spark, sf), ps.HASHED_FEATURES, ps.HASHED_NUM_FEATURES)
    return hashed.select("id", sc.vector_total(F.col("features")).cast("bigint").alias("n_tokens"))


# --- scoring by a model kept as tables ----------------------------------------


def _scored_unlabelled(spark, sf, logistic: bool) -> DataFrame:
    demo = tb.demo_model(spark, sf)
    docs = cl.clean_text(tb.unlabelled(spark, sf)).select("id", "text")
    return so.score_texts(docs, demo.scorer(logistic))


@query
def score_logreg(spark, sf):
    scored = _scored_unlabelled(spark, sf, True)
    return rounded(scored, "score", "probability").drop("text")


@query
def score_from_json(spark, sf):
    """The model written as JSON documents, loaded from their folder."""
    demo = tb.demo_model(spark, sf)
    folder = fresh_path(spark, "json-model")
    sinks.export_features_json(demo.fitted, f"{folder}/feature_artifacts")
    intercept = spark.createDataFrame([(-1, demo.intercept)], "idx int, coefficient double")
    weights = demo.weights.unionByName(intercept)
    sinks.export_weights_json(weights, f"{folder}/model_weights", "logreg")
    docs = cl.clean_text(tb.unlabelled(spark, sf)).select("id", "text")
    scored = so.score_texts(docs, af.load_scorer_json(spark, folder, "logreg"))
    return rounded(scored, "score", "probability").drop("text")


@query
def score_linearsvc(spark, sf):
    scored = _scored_unlabelled(spark, sf, False)
    return rounded(scored, "score").drop("text", "probability")


@query
def score_by_lookup(spark, sf):
    """The join form, with counted instead of binary terms."""
    demo = tb.demo_model(spark, sf, tb.COUNT_SPEC)
    docs = cl.clean_text(tb.unlabelled(spark, sf))
    return rounded(so.score_by_lookup(docs, demo.scorer(True)), "score", "probability")


def _scored_twice(spark, sf, form) -> DataFrame:
    """Every unlabelled document three times, once with a null id."""
    demo = tb.demo_model(spark, sf)
    docs = cl.clean_text(tb.unlabelled(spark, sf))
    unnamed = docs.withColumn("id", F.lit(None).cast("bigint"))
    scored = form(docs.unionByName(docs).unionByName(unnamed), demo.scorer(True))
    return rounded(scored.select("id", "score", "probability", "prediction"), "score", "probability")


@query
def score_texts_in_place(spark, sf):
    """Repeated and null ids, scored inside the rows."""
    return _scored_twice(spark, sf, so.score_texts_in_place)


@query
def score_texts_by_join(spark, sf):
    """Repeated and null ids, scored by the join that large models take."""
    return _scored_twice(spark, sf, so.score_texts_by_join)


@query
def score_benchmark(spark, sf):
    """Scoring input with ids, cleaned as the training texts were."""
    demo = tb.demo_model(spark, sf)
    docs = rd.scoring_input(tb.table(spark, sf, "benchmark"), "text", "item_id")
    docs = docs.withColumn("text", tx.clean_body(F.col("text")))
    scored = so.score_texts(docs, demo.scorer(True))
    return rounded(scored, "score", "probability")


@query
def predictions_csv(spark, sf):
    """Predictions written as CSV and read back, texts included."""
    path = sinks.write_predictions_csv(
        _scored_unlabelled(spark, sf, True), fresh_path(spark, "predictions"), logistic=True
    )
    back = rd.read_csv(spark, path).select(
        F.col("id").cast("bigint").alias("id"), "text",
        F.col("probability").cast("double").alias("probability"),
        F.col("prediction").cast("double").alias("prediction"),
    )
    return rounded(back, "probability")


@query
def artifact_consistency(spark, sf):
    demo = tb.demo_model(spark, sf)
    return so.check_artifacts(demo.fitted.vocabulary.table, demo.weights)


@query
def vocab_import(spark, sf):
    """Vocabulary and idf exported as JSON arrays and imported again."""
    _, fitted = tb.fit_train(spark, sf)
    words, idf = sinks.export_vocabulary_json(fitted.vocabulary, fresh_path(spark, "vocabulary"))
    return rounded(af.import_feature_tables(spark, words, idf), "idf")


# --- evaluation ---------------------------------------------------------------


def _predictions(spark, sf) -> DataFrame:
    demo = tb.demo_model(spark, sf)
    return so.score_texts(demo.docs, demo.scorer(True))


@query
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(_predictions(spark, sf))


METRICS = ("accuracy", "precision", "recall", "f1")


@query
def classification_metrics(spark, sf):
    return rounded(ev.classification_metrics(_predictions(spark, sf), "split"), *METRICS)


@query
def metrics_at_thresholds(spark, sf):
    table = ev.metrics_at_thresholds(_predictions(spark, sf), THRESHOLDS, "probability")
    return rounded(table, *METRICS)


@query
def top_errors(spark, sf):
    found = ev.top_errors(_predictions(spark, sf))
    return rounded(found, "score").select("error", "rank", "id", "label", "score", "title", "text")


@query
def prediction_sample(spark, sf):
    return md.prediction_sample(_predictions(spark, sf))


# --- importances --------------------------------------------------------------


@query
def importance_concentration(spark, sf):
    found = im.importance_concentration(tb.demo_model(spark, sf).importances())
    return rounded(found, "hhi", "n_eff", "top_share")


@query
def importance_spearman(spark, sf):
    table = tb.demo_model(spark, sf).importances()
    return rounded(im.importance_spearman(table, "log_odds", "idf_mass"), "spearman")


@query
def cumulative_importance(spark, sf):
    table = im.cumulative_importance(tb.demo_model(spark, sf).importances())
    return rounded(table.select("model", "idx", "rank", "p", "cumulative"), "p", "cumulative")


# --- trained models -----------------------------------------------------------

TRAIN = {
    "logreg": md.ModelSpec("logreg", {"maxIter": 10, "regParam": 0.1}),
    "linearsvc": md.ModelSpec("linearsvc", {"maxIter": 10, "regParam": 0.1}),
    "randomforest": md.ModelSpec("randomforest", {"numTrees": 10, "maxDepth": 5, "seed": 42}),
    "gbt": md.ModelSpec("gbt", {"maxIter": 4, "maxDepth": 3, "seed": 42}),
}
# Boosted trees as a full run fits them, on as many words; none is dropped that the
# other queries count.
WHOLE_GBT = ps.Preset(
    features=replace(ps.TREES["full"].features, min_df=tb.CHECK_SPEC.min_df),
    models=tuple(m for m in ps.TREES["full"].models if m.name == "gbt"),
)


def _run(spark, sf, *names: str) -> runs.Run:
    preset = ps.Preset(features=tb.CHECK_SPEC, models=tuple(TRAIN[n] for n in names))
    return runs.train(tb.corpus(spark, sf), preset)


def _metrics_hold(tolerance: float = 1e-9) -> Column:
    """Whether the metrics of a row follow from its four counts."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    gaps = [
        F.col("accuracy") * (tp + tn + fp + fn) - (tp + tn),
        F.col("precision") * (tp + fp) - tp,
        F.col("recall") * (tp + fn) - tp,
        F.col("f1") * (tp + (fp + fn) / 2) - tp,
    ]
    return F.greatest(*map(F.abs, gaps)) < tolerance * F.greatest(F.lit(1.0), tp + tn + fp + fn)


def _test_counts(metrics: DataFrame) -> DataFrame:
    """What does not hang on the fit: test rows of each class, and that metrics follow."""
    return metrics.select(
        "model", F.col("total").alias("n_test"), (F.col("tp") + F.col("fn")).alias("n_real"),
        (F.col("tn") + F.col("fp")).alias("n_fake"), _metrics_hold().alias("metrics_hold"),
    )


def _train_metrics(spark, sf, *names: str) -> DataFrame:
    return _run_metrics(_run(spark, sf, *names))


def _run_metrics(run: runs.Run) -> DataFrame:
    """Per model its test rows, and whether its scores part the classes it was fitted on."""
    margins = {r["model"]: r["margin"] for r in md.score_margins(run.trained).collect()}
    learning = [name for name, margin in margins.items() if margin is not None and margin > 0]
    n_train = run.dataset["train_real"] + run.dataset["train_fake"]
    return _test_counts(md.comparison_table(run.trained)).select(
        "*", F.col("model").isin(learning).alias("learns"), F.lit(n_train).cast("bigint").alias("n_train")
    )


@query
def train_logreg(spark, sf):
    return _train_metrics(spark, sf, "logreg")


@query
def train_linearsvc(spark, sf):
    return _train_metrics(spark, sf, "linearsvc")


@query
def train_random_forest(spark, sf):
    return _train_metrics(spark, sf, "randomforest")


@query
def train_gbt(spark, sf):
    """Every iteration and level of a full run, on a vocabulary of its size."""
    return _run_metrics(runs.train(tb.corpus(spark, sf), WHOLE_GBT))


@query
def model_comparison(spark, sf):
    return _train_metrics(spark, sf, *TRAIN)


@query
def hashing_model(spark, sf):
    """Test rows of a model on hashed counts; raw documents, copies included."""
    _, report = runs.train_hashed(tb.corpus(spark, sf), "logreg")
    names = ("model", "total", "tp", "tn", "fp", "fn", *METRICS)
    return _test_counts(spark.createDataFrame([tuple(report[n] for n in names)], list(names)))


@query
def score_model(spark, sf):
    """Unlabelled documents scored by fitted stages with a trained model, and by its
    tables inside the rows: how many, and how many differ."""
    run = _run(spark, sf, "logreg")
    model = PipelineModel(stages=[*run.features.pipeline.stages, run.trained[0].model])
    docs = cl.clean_text(tb.unlabelled(spark, sf)).select("id", "text")
    by_model = md.batch_score(model, docs, "id").withColumnRenamed("probability", "score")
    by_tables = so.score_texts(docs, _scorer(run, True))
    return _agreement(by_model, by_tables.drop("score").withColumnRenamed("probability", "score"))


def _scorer(run: runs.Run, logistic: bool, trained: md.Trained | None = None) -> so.LinearScorer:
    """The tables of a model, the first of the run unless one is named."""
    trained, vocabulary = trained or run.trained[0], run.features.vocabulary
    weights = md.linear_weights(trained.model, trained.name, vocabulary).filter("idx >= 0")
    return so.LinearScorer.build(
        vocabulary.table, weights, float(trained.model.intercept), run.features.spec, logistic,
        size=vocabulary.size,
    )


def _agreement(by_model: DataFrame, by_tables: DataFrame) -> DataFrame:
    """Documents scored both ways, and how many of them differ."""
    a = by_model.select("id", F.col("score").alias("a"), F.col("prediction").alias("p"))
    b = by_tables.select("id", F.col("score").alias("b"), F.col("prediction").alias("q"))
    far = (F.abs(F.col("a") - F.col("b")) > 1e-9) | (F.col("p") != F.col("q"))
    return a.join(b, "id", "full_outer").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(F.coalesce(far, F.lit(True))).alias("n_differ")
    )


def _scored_both_ways(spark, sf, name: str, logistic: bool) -> DataFrame:
    run = _run(spark, sf, name)
    model = run.trained[0].model
    docs = cl.clean_text(tb.unlabelled(spark, sf)).select("id", "text")
    by_model = model.transform(run.features.transform(docs)).withColumn(
        "score", vector_to_array("rawPrediction")[1]
    )
    return _agreement(by_model, so.score_by_lookup(docs, _scorer(run, logistic)))


@query
def logreg_agreement(spark, sf):
    """A trained model and its exported tables score every document alike."""
    return _scored_both_ways(spark, sf, "logreg", True)


@query
def linearsvc_agreement(spark, sf):
    return _scored_both_ways(spark, sf, "linearsvc", False)


@query
def grid_comparison(spark, sf):
    """Three penalties of one model: test counts of each, and whether the weights of
    the marked one minimise its own loss on the training rows."""
    run = _run(spark, sf)
    rows = md.as_training_rows(run.features.transform(run.documents), "id", "split")
    rows = materialize(rows, "features", ["split"])
    train, test = (rows.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    spec = md.ModelSpec("logreg", {"maxIter": 100, "tol": 1e-9})
    grid = md.fit_grid(train, test, spec, [{"regParam": p} for p in (0.05, 0.1, 0.5)])
    table = materialize(md.grid_table(grid, test), "grid")
    best = grid[table.filter("best").first()["model"]]
    (optimum,) = _slopes(run, best).agg((F.max("slope") < 1e-4).alias("at_optimum")).collect()
    n_best = table.agg(F.count_if("best")).first()[0]
    return _test_counts(table).withColumns(
        {"best_at_optimum": F.lit(optimum["at_optimum"]), "n_best": F.lit(n_best)}
    )


@query
def report_history(spark, sf):
    """Metrics of two runs, one of them recorded twice, read back from their table."""
    scored = _predictions(spark, sf)
    folder = fresh_path(spark, "reports")
    for run_id, threshold in (("2", 0.9), ("10", 0.5), ("2", 0.3)):
        rows = ev.metrics_at_thresholds(scored, (threshold,), "probability")
        sinks.record_report(rows, folder, run_id)
    return rounded(rd.read_reports(spark, folder), *METRICS)


def _scored_by_trees(spark, sf, name: str) -> DataFrame:
    run = _run(spark, sf, name)
    model = run.trained[0].model
    docs = cl.clean_text(tb.unlabelled(spark, sf)).select("id", "text")
    by_model = model.transform(run.features.transform(docs)).withColumn(
        "score", vector_to_array("rawPrediction")[1]
    )
    ensemble = tr.Ensemble.build(tr.node_table(model))
    return _agreement(by_model, tr.score_by_trees(docs, run.features, ensemble))


@query
def forest_agreement(spark, sf):
    """A trained forest and its node table score every document alike."""
    return _scored_by_trees(spark, sf, "randomforest")


@query
def gbt_agreement(spark, sf):
    return _scored_by_trees(spark, sf, "gbt")


@query
def score_trees(spark, sf):
    """Unlabelled documents scored from a node table that SQL can repeat."""
    fitted, ensemble = tb.demo_trees(spark, sf)
    docs = cl.clean_text(tb.unlabelled(spark, sf)).select("id", "text")
    scored = tr.score_by_trees(docs, fitted, ensemble).select("id", "score", "probability")
    return rounded(scored, "score", "probability")


@query
def tree_nodes(spark, sf):
    """The node table of the same trees."""
    _, ensemble = tb.demo_trees(spark, sf)
    return rounded(ensemble.table.select("tree", "node", "idx", "left", "right", "for_1"), "for_1")


@query
def linear_weights(spark, sf):
    """Sizes of the weight table: one row per word of the vocabulary, one intercept."""
    run = _run(spark, sf, "linearsvc")
    table = md.linear_weights(run.trained[0].model, "linearsvc", run.features.vocabulary)
    return table.groupBy("model").agg(
        F.count("word").alias("n_words"), F.count_if(F.col("idx") == -1).alias("n_intercepts"),
        F.count_if(F.col("coefficient").isNull() | F.isnan("coefficient")).alias("n_missing"),
    )


@query
def logreg_optimum(spark, sf):
    """Whether the weights of a trained model minimise its loss on the training rows.

    The derivative of mean loss and penalty by each weight, in units of the
    feature's deviation as the fit counts them, is computed from the weight table.
    """
    spec = md.ModelSpec("logreg", {"maxIter": 100, "regParam": 0.1, "tol": 1e-9})
    run = runs.train(tb.corpus(spark, sf), ps.Preset(features=tb.CHECK_SPEC, models=(spec,)))
    return _slopes(run, run.trained[0]).agg(
        F.count(F.lit(1)).alias("n_weights"), (F.max("slope") < 1e-4).alias("at_optimum")
    )


def _slopes(run: runs.Run, trained: md.Trained) -> DataFrame:
    """Of each weight of a logistic model, the size of the derivative of its loss."""
    vocabulary, penalty = run.features.vocabulary, trained.spec.params["regParam"]
    weights = md.linear_weights(trained.model, "logreg", vocabulary)
    train = run.documents.filter(F.col("split") == "train")
    n = float(vocabulary.n_docs)
    # The features of a row, and its error by the tables.
    scored = so.score_texts(train, _scorer(run, True, trained)).select(
        "_row", (F.col("probability") - F.col("label")).alias("error")
    )
    cells = run.features.transform(train).select(
        "_row", F.inline(sc.vector_entries(F.col("features")))
    )
    value, error = F.col("value"), F.col("error")
    sums = cells.join(scored, "_row").groupBy("idx").agg(
        F.sum(value * error).alias("slope"), F.sum(value).alias("one"), F.sum(value * value).alias("two")
    )
    deviation = F.sqrt((F.col("two") - F.col("one") * F.col("one") / n) / (n - 1))
    slopes = weights.join(sums, "idx").select(
        F.abs(F.col("slope") / n / deviation + penalty * deviation * F.col("coefficient")).alias("slope")
    )
    intercept = scored.agg(F.abs(F.sum("error") / n).alias("slope"))
    return slopes.unionByName(intercept)


@query
def tree_importances(spark, sf):
    """Size of the importance table, and that it holds shares of 1."""
    run = _run(spark, sf, "randomforest")
    table = md.tree_importances(run.trained[0].model, "randomforest", run.features.vocabulary)
    return table.groupBy("model").agg(
        F.count("word").alias("n_words"), F.count_if(F.col("importance") < 0).alias("n_negative"),
        (F.abs(F.sum("importance") - 1.0) < 1e-9).alias("adds_up"),
    )


@query
def worst_model_errors(spark, sf):
    """Whether the worst errors of a trained model are all there, are errors, and
    carry the texts of their documents."""
    run = _run(spark, sf, "logreg")
    model = run.trained[0]
    found = runs.worst_errors(run, model)
    texts = run.documents.select("id", F.col("text").alias("own"))
    rows = found.join(texts, "id").agg(
        F.lit("logreg").alias("model"),
        F.count_if(F.col("error") == "false_positive").alias("n_fp"),
        F.count_if(F.col("error") == "false_negative").alias("n_fn"),
        F.count_if((F.col("text") != F.col("own")) | (F.col("label") == F.col("prediction"))).alias("n_wrong"),
    )
    cells = run.metrics[0]
    complete = (F.col("n_fp") == min(5, cells["fp"])) & (F.col("n_fn") == min(5, cells["fn"]))
    return rows.select("model", complete.alias("complete"), "n_wrong")
