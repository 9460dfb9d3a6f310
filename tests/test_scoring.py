from dataclasses import replace

import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import functions as F

from lectern.operators import features as ft
from lectern.operators import models as md
from lectern.operators import scoring as so
from lectern.plans import storage as st
from lectern.plans.storage import LookupSize, materialize


@pytest.fixture(scope="module", params=[True, False], ids=["binary", "counts"])
def fitted(request, articles):
    return ft.fit_features(articles, ft.FeatureSpec(vocab_size=40, min_df=2, binary_tf=request.param))


@pytest.fixture(scope="module")
def train(fitted, articles):
    return materialize(md.as_training_rows(fitted.transform(articles), "id", "text"))


def scorer_of(fitted, model, logistic):
    weights = md.linear_weights(model, "m", fitted.vocabulary).filter("idx >= 0")
    return so.LinearScorer.build(
        fitted.vocabulary.table, weights, float(model.intercept), fitted.spec, logistic
    )


def by_id(df, column):
    return {r["id"]: r[column] for r in df.select("id", column).collect()}


@pytest.mark.parametrize("logistic", [True, False])
def test_table_scores_equal_the_model(fitted, train, articles, logistic, monkeypatch):
    estimator = LogisticRegression(maxIter=8, regParam=0.1) if logistic else LinearSVC(maxIter=8, regParam=0.1)
    model = estimator.fit(train)
    scorer = scorer_of(fitted, model, logistic)
    expected = model.transform(train)
    from pyspark.ml.functions import vector_to_array

    want_score = by_id(expected.withColumn("s", vector_to_array("rawPrediction")[1]), "s")
    want_pred = by_id(expected, "prediction")
    docs = articles.select("id", "text")
    in_place = so.score_texts(docs, scorer)
    broadcast = so.score_by_lookup(docs, scorer)
    large = replace(scorer, size=LookupSize(10**9, 10**12))
    salted = so.score_by_lookup(docs, large)
    joined = so.score_texts(docs, large)
    assert "_salt" in salted._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="scored by a join"):
        so.score_texts_in_place(docs, large)
    for got in (in_place, broadcast, salted, joined):
        assert by_id(got, "score") == pytest.approx(want_score, abs=1e-9)
        assert by_id(got, "prediction") == want_pred
    if logistic:
        want = by_id(expected.withColumn("p", vector_to_array("probability")[1]), "p")
        assert by_id(in_place, "probability") == pytest.approx(want, abs=1e-9)
    else:
        assert set(by_id(in_place, "probability").values()) == {None}


def test_in_place_scoring_does_not_shuffle(fitted, train, articles):
    model = LinearSVC(maxIter=2).fit(train)
    plan = so.score_texts(articles.select("id", "text"), scorer_of(fitted, model, False))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_unknown_words_score_the_intercept(spark, fitted, train):
    model = LogisticRegression(maxIter=3).fit(train)
    scorer = scorer_of(fitted, model, True)
    docs = spark.createDataFrame([(1, "zzz qqq"), (2, "")], "id bigint, text string")
    for got in (so.score_texts(docs, scorer), so.score_by_lookup(docs, scorer)):
        assert by_id(got, "score") == pytest.approx({1: model.intercept, 2: model.intercept})


def test_extreme_margins_and_other_thresholds(spark, fitted):
    weights = fitted.vocabulary.table.select("idx", F.lit(0.0).alias("coefficient"))
    docs = spark.createDataFrame([(1, "anything")], "id bigint, text string")
    for intercept, probability in ((800.0, 1.0), (-800.0, 0.0), (0.0, 0.5)):
        scorer = so.LinearScorer.build(fitted.vocabulary.table, weights, intercept, fitted.spec, True)
        row = so.score_texts(docs, scorer).first()
        assert row["probability"] == probability and row["prediction"] == float(probability >= 0.5)
        assert so.score_texts(docs, replace(scorer, threshold=0.99)).first()["prediction"] == float(
            probability >= 0.99
        )


def test_mismatched_artifacts_are_reported(spark, fitted):
    vocabulary = fitted.vocabulary.table
    good = vocabulary.select("idx", F.lit(1.0).alias("coefficient"))
    so.require_consistent(vocabulary, good)
    for bad in (good.filter("idx > 0"), good.union(spark.createDataFrame([(99999, 1.0)], good.schema))):
        with pytest.raises(ValueError, match="do not match"):
            so.require_consistent(vocabulary, bad)
    with pytest.raises(ValueError, match="do not match"):
        so.require_consistent(vocabulary.withColumn("idf", F.lit(None).cast("double")), good)


def test_lookup_join_copies_a_large_lookup_over_salts(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"w{i}") for i in range(300)], "id bigint, word string")
    lookup = spark.createDataFrame([("hot", 1), ("w3", 2)], "word string, v int")
    small = st.lookup_join(facts, lookup, "word", LookupSize(2, 20), "left")
    large = st.lookup_join(facts, lookup, "word", LookupSize(10**9, 20), "left")
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)
    assert large.count() == 300


def test_only_hot_keys_get_salts_and_by_their_share(spark):
    rows = [(i, "hot" if i % 2 else "warm" if i % 4 else None if i % 8 else f"w{i}") for i in range(8000)]
    facts = spark.createDataFrame(rows, "id bigint, word string")
    copies = lambda **o: {r["_key"]: r["_copies"] for r in st.hot_keys(facts, "word", **o).collect()}
    hashed = spark.sql("SELECT xxhash64('hot') h, xxhash64('warm') w, xxhash64(CAST(NULL AS STRING)) n").first()
    assert copies(share=0.05, rows=1) == {hashed["h"]: 10, hashed["w"]: 5, hashed["n"]: 3}
    assert copies(share=0.3, rows=1) == {hashed["h"]: 2}
    assert copies(share=0.05, rows=3000) == {hashed["h"]: 2}
    assert copies() == {}
    assert st.hot_keys(facts.limit(0), "word").collect() == []


def test_a_word_of_every_row_is_spread_evenly(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    facts = spark.range(20_000).withColumn("word", F.lit("hot"))
    facts = facts.unionByName(spark.range(500).withColumn("word", F.concat(F.lit("w"), "id")))
    lookup = spark.createDataFrame([("hot", 1)] + [(f"w{i}", i) for i in range(400)], "word string, v int")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = st.lookup_join(facts, lookup, "word", LookupSize(10**9, 20), share=0.005, rows=1)
        held = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(held) == 20_400 and len(held) == 8 and max(held) < 2 * 20_400 / 8
        plain = facts.join(lookup, "word").select("id", "word", "v")
        assert sorted(map(tuple, joined.select("id", "word", "v").collect())) == sorted(map(tuple, plain.collect()))
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert st.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert st.measure_lookup(spark.createDataFrame([("ab", 1)], "word string, v int"), "word") == LookupSize(1, 18)


def test_spread_only_touches_inputs_of_few_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    assert st.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == cores
    many = spark.range(0, 10, 1, cores + 3)
    assert st.spread(many) is many


def test_both_forms_score_rows_and_not_ids(spark, fitted, train, articles):
    model = LogisticRegression(maxIter=3).fit(train)
    scorer = scorer_of(fitted, model, True)
    texts = [r["text"] for r in articles.limit(4).collect()]
    rows = [(1, texts[0], "x"), (1, texts[1], "y"), (None, texts[2], "x"), (2, None, "z"), (3, texts[3], None)]
    docs = spark.createDataFrame(rows, "id bigint, text string, source string")
    for given in (docs, docs.drop("id")):
        a, b = so.score_texts_in_place(given, scorer), so.score_texts_by_join(given, scorer)
        assert a.columns == b.columns == [*given.columns, "score", "probability", "prediction"]
        near = lambda df: sorted((str(r[:-3]), round(r["score"], 9), r["prediction"]) for r in df.collect())
        assert near(a) == near(b) and len(near(a)) == 5


def test_terms_of_rows_with_equal_ids_stay_apart(spark, fitted, articles):
    text = articles.first()["text"]
    docs = spark.createDataFrame([(1, text), (1, text), (None, text)], "id bigint, text string")
    small = fitted.vocabulary
    large = replace(small, size=LookupSize(10**9, 10**12))
    got = [sorted(map(str, ft.term_entries(docs, v, fitted.spec).collect())) for v in (small, large)]
    assert got[0] == got[1] and got[0]
