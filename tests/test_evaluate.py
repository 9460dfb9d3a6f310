import pytest

from lectern.operators import evaluate as ev

# Two worked examples, with threshold and expected metrics.
EXAMPLES = [
    ([1, 0, 1, 1, 0], [0.9, 0.2, 0.6, 0.4, 0.1], 0.5),
    ([1, 0, 1, 1, 0], [2.1, -0.4, 0.3, -0.2, -1.1], 0.0),
]


def scored(spark, labels, scores):
    return spark.createDataFrame(
        [(i, lb, float(s)) for i, (lb, s) in enumerate(zip(labels, scores))], "id bigint, label int, score double"
    )


@pytest.mark.parametrize("labels,scores,threshold", EXAMPLES)
def test_worked_examples(spark, labels, scores, threshold):
    row = ev.metrics_at_thresholds(scored(spark, labels, scores), [threshold]).first()
    assert (row["tp"], row["tn"], row["fp"], row["fn"], row["total"]) == (2, 2, 0, 1, 5)
    assert row["accuracy"] == pytest.approx(0.8) and row["precision"] == 1.0
    assert row["recall"] == pytest.approx(2 / 3) and row["f1"] == pytest.approx(0.8)


def test_empty_and_one_sided_frames_give_zeros(spark):
    empty = spark.createDataFrame([], "label int, prediction double")
    row = ev.classification_metrics(empty).first()
    assert row.asDict() == dict.fromkeys(row.asDict(), 0)
    negatives = spark.createDataFrame([(0, 0.0)], "label int, prediction double")
    row = ev.classification_metrics(negatives).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_nulls_and_types(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (None, 1.0), (1.0, None), (0.0, 1.0)], "label double, prediction double"
    )
    row = ev.confusion_matrix(df).first()
    assert (row["tp"], row["tn"], row["fp"], row["fn"]) == (1, 0, 1, 0)
    nulls = spark.createDataFrame([(1, None), (None, 0.7), (1, 0.7)], "label int, score double")
    assert ev.metrics_at_thresholds(nulls, [0.5]).first()["total"] == 1


def test_groups_and_several_thresholds(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 0, 1.0), ("b", 1, 0.0)], "model string, label int, prediction double"
    )
    rows = {r["model"]: r for r in ev.classification_metrics(df, "model").collect()}
    assert (rows["a"]["tp"], rows["a"]["fp"], rows["b"]["fn"]) == (1, 1, 1)
    labels, scores, _ = EXAMPLES[0]
    table = ev.metrics_at_thresholds(scored(spark, labels, scores), [0.0, 0.5, 1.0]).collect()
    assert [(r["threshold"], r["tp"], r["fp"]) for r in table] == [(0.0, 3, 2), (0.5, 2, 0), (1.0, 0, 0)]


@pytest.mark.parametrize("parts", [1, 6])
def test_top_errors(spark, parts):
    rows = [(i, i % 2, float((i // 2) % 2), ((i * 31) % 17) - 8.0) for i in range(80)]
    df = spark.createDataFrame(rows, "id bigint, label int, prediction double, score double").repartition(parts)
    for kind, label in (("false_positive", 0), ("false_negative", 1)):
        want = sorted((-abs(s), i) for i, lb, p, s in rows if lb == label and p != lb)[:5]
        got = ev.top_errors(df).filter(f"error = '{kind}'").orderBy("rank").collect()
        assert [(-abs(r["score"]), r["id"]) for r in got] == want
    assert ev.false_positives(df, 2).count() == ev.false_negatives(df, 2).count() == 2
