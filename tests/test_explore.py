from collections import Counter
import re
import statistics

import pytest

from lectern.functions.stopwords import ENGLISH_STOP_WORDS
from lectern.operators import explore as ex
from lectern.operators.ranking import top_k


@pytest.fixture(scope="module")
def rows(articles):
    return articles.collect()


def test_class_balance_and_guard(articles):
    assert [tuple(r) for r in ex.class_balance(articles).collect()] == [(0, 40), (1, 80)]
    assert ex.require_both_classes(articles) is articles
    for bad in (articles.filter("label = 1"), articles.limit(0)):
        with pytest.raises(ValueError, match="two classes"):
            ex.require_both_classes(bad)


def test_lengths(articles, rows):
    for label, stats, median in zip(
        (0, 1), ex.length_stats(articles).collect(), ex.length_median(articles).collect()
    ):
        sizes = [len(r["text"]) for r in rows if r["label"] == label]
        assert (stats["n"], stats["min_len"], stats["max_len"]) == (len(sizes), min(sizes), max(sizes))
        assert stats["avg_len"] == pytest.approx(statistics.mean(sizes))
        assert median["median_len"] == pytest.approx(statistics.median(sizes))
        assert median["avg_len"] == pytest.approx(statistics.mean(sizes))


def test_subject_pivot_with_null_subject(spark):
    data = [("a", 1)] * 5 + [("a", 0)] * 2 + [(None, 1)] * 6 + [("b", 0)] * 3 + [("c", 1)]
    df = spark.createDataFrame(data, "subject string, label int")
    assert [tuple(r) for r in ex.top_subjects(df, 3).collect()] == [("a", 7), (None, 6), ("b", 3)]
    # The null subject takes a place among the first three but joins nothing.
    assert [tuple(r) for r in ex.subject_label_pivot(df, 3).collect()] == [("a", 2, 5), ("b", 3, 0)]
    assert ex.restrict_to_top_subjects(df, 3).count() == 10


def test_word_counts_and_top_words(articles, rows):
    want = Counter()
    for r in rows:
        for w in re.split("[^a-zA-Z]+", r["text"].lower()):
            if len(w) >= 2 and w not in ENGLISH_STOP_WORDS:
                want[(r["label"], w)] += 1
    got = {(r["label"], r["word"]): r["n"] for r in ex.word_counts(articles).collect()}
    assert got == dict(want)
    for label in (0, 1):
        best = sorted((-n, w) for (lb, w), n in want.items() if lb == label)[:15]
        top = [r for r in ex.top_words_per_label(articles).collect() if r["label"] == label]
        assert [(-r["n"], r["word"]) for r in sorted(top, key=lambda r: r["rank"])] == best


@pytest.mark.parametrize("parts", [1, 9])
def test_top_k_per_group_and_overall(spark, parts):
    df = spark.range(300).selectExpr("id", "id % 3 as g", "(id * 37) % 101 as v").repartition(parts)
    data = [tuple(r) for r in df.collect()]
    got = {(r["g"], r["rank"], r["id"]) for r in top_k(df, ["v", "id"], 4, by=["g"]).collect()}
    want = set()
    for g in range(3):
        best = sorted((v, i) for i, gg, v in data if gg == g)[:4]
        want |= {(g, n + 1, i) for n, (v, i) in enumerate(best)}
    assert got == want
    overall = sorted((v, i) for i, g, v in data)[:4]
    ranked = sorted(top_k(df, ["v", "id"], 4).collect(), key=lambda r: r["rank"])
    assert [(r["v"], r["id"]) for r in ranked] == overall
