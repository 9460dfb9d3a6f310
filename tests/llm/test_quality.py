import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import quality as ql

SETTINGS = ql.ResamplingSettings(buckets=512, fraction=0.4)


def brute_ratios(texts, targets, s):
    def model(chosen):
        counts = np.zeros(s.buckets)
        for t in chosen:
            for b in ql.Buckets(s.buckets).of(t):
                counts[b] += 1
        return np.log((counts + s.smoothing) / (counts.sum() + s.smoothing * s.buckets))

    return model(targets) - model(texts)


def corpus(docs_of):
    rows = [(i, f"good clear sentence number {i}") for i in range(30)] + [(100 + i, f"$$ buy {i} !!! $$") for i in range(30)]
    return rows, docs_of(rows + [(200, None), (201, ""), (None, "good clear"), (5, "good clear sentence number 5")])


def test_weights_and_draw_equal_brute_force(spark, docs_of):
    rows, docs = corpus(docs_of)
    labels = spark.createDataFrame([(i, 1 if i < 10 else 0) for i in [*range(20), 100, 101]], "doc_id bigint, quality int")
    got = ql.select_quality(docs, labels, SETTINGS).collect()
    texts = [r["text"] for r in docs.collect()]
    targets = [t for i, t in rows if i < 10] + ["good clear sentence number 5"]
    ratios = brute_ratios(texts, targets, SETTINGS)
    by_text = {r["doc_id"]: r for r in got}
    for i, t in rows:
        want = ratios[ql.Buckets(512).of(t)].mean()
        assert math.isclose(by_text[i]["log_weight"], want, rel_tol=1e-9)
    assert by_text[200]["log_weight"] == by_text[201]["log_weight"] == 0.0
    ranked = sorted(got, key=lambda r: (-r["key"], -1 if r["doc_id"] is None else r["doc_id"]))
    k = round(0.4 * len(got))
    last = (ranked[k - 1]["key"], ranked[k - 1]["doc_id"])
    want = [i < k or (r["key"], r["doc_id"]) == last for i, r in enumerate(ranked)]
    assert [r["selected"] for r in ranked] == want


def test_target_texts_weigh_more(small, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    got = ql.select_quality(small, labels.filter(~held)).join(labels.filter(held), "doc_id").collect()
    good = [r["log_weight"] for r in got if r["quality"] == 1]
    bad = [r["log_weight"] for r in got if r["quality"] == 0]
    wins = np.mean([a > b for a in good for b in bad])
    assert wins > 0.8


@pytest.mark.parametrize("k", [1, 7, 50, 99, 100])
def test_kth_key(spark, k):
    rows = [(i, float(i * 37 % 101) ** 3) for i in range(99)] + [(3, 3.0 * 37 % 101 ** 3)]
    keyed = spark.createDataFrame(rows, "doc_id bigint, key double")
    ranked = sorted(((-v, i) for i, v in rows))
    got = ql.kth_key(keyed, k, bins=4, few=5)
    assert got == (-ranked[k - 1][0], ranked[k - 1][1])
    assert ql.kth_key(keyed, 0) is None


def test_gumbel_depends_on_id_and_seed(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    row = ids.select(F.avg(ql.gumbel("doc_id", 1)), F.count_distinct(ql.gumbel("doc_id", 1))).first()
    assert abs(row[0] - 0.5772) < 0.05 and row[1] == 20_000


def test_no_labels_and_no_rows(spark, docs_of):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = ql.select_quality(docs_of([(1, "a"), (2, "b")]), none, SETTINGS).collect()
    assert {r["log_weight"] for r in got} == {0.0} and sum(r["selected"] for r in got) == 1
    assert ql.select_quality(docs_of([]), none, SETTINGS).collect() == []
