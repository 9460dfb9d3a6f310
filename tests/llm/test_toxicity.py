import re

from pyspark.sql import functions as F

from lectern.llm import toxicity as tx


def labels_of(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, toxic int, score int")


def test_held_out_insults_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = tx.scores(docs, labels).join(docs.select("doc_id", "text"), "doc_id").filter("held_out").collect()
    insult = re.compile(r"\b(?:idiot|moron|scum|trash|stupid|loser|clown|pathetic|worthless|disgusting)\b", re.I)
    hits = [r["predicted"] for r in got if insult.search(r["text"])]
    clean = [r["predicted"] for r in got if not insult.search(r["text"])]
    assert len(hits) > 10 and sum(hits) / len(hits) > 0.9 and sum(clean) / len(clean) < 0.01


def test_counterfactual_penalty_lowers_the_weight_of_a_group(spark, docs_of):
    # Toxic texts mention one group more often; the insult alone explains the label.
    rows, labels = [], []
    for i in range(240):
        toxic, group = i % 3 == 0, i % 12
        term = "muslim" if (group < 8 if toxic else group < 3) else "christian"
        rows.append((i, f"the {term} {'is awful scum' if toxic and i % 2 else 'people here'} today w{i % 17}"))
        labels.append((i, int(toxic)))
    docs, marks = docs_of(rows), labels_of(spark, labels)
    weight = lambda c: tx.fit_toxicity(docs, marks, tx.ToxicitySettings(min_z=2.0, counterfactual=c)).weights
    free, held = weight(0.0), weight(5.0)
    gap = lambda w: abs(w.get("muslim", 0) - w.get("christian", 0))
    assert gap(held) < 0.3 * gap(free)
    assert held["scum"] > 1


def test_swapping():
    groups = (("man", "woman"), ("a", "b", "c"))
    assert tx.swap_words({"man", "b", "x"}, groups) == {"woman", "c", "x"}
    assert tx.swap_words(set(), groups) == set()


def test_scores_equal_brute_force(spark, docs_of):
    model = tx.ToxicityModel({"bad": 2.0, "éa": -1.0}, -0.5)
    docs = docs_of([(1, "Bad bad ÉA"), (2, None), (3, ""), (4, "x " * 50_000 + "BAD"), (None, "bad")])
    got = docs.select("doc_id", tx.toxicity(docs, model).alias("s")).collect()
    sig = lambda z: 1 / (1 + 2.718281828459045**-z)
    want = {1: sig(0.5), 2: sig(-0.5), 3: sig(-0.5), 4: sig(1.5), None: sig(1.5)}
    assert all(abs(r["s"] - want[r["doc_id"]]) < 1e-9 for r in got)


def test_edge_rows(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "words"), (3, "words"), (None, "x")])
    for labels in ([], [(3, 1)], [(3, 1), (3, 0), (None, 1), (2, None), (99, 1)], [(2, 0), (3, 1)]):
        got = tx.scores(docs, labels_of(spark, labels)).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert tx.scores(docs_of([]), labels_of(spark, [(1, 1)])).collect() == []


def test_bounded_sample_and_empty_partitions(spark, docs_of):
    docs = docs_of([(i, "scum here" if i % 2 else "fine here") for i in range(100)]).repartition(30)
    labels = labels_of(spark, [(i, i % 2) for i in range(100)])
    model = tx.fit_toxicity(docs, labels, tx.ToxicitySettings(max_rows=40, min_rows=5))
    assert model.weights["scum"] > 1 and model.weights["fine"] < 0
    assert docs.select(F.max(tx.toxicity(docs, model))).first()[0] > 0.7
