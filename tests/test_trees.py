import random
from dataclasses import replace

import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lectern.operators import models as md
from lectern.operators import trees as tr
from lectern.operators.features import FeatureSpec
from lectern.plans import presets as ps
from lectern.plans import runs
from lectern.plans.storage import MAX_LOOKUP_BYTES

MODELS = {
    "randomforest": {"numTrees": 5, "maxDepth": 4, "seed": 42},
    "gbt": {"maxIter": 3, "maxDepth": 3, "seed": 42},
}


@pytest.fixture(scope="module")
def run(articles):
    """Every seventh label is wrong, so that no single word parts the classes."""
    specs = tuple(md.ModelSpec(name, params) for name, params in MODELS.items())
    noisy = F.when(F.col("id") % 7 == 0, 1 - F.col("label")).otherwise(F.col("label"))
    return runs.train(articles.withColumn("label", noisy), ps.Preset(features=FeatureSpec(vocab_size=40, min_df=2), models=specs))


@pytest.fixture(scope="module", params=list(MODELS))
def fitted(run, request):
    model = next(t.model for t in run.trained if t.name == request.param)
    return model, tr.Ensemble.build(tr.node_table(model))


def _by_model(run, model, docs):
    rows = model.transform(run.features.transform(docs))
    raw, chance = (vector_to_array(c)[1] for c in ("rawPrediction", "probability"))
    return {r["id"]: r[1:] for r in rows.select("id", raw, chance, "prediction").collect()}


def _by_table(run, ensemble, docs, **options):
    rows = tr.score_by_trees(docs, run.features, ensemble, **options)
    return {r["id"]: r[1:] for r in rows.select("id", "score", "probability", "prediction").collect()}


def test_scores_equal_those_of_the_model(run, fitted, articles):
    model, ensemble = fitted
    assert (ensemble.n_trees, ensemble.boosted) == (len(model.trees), "GBT" in type(model).__name__)
    docs = articles.select("id", "text")
    want, got = _by_model(run, model, docs), _by_table(run, ensemble, docs)
    assert len({w[0] for w in want.values()}) > 2
    assert want.keys() == got.keys()
    for key, row in want.items():
        assert got[key] == pytest.approx(row, abs=1e-12)


def test_large_tables_are_joined_without_a_broadcast(run, fitted, articles):
    _, ensemble = fitted
    large = replace(ensemble, size=replace(ensemble.size, nbytes=MAX_LOOKUP_BYTES + 1))
    docs = articles.select("id", "text").filter("id < 20")
    got, want = _by_table(run, large, docs), _by_table(run, ensemble, docs)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_repeated_null_and_empty_rows(run, fitted, spark):
    _, ensemble = fitted
    rows = [(1, "shocking miracle"), (1, "shocking miracle"), (None, "budget vote"), (2, None), (3, "")]
    docs = spark.createDataFrame([(*r, "kept") for r in rows], "id bigint, text string, tree string")
    scored = tr.score_by_trees(docs, run.features, ensemble).collect()
    assert sorted((r["id"] or 0, r["text"] or "-", r["tree"]) for r in scored) == sorted(
        (i or 0, t or "-", "kept") for i, t in rows
    )
    assert len({r["score"] for r in scored if r["id"] in (2, 3)}) == 1
    assert tr.score_by_trees(docs.limit(0), run.features, ensemble).count() == 0


def test_threshold_decides_by_probability(run, fitted, articles):
    _, ensemble = fitted
    got = _by_table(run, ensemble, articles.select("id", "text"), threshold=0.8)
    assert all(prediction == float(chance >= 0.8) for _, chance, prediction in got.values())


def test_walk_equals_a_walk_by_hand_over_dense_and_sparse_vectors(spark):
    rng = random.Random(3)
    cells = [[rng.choice([0.0, 0.0, 0.5, 1.5]) for _ in range(6)] for _ in range(90)]
    rows = [(i, float(sum(c) > 3 or c[0] > 1), Vectors.dense(c)) for i, c in enumerate(cells)]
    sparse = [(i, y, Vectors.sparse(6, [(j, x) for j, x in enumerate(v) if x])) for i, y, v in rows]
    table = spark.createDataFrame([r for pair in zip(rows[::2], sparse[1::2]) for r in pair], ["id", "label", "features"])
    model = RandomForestClassifier(numTrees=4, maxDepth=5, seed=5).fit(table)
    nodes = tr.node_table(model)
    by_node = {r["node"]: r for r in nodes.collect()}
    want = set()
    for i, values in enumerate(cells):
        for tree in range(4):
            at = by_node[tree << 32]
            while at["idx"] is not None:
                at = by_node[at["left"] if values[at["idx"]] <= at["threshold"] else at["right"]]
            want.add((i, at["node"]))
    got = tr.walk(table, tr.Ensemble.build(nodes), "id").collect()
    assert len(got) == len(want) and {(r["id"], r["node"]) for r in got} == want


def test_walk_moves_no_row_below_the_bounds(run, fitted, articles):
    _, ensemble = fitted
    plan = tr.walk(run.features.transform(articles), ensemble, "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_models_without_trees_and_torn_tables_are_errors(run, fitted):
    _, ensemble = fitted
    with pytest.raises(ValueError, match="no trees"):
        tr.node_table(run.features.pipeline)
    with pytest.raises(ValueError, match="not the nodes of one ensemble"):
        tr.Ensemble.build(ensemble.table.filter(F.col("tree") != 0))
    with pytest.raises(ValueError, match="not the nodes of one ensemble"):
        tr.Ensemble.build(ensemble.table.limit(0))


def test_a_model_of_bare_leaves(spark):
    rows = spark.createDataFrame([(float(i % 3 == 0), Vectors.sparse(2, {0: 1.0})) for i in range(30)], ["label", "features"])
    model = GBTClassifier(maxIter=2, maxDepth=2, seed=1).fit(rows)
    ensemble = tr.Ensemble.build(tr.node_table(model))
    assert ensemble.levels == 0
    assert tr.walk(rows.limit(3), ensemble, "label").count() == 3 * ensemble.n_trees


def test_saved_trees_score_without_the_model(run, articles, tmp_path):
    runs.save_run(run, str(tmp_path), "first")
    docs = articles.select("id", "text")
    for trained in run.trained:
        want = _by_model(run, trained.model, docs)
        scored = runs.score_saved(docs, str(tmp_path), trained.name, clean=False)
        got = {r["id"]: r[1:] for r in scored.select("id", "score", "probability", "prediction").collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
