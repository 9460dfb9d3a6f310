import json

import pytest
from pyspark.sql import functions as F

from lectern.operators import clean as cl
from lectern.operators import models as md
from lectern.operators.evaluate import classification_metrics
from lectern.operators.features import FeatureSpec
from lectern.plans import presets as ps
from lectern.plans import runs
from lectern.sources import readers as rd
from lectern.sources import sinks

LOGREG = md.ModelSpec("logreg", {"maxIter": 5, "regParam": 0.1})
PRESET = ps.Preset(features=FeatureSpec(vocab_size=40, min_df=2), models=(LOGREG,))


@pytest.fixture(scope="module")
def crowded(articles):
    """With copies, short and null texts: 120 rows stay of 183."""
    copies = articles.filter("id < 40").withColumn("id", F.col("id") + 1000)
    short = articles.filter("id < 20").withColumns({"id": F.col("id") + 2000, "text": F.lit("short")})
    null = articles.filter("id < 3").withColumns({"id": F.col("id") + 3000, "text": F.lit(None).cast("string")})
    return articles.unionByName(copies).unionByName(short).unionByName(null)


@pytest.fixture(scope="module")
def run(crowded):
    return runs.train(crowded, PRESET, account=True)


def test_accounted_rows_equal_the_report_of_the_cleaner(run, crowded):
    want = cl.clean_report(crowded).first().asDict()
    assert {k: run.dataset[k] for k in want} == want
    assert (want["rows_before"], want["rows_after"]) == (183, 120)


@pytest.mark.parametrize("options", [{"sample_rows": 30}, {"sample_fraction": 0.5}])
def test_rows_are_counted_before_sampling_and_without_a_key(crowded, options):
    for key in ("id", None):
        sampled = ps.Preset(**{**PRESET.__dict__, **options})
        found = runs.train(crowded, sampled, key=key, account=True).dataset
        assert (found["rows_before"], found["rows_after"]) == (183, 120)


def test_runs_accumulate_and_a_rerun_replaces_itself(spark, run, tmp_path):
    folder = str(tmp_path)
    names = [runs.save_run(run, folder)["run_id"] for _ in range(2)]
    assert len(set(names)) == 2
    runs.save_run(run, folder, names[0])
    compared = rd.read_reports(spark, f"{folder}/comparisons").collect()
    assert sorted(r["run_id"] for r in compared) == sorted(names)
    assert all(r["f1"] == run.metrics[0]["f1"] for r in compared)
    reports = {r["run_id"]: json.loads(r["report"]) for r in rd.read_reports(spark, f"{folder}/runs").collect()}
    assert set(reports) == set(names)
    assert all(r["dataset"]["rows_after"] == 120 and r["run_id"] == n for n, r in reports.items())


def test_run_names_stay_text_and_fields_may_differ(spark, tmp_path):
    folder = str(tmp_path / "reports")
    sinks.record_report(spark.createDataFrame([(1, 0.5)], "a int, f1 double"), folder, "007")
    sinks.record_report(spark.createDataFrame([(2, "x")], "a int, note string"), folder, "8")
    rows = {r["run_id"]: (r["a"], r["f1"], r["note"]) for r in rd.read_reports(spark, folder).collect()}
    assert rows == {"007": (1, 0.5, None), "8": (2, None, "x")}


def _rows(run):
    rows = md.as_training_rows(run.features.transform(run.documents), "id", "split")
    return (rows.filter(F.col("split") == s).drop("split") for s in ("train", "test"))


def test_a_grid_equals_single_fits(run):
    train, test = _rows(run)
    grid = [{"regParam": 0.01}, {"regParam": 5.0, "maxIter": 2}, {"regParam": 0.01}]
    found = md.fit_grid(train, test, LOGREG, grid)
    assert list(found) == ["logreg(regParam=0.01)", "logreg(maxIter=2, regParam=5.0)"]
    table = {r["model"]: r for r in md.grid_table(found, test).collect()}
    for name, trained in found.items():
        single = md.fit_models(train, test, [trained.spec])[0]
        assert trained.model.coefficients.toArray() == pytest.approx(single.model.coefficients.toArray(), abs=1e-9)
        want = classification_metrics(single.predictions).first().asDict()
        assert {k: table[name][k] for k in want} == pytest.approx(want)
    assert trained.spec.params == {"maxIter": 2, "regParam": 5.0}
    best = max(table.values(), key=lambda r: (r["f1"], -list(found).index(r["model"])))
    assert [name for name, r in table.items() if r["best"]] == [best["model"]]


def test_a_grid_of_trees_and_margins(run):
    train, test = _rows(run)
    for name, grid in (("linearsvc", [{"regParam": 0.1}, {"regParam": 1.0}]), ("gbt", [{"maxDepth": 1}])):
        spec = md.ModelSpec(name, {"maxIter": 2})
        table = md.grid_table(md.fit_grid(train, test, spec, grid), test).collect()
        assert len(table) == len(grid) and sum(r["best"] for r in table) == 1


def test_unknown_parameters_are_named(run):
    train, test = _rows(run)
    with pytest.raises(ValueError, match=r"logreg has no parameters \['depth'\]"):
        md.fit_grid(train, test, LOGREG, [{"depth": 3}])
