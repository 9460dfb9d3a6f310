"""The registered queries against their SQL, on the smallest test tables."""

from collections import Counter
from functools import cache
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from catalog import oracle as catalog_oracle
from catalog import queries as catalog_queries
from catalog import tables as tb

duckdb = pytest.importorskip("duckdb")
FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.is_dir(), reason="test tables are absent")

QUERIES, ORACLE = catalog_queries.QUERIES, catalog_oracle.ORACLE


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def fit_once():
    """The fitted tables are written and do not change, so the tests share them."""
    patch = pytest.MonkeyPatch()
    for name in ("split_docs", "fit_train", "demo_model"):
        patch.setattr(tb, name, cache(getattr(tb, name)))
    yield
    patch.undo()


def test_every_statement_belongs_to_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, str(FOLDER))
    names = sorted(df.columns)
    got = Counter(tuple(r[n] for n in names) for r in df.collect())
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in plan
    order = [columns.index(n) for n in names]
    assert got == Counter(tuple(row[i] for i in order) for row in result.fetchall())


@pytest.mark.parametrize("name", ["clean_text", "clip_text", "strip_html", "parse_date"])
def test_cleaning_queries_do_not_shuffle(spark, name):
    plan = QUERIES[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
