import hashlib

import pytest

from lectern.operators import sampling as sm


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def draw(i, seed=42):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


def test_sample_and_split_depend_on_keys_only(spark):
    df = spark.range(5000)
    for parts in (1, 7):
        again = df.repartition(parts)
        assert ids(sm.sample_rows(again, 0.1)) == [i for i in range(5000) if draw(i)[:8] < "19999999"]
        train, test = sm.split_rows(again)
        assert ids(train) == [i for i in range(5000) if draw(i)[:8] < "cccccccc"]
        assert sorted(ids(train) + ids(test)) == list(range(5000))
    assert ids(sm.sample_rows(df, 1.0)) == list(range(5000))
    assert ids(sm.sample_rows(df, 0.1, seed=1)) != ids(sm.sample_rows(df, 0.1))


def test_three_way_split_has_the_asked_sizes(spark):
    marked = sm.assign_split(spark.range(20000), {"a": 5, "b": 3, "c": 2})
    n = {r["split"]: r["count"] for r in marked.groupBy("split").count().collect()}
    assert abs(n["a"] - 10000) < 300 and abs(n["b"] - 6000) < 300 and abs(n["c"] - 4000) < 300


@pytest.mark.parametrize("n", [0, 1, 37, 900, 1000, 5000])
def test_random_rows_are_the_smallest_draws(spark, n):
    df = spark.range(1000).repartition(5)
    assert ids(sm.random_rows(df, n)) == sorted(sorted(range(1000), key=draw)[:n])


def test_random_rows_take_one_plan(spark):
    plan = sm.random_rows(spark.range(1000), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_split_by_text_keeps_copies_together(spark):
    df = spark.createDataFrame([(i, f"t{i % 10}") for i in range(100)], "id bigint, text string")
    marked = sm.assign_split(df, key="text")
    assert marked.select("text", "split").distinct().count() == 10


def test_null_keys_fail(spark):
    df = spark.createDataFrame([(None,)], "id bigint")
    with pytest.raises(Exception, match="null in key column"):
        sm.assign_split(df).collect()


def test_first_rows_and_positional_forms(spark):
    df = spark.range(500).repartition(6)
    assert ids(sm.first_rows(df, 7)) == list(range(7))
    assert 0 < sm.sample_rows_by_position(df, 0.5).count() < 500
    assert sum(p.count() for p in sm.split_rows_by_position(df)) == 500
