import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import ranking as rk
from lectern.operators import sampling as sm
from lectern.plans.storage import materialize


def table(spark, values, kind="bigint"):
    rows = [(i, v) for i, v in enumerate(values)]
    return materialize(spark.createDataFrame(rows, f"id bigint, v {kind}").repartition(6), "values")


SHAPES = {
    "distinct": [(i * 7919) % 1000 for i in range(1000)],
    "ties": [i % 3 for i in range(300)],
    "one value": [5] * 200,
    "far apart": [0, 1, 2, 10**15, 10**15 + 1, -(10**15)],
    "single": [4],
}


@pytest.mark.parametrize("name", SHAPES)
def test_kth_cut(spark, name):
    values = SHAPES[name]
    df = table(spark, values)
    ordered = sorted(values, reverse=True)
    for k in {1, 2, len(values) // 2 or 1, len(values)}:
        if k <= len(values):
            t = ordered[k - 1]
            want = rk.Cut(t, sum(v > t for v in values), values.count(t))
            assert rk.kth_cut(df, "v", k, bins=4) == want
    assert rk.kth_cut(df, "v", len(values) + 1) is None and rk.kth_cut(df, "v", 0) is None


def test_kth_cut_of_close_doubles(spark):
    values = [1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.0, -0.5, 1e300]
    df = table(spark, values, "double")
    ordered = sorted(values, reverse=True)
    assert [rk.kth_cut(df, "v", k, bins=8).value for k in range(1, 7)] == ordered


@pytest.mark.parametrize("k", [0, 1, 99, 100, 101, 150, 300, 400])
def test_largest(spark, k):
    values = SHAPES["ties"]
    got = sorted(r["id"] for r in rk.largest(table(spark, values), "v", ["id"], k).collect())
    assert got == sorted(sorted(range(300), key=lambda i: (-values[i], i))[:k])


def test_nulls_come_in_no_place(spark):
    df = table(spark, [None, 3, None, 1])
    assert [r["id"] for r in rk.largest(df, "v", ["id"], 10).orderBy("id").collect()] == [1, 3]
    assert rk.largest(table(spark, []), "v", ["id"], 3).collect() == []


def ranked(df):
    return sorted(tuple(r) for r in df.collect())


def test_numbered_with_running_sums(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(20), i, rng.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, id int, w double").repartition(7)
    want = []
    for group in {r[0] for r in rows}:
        total = 0.0
        for rank, r in enumerate(sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2])), 1):
            total += r[3]
            want.append((r[2], rank, pytest.approx(total)))
    out = rk.numbered(df, [F.desc("v"), "id"], ["g"], "w").select("id", "rank", "running")
    assert ranked(out) == sorted(want, key=lambda r: r[0])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    windows = [line for line in plan.splitlines() if "+- Window" in line or ": Window" in line]
    assert windows and all("_part" in line for line in windows)


def test_a_single_group_covers_many_ranges(spark):
    df = spark.range(4000).select(F.col("id"), (F.col("id") % 5).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = rk._ordered_parts(df, ["v", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in parts.groupBy("_part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000
    got = rk.numbered(df, ["v", "id"]).orderBy("rank").select("id").collect()
    assert [r["id"] for r in got] == sorted(range(4000), key=lambda i: (i % 5, i))


def test_numbered_empty(spark):
    empty = spark.createDataFrame([], "g string, v int")
    assert rk.numbered(empty, ["v"], ["g"], "v").collect() == []


def test_very_many_random_rows(spark, monkeypatch):
    df = spark.range(3000).withColumn("text", F.lit("x"))
    few = sm.random_rows(df, 700)
    monkeypatch.setattr(sm, "GATHERED_ROWS", 10)
    many = sm.random_rows(df, 700)
    assert many.columns == df.columns and ranked(many) == ranked(few)
    assert sm.random_rows(df, 5000).count() == 3000
    assert "TakeOrdered" not in many._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [0, 1, 300, 1000, 5000])
def test_first_by_hash_equals_an_ordered_limit(spark, k):
    ids = spark.range(1000).withColumn("n", F.col("id") % 7)
    want = ids.orderBy(F.xxhash64("id"), "id").limit(k).collect()
    got = rk.first_by_hash(ids.repartition(5), "id", k).collect()
    assert sorted(got) == sorted(want)
