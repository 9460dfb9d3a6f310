import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import topk as tk


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        scored = sorted((-int(np.dot(v, c)), i) for i, c in rows if i != q and len(c) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("n, dims, spread", [(1, 3, 5), (5, 1, 2), (900, 8, 3), (1500, 16, 1000)])
def test_lists_equal_brute_force(n, dims, spread):
    rng = np.random.default_rng(n)
    vectors = rng.integers(-spread, spread + 1, (n, dims))
    ids = rng.permutation(n * 2)[:n]
    rows = list(zip(ids.tolist(), vectors, strict=True))
    queries = rows[:20] + [(-1, rng.integers(-spread, spread + 1, dims)), (-2, np.zeros(dims, int))]
    lists = tk.SortedLists(ids, vectors)
    own, asked = np.array([q for q, _ in queries]), np.stack([v for _, v in queries])
    got = []
    for q, found, score in lists.search(own, asked, 4):
        got += [(int(own[q]), r + 1, int(i), int(s)) for r, (i, s) in enumerate(zip(found, score, strict=True))]
    assert sorted(got) == brute(rows, queries, 4)


def test_shards_and_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [int(x) for x in rng.integers(-4, 5, 6)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # one very frequent vector
    table = spark.createDataFrame(rows, "vec_id bigint, cells array<bigint>")
    asked = table.filter("vec_id % 10 = 0")
    got = tk.top_k(table, asked, 5, shard_rows=60, query_rows=17).collect()
    want = brute([(i, np.array(v)) for i, v in rows], [(i, np.array(v)) for i, v in rows if i % 10 == 0], 5)
    assert sorted(map(tuple, got)) == want


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (100, None), (200, [1.0, None]), (300, [nan, 1.0]), (400, [inf, 1.0]),
        (500, []), (None, [1.0, 1.0]), (1, [1.0, 0.0001]), (2, [1.0, 0.0001]), (3, [-0.0001, 0.0]), (4, [1.0]),
    ]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, score int")
    got = tk.nearest(table)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 524288), (0, 2, 2, 524288), (0, 3, 3, -512)]
    assert tk.nearest(table.filter(F.lit(False))).collect() == []
    # Four candidates cannot fill ten ranks, and a repeated row is a candidate twice.
    twice = table.unionByName(table.filter("vec_id = 1"))
    assert [r["vec_id"] for r in tk.nearest(twice).orderBy("rank").collect()] == [1, 1, 2, 3]


def test_large_components(spark):
    """Scores of the contract up to the largest bigint, and an error beyond."""
    big = float(1 << 45)
    rows = [(0, [1.0, -big]), (1, [2 * big, big]), (2, [-big, 1.0]), (3, [3 * big, big]), (4, [0.0, -big / 1024])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    cells = {i: np.array([int(x * 1024) for x in v], dtype=object) for i, v in rows}
    got = {r["vec_id"]: r["cells"] for r in table.select("vec_id", tk.quantized(F.col("embedding")).alias("cells")).collect()}
    assert got == {i: list(c) for i, c in cells.items()}
    with pytest.raises(Exception, match="score is too large"):
        tk.nearest(table).collect()  # (0, 1) is -2**110
    small = [(0, [1.0, -1.0]), (1, [2.0**41, 1.0]), (5, [2.0**40, 2.0**40]), (6, [2.0**41 + 1, 1.0]), (7, [-(2.0**41), 2.0**41])]
    table = spark.createDataFrame(small, "vec_id bigint, embedding array<double>")
    best = brute([(i, [int(x * 1024) for x in v]) for i, v in small], [(0, [1024, -1024])], 10)
    assert sorted(map(tuple, tk.nearest(table).collect())) == best
    lists = tk.SortedLists(np.array([1, 2, 3]), np.array([[1 << 62, 1 << 62], [1 << 62, 1], [-(1 << 63), 0]]))
    found = list(lists.search(np.array([9]), np.array([[1 << 40, -3]]), 3))
    assert found[0][1].tolist() == [2, 1, 3]
    assert found[0][2].tolist() == [(1 << 102) - 3, (1 << 102) - 3 * (1 << 62), -(1 << 103)]
    for x in (2.0**53, -(2.0**54), 1e308):
        wide = spark.createDataFrame([(0, [x]), (1, [1.0])], "vec_id bigint, embedding array<double>")
        with pytest.raises(Exception, match="component is too large"):
            tk.nearest(wide).collect()
