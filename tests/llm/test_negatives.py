import math
import random

import numpy as np
import pytest

from lectern.llm import negatives as ng

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)


def brute(rows):
    live = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        cells = [math.floor(256 * float(np.float32(x))) for x in v]
        live.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, cells))
    out, asked = [], {}
    for vec_id, label, cells in sorted(live):
        if vec_id % 50 == 0:
            asked.setdefault(vec_id, (label, cells))
    for anchor, (label, q) in asked.items():
        scored = [
            (-sum(a * b for a, b in zip(q, c, strict=True)), i, other == label)
            for i, other, c in live
            if i != anchor and len(c) == len(q)
        ]
        for s, positive, _ in sorted(x for x in scored if x[2])[:5]:
            p = -s
            fit = sorted((t, i) for t, i, same in scored if not same and 50 * p <= -100 * t <= 95 * p)
            out += [(anchor, positive, k + 1, i, p, -t) for k, (t, i) in enumerate(fit[:3])]
    return sorted(out)


def result(spark, rows, **kwargs):
    found = ng.mined(ng.usable(table(spark, rows), ng.MiningSettings()), **kwargs)
    return sorted(tuple(r) for r in found.collect())


def vectors(n, dims=8, labels=4, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0.3, 0.6) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


def test_equals_brute_force(spark):
    rows = vectors(400)
    assert len(brute(rows)) > 50
    assert result(spark, rows) == brute(rows)


def test_shards_and_passes_change_nothing(spark):
    rows = vectors(300, seed=2)
    assert result(spark, rows, shard_rows=20, scan_anchors=2) == brute(rows)


def test_ties_and_repeated_vectors(spark):
    rng = random.Random(3)
    kinds = [[rng.choice([0.25, 0.5, 1.0]) for _ in range(4)] for _ in range(5)]
    rows = [(i, rng.choice(kinds), rng.randrange(3)) for i in range(260)]
    rows += [(i, kinds[0], 1) for i in range(300, 500)]  # one vector very often
    assert result(spark, rows, shard_rows=64) == brute(rows)


def test_rows_that_take_no_part(spark):
    rows = vectors(120, dims=4)
    rows += [(150, None, 1), (200, [1.0, None, 0.0, 0.0], 1), (250, [float("nan")] * 4, 2), (300, [float("inf")] * 4, 1)]
    rows += [(350, [0.5] * 4, None), (None, [0.5] * 4, 1), (400, [], 1), (450, [0.3] * 6, 1), (451, [0.4] * 6, 1)]
    assert result(spark, rows) == brute(rows)


def test_repeated_ids(spark):
    rows = vectors(120, dims=4, labels=2) + vectors(120, dims=4, labels=2, seed=9)
    assert result(spark, rows) == brute(rows)


def test_negative_and_zero_scores(spark):
    rows = [(i, [0.5 if i % 2 else -0.5, 0.0], i % 3) for i in range(120)] + [(500, [0.0, 0.0], 1)]
    assert result(spark, rows) == brute(rows)


def test_large_components(spark):
    rows = [(i, [2.0**23 * (1 - i % 5 / 8), 2.0**23 * (0.5 - i % 4 / 4)], i % 3) for i in range(110)]
    assert max(r[5] for r in brute(rows)) > 1 << 60
    assert result(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="too large for a bigint"):
        result(spark, [(i, [2.0**40, 1.0], 0) for i in range(60)])
    with pytest.raises(Exception, match="too large for a bigint"):
        result(spark, [(0, [2.0**60], 0)])


def test_empty_tables(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, [0.5], 1)]) == []
    assert result(spark, [(50, [0.5], 1)]) == []


def test_scan_reads_less_than_everything():
    rng = np.random.default_rng(5)
    anchor = (1000 * 0.6 ** np.arange(16)).astype(np.int64)
    cells = rng.integers(-300, 300, (5000, 16))
    shard = ng.Shard(np.arange(5000), np.zeros(5000), list(cells.T))
    seen = []

    def keep(lower, upper):
        assert (lower <= upper).all()
        seen.append(len(lower))
        return upper >= np.sort(lower)[-5]

    rows, scores, read = shard.scan(anchor, np.ones(5000, bool), keep)
    assert (scores == cells[rows] @ anchor).all()
    assert set(np.argsort(-(cells @ anchor))[:5]) <= set(rows)
    assert read < 5000 * 16 / 2 and seen == sorted(seen, reverse=True)


def test_no_copies_of_candidates(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    plan = ng.hard_negatives(embeddings)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_looks_are_few_and_sums_exact_at_every_size():
    rng = np.random.default_rng(6)
    for size in (100, 1 << 28, 1 << 40):  # floating point, 64 bits, Python integers
        anchor, cells = rng.integers(-size, size, 64), rng.integers(-size, size, (500, 64))
        exact = cells.astype(object) @ anchor.astype(object)
        shard = ng.Shard(np.arange(500), np.arange(500) % 2, list(cells.T))
        seen = []
        keep = lambda lower, upper: seen.append((lower, upper)) or np.ones(len(lower), bool)
        rows, scores, _ = shard.scan(anchor, shard.labels == 0, keep)
        assert [int(x) for x in scores] == [int(x) for x in exact[rows]] and len(rows) == 250
        assert len(seen) <= 10 and (seen[-1][0] == seen[-1][1]).all()
        top = sorted((int(x) for x in exact[1::2]), reverse=True)
        windows = [(top[40], top[10]), (top[41], top[20]), (5, 4)]
        found = shard.negatives(0, anchor, windows, 3)
        assert [[int(x) for x in s] for _, s in found] == [top[10:13], top[20:23], []]
