import random
import re

import numpy as np
import pytest

from lectern.llm import jaccard as jc

BIG = (1 << 60) + 1  # no floating-point number


def shingle_set(text, k=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows):
    """(doc_id, size, smallest id reachable) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    label = [i for i, _ in rows]
    changed = True
    linked = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return sorted((i, len(s), x) for (i, _), s, x in zip(rows, sets, label, strict=True))


def edited(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(1000)}"
    return out


def corpus(seed):
    rng = random.Random(seed)
    rows, texts = [], []
    for size in [1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 20, 40, 90, 200, 333, 700]:
        base = [f"w{rng.randrange(300)}" for _ in range(size)]
        texts += [base, base, [*base, "tail"]] + [edited(base, rng, rng.choice([0, 1, 1, 2, 3, size // 30 + 1])) for _ in range(6)]
    rng.shuffle(texts)
    for i, words in enumerate(texts):
        rows.append((i * 3 % len(texts) * 7 + i, rng.choice([" ", "\n", "  \t"]).join(words)))
    return list(dict(rows).items())


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, docs_of, seed):
    rows = corpus(seed)
    got = jc.near_duplicates(docs_of(rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_group_of_near_copies(spark, docs_of, monkeypatch):
    monkeypatch.setattr(jc, "BLOCK_SETS", 16)  # several blocks per tile
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(base, rng, rng.choice([0, 1, 2, 3, 4, 5])))) for i in range(120)]
    rows += [(500 + i, " ".join(base)) for i in range(60)]
    got = jc.near_duplicates(docs_of(rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_real_documents(small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    assert sorted(map(tuple, jc.near_duplicates(small).collect())) == brute(rows)


def test_linked_sets_share_a_tile():
    rng = np.random.default_rng(3)
    settings = jc.JoinSettings()
    for size in [1, 2, 6, 7, 8, 13, 14, 50, 100, 199, 200, 201, 1000, 5000]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            drop = rng.integers(0, size // 6 + 1)
            fresh = rng.integers(0, 1 << 63, rng.integers(0, size // 6 + 1), dtype=np.uint64)
            b = np.unique(np.concatenate([a[drop:], fresh]))
            if len(b) and settings.linked(len(np.intersect1d(a, b)), len(a) + len(b)):
                assert np.intersect1d(jc.tile_keys(a, settings), jc.tile_keys(b, settings)).size
                bits = [jc.bitmap(x) for x in (a, b)]
                nbytes = min(map(len, bits))
                apart = int(np.bitwise_count(jc.folded(bits[0], nbytes) ^ jc.folded(bits[1], nbytes)).sum())
                assert settings.linked((len(a) + len(b) - apart) // 2, len(a) + len(b))


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    nodes = list(range(60))
    rng.shuffle(nodes)
    links = [(nodes[i], nodes[i + 1]) for i in range(39)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(map(tuple, jc.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    low = min(nodes[:40])
    assert all(got[n] == low for n in nodes[:40]) and all(got[100 + i] == 100 for i in range(30))


def test_hot_ends_are_split(spark, monkeypatch):
    monkeypatch.setattr(jc, "HOT_PAIRS", 10)
    rows = [(0, i) for i in range(1, 96)] + [(i, 200) for i in range(1, 41)] + [(300, 301)]
    pairs = spark.createDataFrame(rows, "a long, b long")
    hot = jc.hot_ends(pairs)
    assert sorted(map(tuple, hot.collect())) == [(0, 10), (200, 4)]
    sets = spark.createDataFrame([(i, f"s{i}") for i in range(400)], "set_id long, name string")
    got = jc.joined_ends(pairs, sets, hot).select("a", "b", "name_a", "name_b")
    assert sorted(map(tuple, got.collect())) == sorted((a, b, f"s{a}", f"s{b}") for a, b in rows)
    found = {r["node"]: r["component"] for r in jc.components(pairs).collect()}
    assert found == {x: 300 if x >= 300 else 0 for pair in rows for x in pair}


def test_edge_rows(spark, docs_of):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \n"), (BIG + 1, "One two"), (BIG, "one TWO"), (3, long), (4, long + " y"), (4, long + " y"), (None, long)]
    got = sorted(map(tuple, jc.near_duplicates(docs_of(rows)).collect()), key=str)
    want = [(5, 0, 5), (6, 0, 6), (7, 0, 7), (BIG + 1, 1, BIG), (BIG, 1, BIG), (3, 29997, 3), (4, 29998, 3), (4, 29998, 3), (None, 29997, None)]
    assert got == sorted(want, key=str)
    kept = jc.keep_first(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["5", "6", "7", str(BIG), "3", "None"])


def test_copies_add_no_rows_to_tiles(spark, docs_of, monkeypatch):
    monkeypatch.setattr(jc, "HOT_PAIRS", 10)  # the copies and the null texts are hot
    base = [f"w{i}" for i in range(50)]
    texts = [" ".join(base)] * 60 + [" ".join([*base, "x"]), " ".join(["y", *base]), "other words"] + [None] * 30
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = docs_of([(None, texts[0]), *rows])
    signed = jc.signatures(docs.coalesce(1), jc.JoinSettings()).collect()
    assert [r["doc_id"] for r in signed if r["keys"] is not None] == [0, 60, 61, 62]
    assert [r["doc_id"] for r in signed if r["bits"] is not None] == [0, 60, 61, 62]
    got = jc.near_duplicates(docs).collect()
    assert sorted(tuple(r) for r in got if r["doc_id"] is not None) == brute(rows)
    assert [tuple(r) for r in got if r["doc_id"] is None] == [(None, 47, None)]
    named = spark.createDataFrame([(1, 11, 5), (2, 10, 6), (3, 99, None)], "set_id bigint, n bigint, head bigint")
    few = spark.createDataFrame([(i, s) for i, s in enumerate([1, 1, 2, 3, 4, None])], "doc_id bigint, set_id bigint")
    heads = jc.with_heads(few, named).select("doc_id", "head").collect()
    assert sorted(map(tuple, heads)) == [(0, 5), (1, 5), (2, 6), (3, None), (4, None), (5, None)]


def test_repeated_id_with_different_texts(spark, docs_of):
    """Only the row that a kept document stands for is dropped, whatever its id's other texts."""
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(3, a), (5, a), (5, b), (5, None), (5, ""), (None, a), (None, None), (7, b + " tail"), (3, a)]
    want = [(3, a), (5, b), (5, None), (5, ""), (None, a), (None, None), (3, a)]
    got = jc.keep_first(docs_of(rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_no_documents(spark, docs_of):
    assert jc.near_duplicates(docs_of([])).collect() == [] and jc.keep_first(docs_of([])).collect() == []
