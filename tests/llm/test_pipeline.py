import importlib.util
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lectern.llm.oracle import ORACLE
from lectern.llm.queries import QUERIES, tokenizer_path

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_keep_the_columns(spark, docs_of, tmp_path):
    clean = " ".join(f"word{i}" for i in range(60))
    leak = "one two three four five six seven eight nine ten eleven"
    rows = [(1, clean), (2, clean + " more"), (3, f"x {leak} y"), (4, "write to me@here.org"), (5, None), (6, "..."), (1, clean)]
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = docs_of(rows)
    kept = {"language_id": [1, 1, 2, 3, 4], "near_duplicates": [1, 1, 3, 4], "decontamination": [1, 1, 4], "personal_data": [1, 1, 4]}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        assert sorted(r["doc_id"] for r in docs.collect()) == kept[name], name
    assert {r["text"] for r in docs.collect()} == {clean, "write to <EMAIL>"}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in packed) == [1, 1, 4] and {r["sequence_id"] for r in packed} == {0}


def similarity(x, y, k=5):
    """Jaccard similarity of the k-word shingles of two texts, as (overlap, union)."""
    a, b = (words_in_runs(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), k) for t in (x, y))
    return len(a & b), len(a | b)


def words_in_runs(words, k):
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def first_of_groups(rows):
    """The rows (id, text) without a linked row of smaller id, by comparing all pairs."""
    label = [i for i, _ in rows]
    links = []
    for x in range(len(rows)):
        for y in range(x):
            overlap, union = similarity(rows[x][1], rows[y][1])
            if union and 100 * overlap >= 80 * union:
                links.append((x, y))
    while any(label[x] != label[y] for x, y in links):
        for x, y in links:
            label[x] = label[y] = min(label[x], label[y])
    return [row for row, low in zip(rows, label, strict=True) if low == row[0]]


def near_copies(seed):
    """Texts of which some have 5-word similarities of 0.80 to 0.85 and less than 0.85 in 4 words."""
    rng, rows = random.Random(seed), []
    for n in range(12):
        base = [f"t{n}w{i}" for i in range(rng.choice([60, 100, 140]))]
        rows.append((10 * n, " ".join(base)))
        for i in range(1, 5):
            tail = [f"t{n}x{i}y{j}" for j in range(rng.randint(len(base) // 9, len(base) // 4))]
            rows.append((10 * n + i, " ".join(base + tail)))
    rng.shuffle(rows)
    return rows


def test_near_copies_below_the_settings_of_op4(spark, docs_of):
    rows = near_copies(4)
    by = dict(rows)
    between = [
        i for i in by if i % 10 and 0.80 <= (j := similarity(by[i], by[i // 10 * 10]))[0] / j[1] < 0.85
        and (f := similarity(by[i], by[i // 10 * 10], 4))[0] / f[1] < 0.85
    ]
    assert len(between) >= 5
    got = corpus_pipeline.near_duplicates(spark, docs_of(rows), "")
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == sorted(first_of_groups(rows))


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert 0 < got.select("doc_id").distinct().count() <= 200


def leaks(text, items):
    """Whether a text holds a run of 10 words of an item, or all words of a shorter one."""
    split = lambda t: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words = split(text)
    runs = {tuple(words[i : i + n]) for n in range(1, 11) for i in range(len(words) - n + 1)}
    return any(words_in_runs(split(t), 10) & runs for t in items)


def stages_by_hand(rows, items):
    """(id, text) left by the first three stages."""
    lettered = [(i, t) for i, t in rows if t and any(map(str.isalpha, t))]
    return [(i, t) for i, t in first_of_groups(lettered) if not leaks(t, items)]


def pieces_of(rows, capacity=2048):
    """Counts of (id, piece, start, length, ids_crc32)."""
    whole, out = Tokenizer.from_file(tokenizer_path()), Counter()
    for i, t in rows:
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out[i, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def assert_sequences(got, capacity=2048):
    filled = defaultdict(list)
    for r in got:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= capacity
    assert sorted(filled) == list(range(len(filled)))


PII = {
    r"[a-z.]+@[a-z]+\.org": "<EMAIL>",
    r"\b10\.0\.[0-9]+\.[0-9]+\b": "<IP>",
    r"4539148803436467": "<CARD>",
    r"\+4930901820123": "<PHONE>",
}


def test_run_equals_the_stages_by_hand(spark, docs_of, tmp_path):
    """On planted documents whose personal data is of the kinds that always stay."""
    rng = random.Random(8)
    item = " ".join(f"leak{i}" for i in range(14))
    items = [item, "Short item, four words", "", None]
    rows = near_copies(6)
    rows += [(200 + i, f"{i} start {' '.join(item.split()[k:][:n])} end") for i, (k, n) in enumerate([(0, 10), (4, 10), (0, 9), (5, 9)])]
    rows += [(210, "a SHORT item; four words b"), (211, "short item four"), (220, None), (221, ""), (222, "12 ... 34"), (223, "\u6f22\u5b57 x")]
    rows += [(230, "write to me.you@here.org, or 10.0.3.7 now"), (231, "pay 4539148803436467 and call +4930901820123, bye")]
    rows += [(240, " ".join(f"long{rng.randrange(900)}" for _ in range(5000))), (5, rows[0][1]), (None, rows[1][1]), (240, "another text of that id")]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    with_id = [(i, t) for i, t in rows if i is not None]
    left = stages_by_hand(with_id, items) + [(i, t) for i, t in rows if i is None]
    for pattern, kind in PII.items():
        left = [(i, re.sub(pattern, kind, t)) for i, t in left]
    assert sum("<" in t for _, t in left) == 2
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == pieces_of(left)
    assert_sequences(got)


def test_run_keeps_the_ids_by_hand(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == {i for i, _ in stages_by_hand(rows, items)}
    assert_sequences(got)


def test_entry_without_the_package():
    """With the package and the pipeline out of reach, the other queries remain."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('lectern.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "q = e.queries()\n"
        "assert 'clean_text' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q)\n"
    )
    env = os.environ | {"PYTHONPATH": str(ROOT)}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, env=env)


def test_nothing_else_imports_the_package():
    assert importlib.util.find_spec("lectern.llm")
    for path in [*ROOT.glob("lectern/**/*.py"), *ROOT.glob("catalog/*.py")]:
        if "llm" not in path.parts:
            assert "lectern.llm" not in path.read_text(), path
