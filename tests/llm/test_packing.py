import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lectern.llm import packing as pk
from lectern.llm.queries import tokenizer_path


def brute_sequences(lengths, capacity):
    """Best-fit by falling length, piece by piece."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        bisect.insort(gaps, gap - length)
    return len(gaps)


@pytest.mark.parametrize("capacity", [7, 50, 2048])
@pytest.mark.parametrize("n", [0, 1, 40, 2000])
def test_plan_equals_best_fit(capacity, n):
    rng = random.Random(capacity + n)
    lengths = [rng.choice([rng.randint(1, capacity), max(1, capacity // 3)]) for _ in range(n)]
    counts = Counter(lengths)
    plan = pk.best_fit(counts, capacity)
    assert plan.sequences == brute_sequences(lengths, capacity)
    filled = defaultdict(list)
    for length, runs in plan.runs.items():
        for rank in range(counts[length]):
            first, sequence, each, offset = [r for r in runs if r[0] <= rank][-1]
            nth = rank - first
            filled[sequence + nth // each].append((offset + nth % each * length, length))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity


ODD = [
    None,
    "",
    " \n\t ",
    "don't it's I'M we'll",
    "<|endoftext|>x <|startoftext|> y",
    "z\x1cq \x85 é ́x İSTANBUL ΣΑΣ",
    "12345 ​ ok﻿ 漢字 a.b,c.. Word, word. WORD",
    "word " * 5000,
]


def test_ids_equal_the_tokenizer(small):
    texts = [r["text"] for r in small.collect()] + ODD
    encoder = pk.ChunkEncoder(tokenizer_path())
    whole = Tokenizer.from_file(tokenizer_path())
    want = whole.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    for _ in range(2):  # the second time from memory
        got = encoder.encode(texts)
        assert all(list(g) == w.ids for g, w in zip(got, want, strict=True))


def test_documents_are_packed_without_gaps(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "a null id"), ((1 << 60) + 1, "large")]
    got = pk.pack_documents(docs_of(rows), tokenizer_path(), capacity=64).collect()
    whole = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for p, start in enumerate(range(0, len(ids), 64)):
            part = ids[start : start + 64]
            want.append((i, p, start, len(part), zlib.crc32(part.tobytes())))
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    filled = defaultdict(list)
    for r in got:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 64
    assert len(filled) == brute_sequences([w[3] for w in want], 64)


def test_no_documents(spark, docs_of):
    assert pk.pack_documents(docs_of([]), tokenizer_path()).collect() == []
