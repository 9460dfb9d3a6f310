import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import lmscore as lm
from lectern.llm.queries import QUERIES

#: So many probes that no unseen n-gram seems seen.
SURE = lm.ModelSettings(probes=(24, 24), prior=5.0)


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    out, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + [None]


def grams(words, k):
    """The k-grams by where they end; one word may lie before the first."""
    padded = [None] + words
    return {i: tuple(padded[i + 2 - k : i + 2]) for i in range(len(words)) if i + 2 - k >= 0}


def brute(rows, settings=SURE):
    learned = [tokens(t) for i, t in rows if not held_out(i)]
    counts = [Counter(g for w in learned for g in (grams(w, k) if k > 1 else {i: (x,) for i, x in enumerate(w)}).values())
              for k in range(1, settings.order + 1)]
    n, v = sum(counts[0].values()), len(counts[0])
    by_level = defaultdict(list)
    for k, c in enumerate(counts):
        for x in c.values():
            by_level[k, x.bit_length()].append(x)

    def rounded(k, gram):
        x = counts[k - 1][gram]
        every = by_level[k - 1, x.bit_length()]
        return sum(every) / len(every) if x else 0.0

    out = []
    for i, text in rows:
        words = tokens(text)
        total, base, places = 0.0, 0.0, {k: grams(words, k) for k in range(2, settings.order + 1)}
        held = {}
        for at, w in enumerate(words):
            base += math.log10((counts[0][(w,)] + 0.5) / (n + 0.5 * (v + 1)))
            shorter = held[1, at] = rounded(1, (w,))
            p = (shorter + 0.5) / (n + 0.5 * (v + 1))
            for k in range(2, settings.order + 1):
                if at in places[k]:
                    before = rounded(1, (None,)) if at == 0 else held[k - 1, at - 1]
                    shorter = held[k, at] = min(rounded(k, places[k][at]), shorter, before)
                    p = (shorter + settings.prior * p) / (before + settings.prior)
                else:
                    held[k, at] = 0.0
            total += math.log10(p)
        known = sum(counts[0][(w,)] > 0 for w in words)
        out.append((i, held_out(i), len(words), known, n, pytest.approx(base, abs=1e-6), pytest.approx(total, abs=1e-6)))
    return out


def result(docs, settings=SURE):
    return [tuple(r) for r in lm.score_documents(docs, settings).collect()]


def by_row(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


ROWS = [
    (1, "the cat sat on the mat and THE cat ran"),
    (2, "the dog sat on the mat"),
    (3, None),
    (4, ""),
    (5, " \t\r\n\x0b\x0c "),
    (6, "one"),
    (None, "the cat sat"),
    (7, "the cat sat on the mat and the cat ran"),
    (7, "another text of the same id"),
    (8, "a b   c \x1c d é É"),
    (9, "unseen words only, " * 40),
    (10, "x" * 5000),
    (11, "the end . " * 3000),
]


def test_equals_brute_force(docs_of):
    assert by_row(result(docs_of(ROWS))) == by_row(brute(ROWS))


def test_trigrams(docs_of):
    settings = lm.ModelSettings(order=3, probes=(24, 24), prior=5.0)
    assert by_row(result(docs_of(ROWS), settings)) == by_row(brute(ROWS, settings))


def test_passes_parts_and_shuffled_words_change_nothing(docs_of):
    whole = by_row(result(docs_of(ROWS)))
    cut = lm.ModelSettings(probes=(24, 24), prior=5.0, pass_bytes=200, part_tokens=64, hot_share=8)
    docs = docs_of(ROWS).withColumn("held_out", F.lit(False)).select("doc_id", "held_out", "text")
    model = lm.fit(docs, cut)
    assert model.parts > 5 and len(model.passes) > 2
    got = by_row(result(docs_of(ROWS), cut))
    assert [r[:5] for r in got] == [r[:5] for r in whole]
    for a, b in zip(got, whole, strict=True):
        assert a[5:] == pytest.approx(b[5:], abs=1e-9)


def test_small_documents(small):
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    settings = lm.ModelSettings(probes=(24, 24))
    assert by_row(result(small, settings)) == by_row(brute(rows, settings))


def test_default_filter_is_nearly_exact(small):
    settings = lm.ModelSettings()
    exact = {r[0]: r[6] for r in result(small, lm.ModelSettings(probes=(24, 24)))}
    near = {r[0]: r[6] for r in result(small, settings)}
    apart = sorted(abs(near[i] - exact[i]) / abs(exact[i]) for i in exact)
    assert apart[len(apart) // 2] < 0.01 and apart[len(apart) * 9 // 10] < 0.05


def test_empty_tables(docs_of, spark):
    assert result(docs_of([])) == []
    only = next(i for i in range(100) if held_out(i))
    assert result(docs_of([(only, "nothing learned")])) == [(only, True, 3, 0, 0, 0.0, 0.0)]


def test_levels_are_never_too_low():
    rng = np.random.default_rng(3)
    names = np.unique(rng.integers(1, 1 << 62, 5000, dtype=np.uint64))
    counts = rng.integers(1, 4000, len(names))
    data, bits = lm.build_part(names, counts, (7, 3))
    held = lm.Filter(1, 0, np.array([bits], np.uint64), np.array([0]), np.frombuffer(data, np.uint8), (7, 3))
    found, true = held.levels(names), lm.levels_of(counts)
    assert (found >= true).all() and (found > true).mean() < 0.2
    others = np.setdiff1d(rng.integers(1, 1 << 62, 20000, dtype=np.uint64), names)
    assert (held.levels(others) > 0).mean() < 0.02


def test_word_hashes_do_not_depend_on_place_or_pieces(monkeypatch):
    text = ("some words  and \t" + "y" * 300 + " more of them ") * 3
    whole = lm.Grams(1).words(text.encode())
    assert len(set(whole[:6])) == 6 and (whole[:7] == whole[7:14]).all()
    monkeypatch.setattr(lm, "_CHUNK_BYTES", 64)
    assert (lm.Grams(1).words(text.encode()) == whole).all()


def test_counts_follow_the_whole_corpus(spark, docs_of):
    docs = docs_of(ROWS).select("doc_id", "text").withColumn("held_out", F.lit(False))
    counts = lm.count_words(docs)
    every = Counter(w for _, t in ROWS for w in tokens(t))
    assert (counts.tokens, counts.types) == (sum(every.values()), len(every))


def test_query_covers_all_rows(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op11_lm_scoring"](spark, folder)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_the_driver_holds_a_bounded_share_of_a_pass(docs_of, monkeypatch):
    cut = lm.ModelSettings(probes=(24, 24), prior=5.0, part_tokens=64)
    whole = by_row(result(docs_of(ROWS), cut))
    docs = docs_of(ROWS).withColumn("held_out", F.lit(False)).select("doc_id", "held_out", "text")
    model = lm.fit(docs, cut)
    assert len(model.passes) == 1 and len(model.shared(*model.passes[0])) == 1
    monkeypatch.setattr(lm, "SHARED_BYTES", 200)
    held = [x.value for x in model.shared(*model.passes[0])]
    assert len(held) > 2 and all(len(h.data) <= 200 + 8 * len(h.bits) for h in held)  # 8 for a part without n-grams
    names = np.unique(lm.Grams(2).of([t for _, t in ROWS])[0][0])
    assert (lm.levels_among(held, names) > 0).all()
    for a, b in zip(by_row(result(docs_of(ROWS), cut)), whole, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-9)
