import numpy as np
from pyspark.sql import functions as F

from lectern.llm import language as lg


def brute_vector(text, letters):
    """Sum over words of the product of permuted letter vectors, trigram by trigram."""
    table, total = lg._symbols(), np.zeros(letters.third.shape[1])
    symbols = [0] + [int(table[ord(c)]) for c in text.lower()] + [0]
    for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
        if b:
            total += np.roll(letters.third[a], 2) * np.roll(letters.third[b], 1) * letters.third[c]
    return total


def test_bundles_equal_brute_force():
    letters = lg.Letters.draw(64)
    texts = ["The cat. sat", "", "  a ", "Éß 漢 1x2", "zz" * 50]
    got = letters.bundle(texts)
    for text, vector in zip(texts, got, strict=True):
        assert np.array_equal(vector, brute_vector(text, letters))


def test_prototypes_are_sums_of_their_texts(spark, docs_of):
    docs = docs_of([(1, "hello there"), (2, "general kenobi")]).unionByName(docs_of([(3, "bonjour")], "fr"))
    got = lg.fit_profiles(docs, dimensions=64)
    letters = lg.Letters.draw(64)
    want = brute_vector("hello there", letters) + brute_vector("general kenobi", letters)
    assert got.languages == ["en", "fr"]
    assert np.allclose(got.prototypes[0], want / np.linalg.norm(want))


def test_held_out_accuracy(small):
    got = lg.predictions(small).join(small.select("doc_id", "lang"), "doc_id")
    row = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert row[1] > 20 and row[0] > 0.95


def test_edge_rows(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "12 ?!"), (4, "x"), (5, "word " * 50_000), (None, "word"), (4, "x")])
    got = lg.predictions(docs).collect()
    assert len(got) == 7
    by = {(r["doc_id"], r["lang_pred"]) for r in got}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "en"), (None, "en")} == by
    assert all(0 <= r["score"] <= 1 for r in got) and all(r["held_out"] is not None for r in got)


def test_no_language_to_learn_and_no_rows(spark, docs_of):
    assert {r["lang_pred"] for r in lg.predictions(docs_of([(1, "abc")], None)).collect()} == {"und"}
    assert lg.predictions(docs_of([])).collect() == []


def test_too_many_languages_are_refused(spark, docs_of):
    docs = docs_of([(1, "a")], "x").unionByName(docs_of([(2, "b")], "y"))
    try:
        lg.fit_profiles(docs, dimensions=16, max_languages=1)
    except ValueError:
        return
    raise AssertionError("no error")


def test_stage_drops_only_unknown(spark, docs_of):
    docs = docs_of([(1, None), (2, "..."), (3, "some words"), (None, "more words"), (3, "some words")])
    kept = lg.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "3", "None"]


def test_stage_without_a_language_to_learn(spark, docs_of):
    docs = docs_of([(1, None), (2, "12 ..."), (3, "some words"), (None, "\u6f22"), (4, "")], None)
    for least in (0.0, 0.5):
        kept = lg.keep_identified(docs, least)
        assert kept.columns == docs.columns
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "None"]
    assert lg.keep_identified(docs_of([], None)).collect() == []
