import hashlib
import random
import re

from lectern.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    """(n_words, n_hit, sorted ids) by comparing every window at every place."""
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        runs = [b[i : i + 10] for i in range(len(b) - 9)] if len(b) >= 10 else [b] if b else []
        for run in runs:
            for i in range(len(w) - len(run) + 1):
                if w[i : i + len(run)] == run:
                    hit.update(range(i, i + len(run)))
                    found.add(item)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)


def check(spark, docs_of, texts, items, **options):
    docs = docs_of(list(enumerate(texts)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: r for r in dc.contamination(docs, bench, **options).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        n, hit, found = brute(text, items)
        row = got[i]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n, hit, len(found)), text
        assert row["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert row["contaminated"] == (hit > 0)


def random_case(seed, letters="abc"):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 9, 10, 11, 14]))) for i in range(8)]
    texts = [text(rng.randrange(60)) for _ in range(20)]
    texts += [f"{text(5)} {body} {text(3)}" for _, body in items]
    return texts, items


def test_random_against_brute_force(spark, docs_of):
    check(spark, docs_of, *random_case(1))
    check(spark, docs_of, *random_case(2, letters="abcdefghijkl"))


def test_several_passes_give_the_same(spark, docs_of):
    texts, items = random_case(3, letters="abcd")
    check(spark, docs_of, [*texts, None, "", texts[-1]], items, pass_windows=6)


def test_several_passes_keep_rows_of_equal_and_null_ids(spark, docs_of):
    docs = docs_of([(1, "a b c"), (1, "a b c"), (None, "x y"), (3, None), (4, "zz p q r zz"), (4, "clean")])
    bench = spark.createDataFrame([(1, "a b c"), (2, "p q r"), (3, "m n"), (4, "o")], "item_id bigint, text string")
    for passes in (1, 100):
        marked = dc.with_overlap(docs, bench, pass_windows=passes, out="hits")
        got = [(r["doc_id"], r["text"], r["hits"]["hits"], r["hits"]["items"]) for r in marked.collect()]
        want = [(1, "a b c", [0, 1, 2], ["1"])] * 2 + [(None, "x y", [], []), (3, None, [], [])]
        want += [(4, "zz p q r zz", [1, 2, 3], ["2"]), (4, "clean", [], [])]
        assert sorted(got, key=str) == sorted(want, key=str)
        kept = dc.remove_contaminated(docs, bench, pass_windows=passes)
        assert kept.columns == docs.columns
        assert sorted(str(r["text"]) for r in kept.collect()) == ["None", "clean", "x y"]


def test_chunks_hold_every_window_once():
    for n in (0, 1, 4, 9, 10, 11, 40, 41):
        text = [str(i).encode() for i in range(n)]
        runs = [tuple(c[i : i + 10]) for c in dc.chunks_of(text, 10, 7) for i in range(max(1, len(c) - 9))]
        assert runs == ([tuple(text[i : i + 10]) for i in range(max(1, n - 9))] if n else [])


def test_long_and_repeated_items(spark, docs_of):
    """An item over several chunks, and one text that very many items share."""
    rng = random.Random(4)
    long = [f"w{rng.randrange(300)}" for _ in range(9000)]
    cut = dc.CHUNK_WINDOWS
    texts = [" ".join(long[a : a + n]) for a, n in [(0, 12), (cut - 5, 10), (cut - 3, 30), (cut, 9), (8985, 15)]]
    items = [(0, " ".join(long)), *((i, "same words here") for i in range(1, 400)), (400, " ".join(long[cut - 1 :]))]
    texts += ["x same words here y", "same words", "here same words here"]
    for passes in (1 << 20, 3000):
        check(spark, docs_of, texts, items, pass_windows=passes)


def test_distinct_windows_are_held_once():
    """Repeated windows cost owners, not patterns; buckets hold them in order of prefixes."""
    text = b"a b c d e f g h i j k"
    tables = dc.WuManber([(text, ["1"]), (text + b" l", ["2"]), (b"a b", ["3"])])
    sizes = {t.length: (len(t.places), len(t.owners)) for t in tables.tables}
    assert sizes == {2: (1, 1), 10: (3, 5)}


def test_edge_rows(spark, docs_of):
    long = "w " * 20_000 + "one two three four five six seven eight nine ten " + "w " * 5
    texts = [None, "", " .;- ", "ONE two\nthree,four five six seven eight nine ten", "É é ß 漢字", long, "short item"]
    items = [
        (1, "one two three four five six seven eight nine ten"),
        (2, "One, two three four five six seven eight nine ten"),
        (10, "short item"),
        (None, "漢字"),
        (4, None),
        (5, ""),
        (1, "one two three four five six seven eight nine ten"),
    ]
    check(spark, docs_of, texts, items)


def test_empty_benchmark_and_documents(spark, docs_of):
    check(spark, docs_of, ["a b c"], [])
    check(spark, docs_of, [], [(1, "a b")])


def test_removal_keeps_columns_and_clean_rows(spark, docs_of):
    docs = docs_of([(1, "a b c"), (None, "x y"), (3, None), (3, None), (4, "zz a b c zz")])
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    kept = dc.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "3", "None"]
