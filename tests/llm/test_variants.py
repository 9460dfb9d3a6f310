import re
import zlib
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lectern.llm import variants as va
from lectern.plans.storage import materialize


def counted(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    forms, out = {}, []
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        forms[w] = (form, n, len(near), None if form is None else words[form])
    for w, (form, n, n_near, form_n) in forms.items():
        root = w
        while forms[root][0] is not None:
            root = forms[root][0]
        out.append((w, form, root, n, n_near, form_n))
    return sorted(out)


def grouped(spark, words, group_pairs=va.GROUP_PAIRS):
    table = materialize(spark.createDataFrame(list(words.items()), "word string, n bigint"), "words")
    return sorted(tuple(r) for r in va.variant_groups(table, group_pairs=group_pairs).collect())


FAMILY = {"colour": 40, "color": 90, "colours": 9, "colou": 3, "xolor": 4, "cooler": 4, "coloré": 30, "colar": 15}


def test_forms_and_roots(spark):
    assert grouped(spark, FAMILY) == brute(FAMILY)


def test_cutting_groups_further_changes_nothing(spark):
    words = {f"{a}{b}xyz{c}": 3 + i % 40 for i, (a, b, c) in enumerate((a, b, c) for a in "abcdé" for b in "stu" for c in "pqrsÿ")}
    words |= {f"{w}k": 100 for w in list(words)[:10]}
    assert grouped(spark, words, 0) == brute(words)


def test_ties_go_to_the_first_in_code_point_order(spark):
    words = {"abcde": 3, "abcdz": 9, "abcdé": 9, "zbcde": 9}
    found = {r[0]: r[1] for r in grouped(spark, words)}
    assert found["abcde"] == "abcdz"
    assert grouped(spark, words) == brute(words)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.text("abé", min_size=5, max_size=7), st.integers(3, 50), min_size=1, max_size=40))
def test_random_words(spark, words):
    assert grouped(spark, words, 4) == brute(words)


def test_documents(spark, docs_of):
    rows = [(i, "Strasse STRASSE strasse strase, strasße Übung übung Übung Übungen x" + " verylong" * (i % 5)) for i in range(60)]
    rows += [(None, "strasse"), (7, None), (8, ""), (9, "1234 -- ;"), (10, "a" * 20000), (11, "a" * 20000), (12, "a" * 20000)]
    rows += [(13, "cafés"), (13, "cafés"), (13, "cafés"), (14, "×÷abc œuvre")] * 3
    got = sorted(tuple(r) for r in va.spelling_variants(docs_of(rows)).collect())
    assert got == brute(counted(rows))


def test_small_documents(small):
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in va.spelling_variants(small).collect())
    assert got == brute(counted(rows))


def test_empty_tables(docs_of):
    assert va.spelling_variants(docs_of([])).collect() == []
    assert va.spelling_variants(docs_of([(1, None), (2, "few words")])).collect() == []


def test_stays_in_the_engine(small):
    plan = va.spelling_variants(small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
