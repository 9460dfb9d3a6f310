import random

from lectern.llm import tokencount as tc
from lectern.llm.packing import ChunkEncoder
from lectern.llm.queries import tokenizer_path
from tokenizers import Tokenizer


def whole(texts):
    return [len(e.ids) for e in Tokenizer.from_file(tokenizer_path()).encode_batch_fast(texts, add_special_tokens=False)]


def test_random_edits_equal_full_encoding():
    encoder, rng = ChunkEncoder(tokenizer_path()), random.Random(4)
    pieces = ["word", "Éa.", " ", "  ", "\n", "x1y", ",", "don't", "<b>", "漢字", "\t", "end."]
    text_of = lambda n: "".join(rng.choice(pieces) for _ in range(n))
    for case in range(120):
        text = text_of(rng.choice([0, 1, 5, 40, 200]))
        tree = tc.CountTree.build(text, encoder, leaf=rng.choice([1, 2, 5, 32]))
        assert tree.total == whole([text])[0]
        for _ in range(3):  # a tree stays good for further edits
            cuts = sorted(rng.randrange(len(text) + 1) for _ in range(2 * rng.choice([1, 1, 2, 3])))
            edits = [(a, b, text_of(rng.choice([0, 1, 3]))) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
            edits = [e for i, e in enumerate(edits) if i == 0 or e[0] > edits[i - 1][1]]
            want, at = [], 0
            for a, b, new in edits:
                want += [text[at:a], new]
                at = b
            want = "".join([*want, text[at:]])
            text, _ = tree.edit(text, edits, encoder)
            assert text == want
            assert tree.total == whole([text])[0], (case, edits)
            half = len(tree.sums) // 2
            assert all(tree.sums[i] == tree.sums[2 * i] + tree.sums[2 * i + 1] for i in range(1, half))


def test_only_touched_leaves_are_encoded():
    encoder = ChunkEncoder(tokenizer_path())
    text = " ".join(f"word{i}" for i in range(5000))
    tree = tc.CountTree.build(text, encoder)
    _, work = tree.edit(text, [(20_000, 20_005, "new")], encoder)
    assert 0 < work <= 2 * tc.LEAF


def test_counts_follow_the_removal_of_personal_data(spark, docs_of):
    mail, ip = "write to a.b@c.org now", "host 10.0.0.1, +1 (555) 123-4567x"
    rows = [(1, mail), (2, ip), (3, None), (4, ""), (5, "plain words"), (1, mail), (None, mail), (1, ip), (6, "w " * 30_000 + mail)]
    got = tc.token_counts(docs_of(rows), tokenizer_path()).collect()
    new_mail, new_ip = "write to <EMAIL> now", "host <IP>, <PHONE>x"
    edited = [(i, t, {mail: new_mail, ip: new_ip}.get(t, t)) for i, t in rows[:-1]] + [(6, rows[-1][1], "w " * 30_000 + new_mail)]
    want = [
        (i, a, n, b)
        for (i, t, u), a, b in zip(edited, whole([t or "" for _, t, _ in edited]), whole([u or "" for *_, u in edited]), strict=True)
        for n in [0 if t == u else 2 if t == ip else 1]
    ]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(want, key=key)
    assert max(r["n_reencoded"] for r in got) < 2 * tc.LEAF + 10


def test_no_documents(spark, docs_of):
    assert tc.token_counts(docs_of([]), tokenizer_path()).collect() == []
