import base64
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lectern.llm import warc
from lectern.plans import storage
from lectern.plans.storage import fresh_path

PAGES = [
    (1, "http://b.example.org/x?q=1", "<p>one</p>"),
    (2, "https://a.example.org/", "<p>one</p>"),
    (3, "http://a.example.org/", None),
    (4, None, ""),
    (5, "", "Warc\r\n\r\nWARC/1.1\r\n\r\n"),
    (6, "no url at all \n", "é漢🙂" * 50_000),
    (7, "http://[bad", "<p>one</p>"),
    (None, "http://a.example.org/z", "<p>one</p>"),
    (None, "http://a.example.org/z", "alone"),
    (9, "http://a.example.org/z", "twice"),
    (9, "http://a.example.org/z", "twice"),
    ((1 << 60) + 1, "http://a.example.org/z", "large"),
    ((1 << 60) + 3, "http://a.example.org/z", "large"),
]


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "k", 0) for r in rows], "page_id bigint, url string, html string, key string, start int")


def want(rows):
    last = {}
    for i, _, html in rows:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", i))
    out = []
    for i, url, html in rows:
        raw = (html or "").encode()
        refers = last.get(html or "") if i is not None and i != last.get(html or "") else None
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, url, "revisit" if refers is not None else "response", len(raw), digest, refers))
    return sorted(out, key=str)


def test_round_trip(spark):
    got = warc.archive_pages(pages_of(spark, PAGES)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == want(PAGES)
    payload = {(r["page_id"], r["payload_digest"]): r["payload"] for r in got if r["record_type"] == "response"}
    for i, _, html in PAGES:
        digest = base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
        if (i, digest) in payload:
            assert bytes(payload[i, digest]).decode() == (html or "")


def test_small_payloads_may_all_be_responses(spark):
    got = warc.archive_pages(pages_of(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]), min_bytes=4)
    assert {r["page_id"]: r["record_type"] for r in got.collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


@pytest.mark.parametrize("shard_rows, block_lines", [(1000, 1000), (40, 3)])
def test_lookups(spark, shard_rows, block_lines):
    rows = [(i, f"http://h{i % 7}.example.org/{i % 11}", f"body {i}") for i in range(300)]
    rows += [(1000 + i, "http://hot.example.org/", f"hot {i}") for i in range(150)]
    pages = pages_of(spark, rows)
    folder = fresh_path(spark, "test-warc")
    payload = pages.html.cast("binary")
    captures = warc.write_archives(warc.with_originals(pages, payload), f"{folder}/a", archive_bytes=2000)
    assert captures.select("archive").distinct().count() > 3
    index = warc.build_index(captures, f"{folder}/i", shard_rows, block_lines)
    ask = lambda rows: spark.createDataFrame(rows, "url string, page_id bigint")
    found = lambda q: sorted(r["page_id"] for r in warc.read_records(warc.locate(index, q, group_rows=50)).collect())
    assert found(ask([("http://hot.example.org/", None)])) == list(range(1000, 1150))
    assert found(ask([("http://h3.example.org/5", 5), ("http://h3.example.org/5", None)])) == sorted(
        i for i, u, _ in rows if u == "http://h3.example.org/5"
    )
    assert found(ask([(u, i) for i, u, _ in rows])) == sorted(i for i, *_ in rows)
    assert found(ask([("http://h3.example.org/5", 6), ("http://none.example.org/", None)])) == []
    assert found(ask([])) == []


def test_originals_beyond_the_bounds_of_a_broadcast(spark, monkeypatch):
    rows = [(i, f"http://a.org/{i}", None if i % 3 == 0 else f"page {i % 50}") for i in range(600)]
    rows += [(None, "http://a.org/n", "page 1"), (599, "http://a.org/r", "page 49"), (None, "http://a.org/z", "alone")]
    pages = pages_of(spark, rows).repartition(6)
    payload = F.coalesce(pages.html.cast("binary"), F.lit(b""))
    near = warc.with_originals(pages, payload)
    monkeypatch.setattr(storage, "MAX_LOOKUP_ROWS", 3)
    far = warc.with_originals(pages, payload)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert "_salt" not in plan and "_salt" in far._jdf.queryExecution().executedPlan().toString()
    names = ("page_id", "url", "payload", "refers_to")
    got = [sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr) for df in (near, far)]
    assert got[0] == got[1]
    last = {}
    for i, _, html in rows:
        if i is not None:
            last[html] = max(i, last.get(html, i))
    twice = {h for h in last if sum(r[2] == h for r in rows) > 1}
    want = [
        (i, u, (h or "").encode(), last[h] if h in twice and i is not None and i != last[h] else None)
        for i, u, h in rows
    ]
    assert got[0] == sorted(((i, u, bytearray(p), r) for i, u, p, r in want), key=repr)


def test_archives_are_members_of_gzip(spark):
    pages = pages_of(spark, PAGES[:3])
    captures = warc.write_archives(warc.with_originals(pages, pages.html.cast("binary")), fresh_path(spark, "test-warc"))
    for r in captures.collect():
        raw = open(r["archive"].removeprefix("file:"), "rb").read()
        member = zlib.decompress(raw[r["start"] : r["start"] + r["bytes"]], 31)
        assert member.startswith(b"WARC/1.1\r\nWARC-Type: ") and member.endswith(b"\r\n\r\n")


def test_keys_reverse_hosts():
    assert warc.url_key("https://News.Example.org:81/A?b#c") == "org,example,news:81)/a?b"
    assert warc.url_key(None) == warc.url_key("") == ""
    assert warc.url_key("http://a.org") == warc.url_key("http://a.org/")


def test_damage_is_noticed():
    with pytest.raises(ValueError):
        warc.decode_record(warc.encode_record(1, "u", b"abc", "WRONG", None))


def test_no_pages(spark):
    assert warc.archive_pages(pages_of(spark, [])).collect() == []
