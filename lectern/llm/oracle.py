"""SQL for the queries of this package that SQL can express.

The others are tested against brute force: op2 (its spans come from a trained
model; the base columns are expressible and tested), op3, op7, op9 and op11 (trained
models), op6 and op10 (a tokenizer).
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

ORACLE["op1_decontaminate"] = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), runs AS (
  SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN []
    ELSE list_transform(range(1, greatest(1, len(w) - 9) + 1), lambda i: array_to_string(w[i:i + 9], ' ')) END) AS run,
    least(10, len(w)) AS n
  FROM item
), patterns AS (SELECT DISTINCT run, n, item_id FROM runs),
lengths AS (SELECT DISTINCT n FROM patterns),
places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM doc, lengths WHERE len(w) >= n
), found AS (
  SELECT p.doc_id, p.i, p.n, q.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS run FROM places) p JOIN patterns q USING (run, n)
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op4_ngram_jaccard_join"] = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    ELSE list_transform(range(1, greatest(1, len(w) - 3) + 1), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g
  FROM doc
), cells AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM grams),
both_ AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS common
  FROM cells x JOIN cells y ON x.gram = y.gram AND x.doc_id < y.doc_id AND 100 * x.n >= 85 * y.n AND 100 * y.n >= 85 * x.n
  GROUP BY x.doc_id, y.doc_id
), link AS (SELECT a, b FROM both_ WHERE 100 * common >= 85 * (n + m - common)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT a AS doc_id, b AS other FROM edge
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edge e ON r.other = e.a
)
SELECT g.doc_id, CAST(len(g.g) AS BIGINT) AS n_shingles,
  CAST(least(g.doc_id, coalesce(min(r.other), g.doc_id)) AS BIGINT) AS component_id
FROM grams g LEFT JOIN reach r USING (doc_id)
GROUP BY g.doc_id, g.g
"""

# Five hexadecimal digits are four base-32 digits.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 5 * (i // 4)}, 5))::BIGINT "
    f">> {15 - 5 * (i % 4)}) & 31)::INTEGER, 1)"
    for i in range(32)
)

ORACLE["op5_warc"] = f"""
WITH page AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS h FROM pages
), last AS (SELECT payload, max(page_id) AS original FROM page GROUP BY payload)
SELECT page_id, octet_length(page.payload) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM page JOIN last ON page.payload = last.payload
"""

ORACLE["op8_top_k"] = """
WITH vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM vec q JOIN vec c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def _crc_table() -> list[int]:
    """What crc32 adds for every byte: eight steps of division by its polynomial."""
    out = list(range(256))
    for _ in range(8):
        out = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in out]
    return out


# A run's letters are ASCII or take two bytes, the first of which is 195.
ORACLE["op12_spelling_variants"] = f"""
WITH RECURSIVE run AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY doc_id, run
), hashed AS (
  SELECT run, times, xor(list_reduce(list_concat(
      list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':', ''), lambda c: CAST(unicode(c) AS BIGINT)),
      flatten(list_transform(string_split(run, ''), lambda c:
        CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END))),
    lambda c, b: xor(c >> 8, {_crc_table()}[xor(c & 255, b) + 1]), 4294967295), 4294967295) AS h
  FROM run
), word AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)
), pair AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM word a JOIN cut b ON a.word = b.rest
  UNION
  SELECT b.word, b.n, a.word, a.n FROM word a JOIN cut b ON a.word = b.rest
), best AS (
  SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS place
  FROM pair
), form AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM word w LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON w.word = b.word
), path AS (
  SELECT word, word AS root FROM form WHERE form IS NULL
  UNION ALL
  SELECT f.word, p.root FROM form f JOIN path p ON f.form = p.word
)
SELECT word, form, root, n, n_near, form_n FROM form JOIN path USING (word)
"""

ORACLE["op13_hard_negatives"] = """
WITH vec AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
  FROM vec a JOIN vec c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positive AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
    n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positive p JOIN scored n ON p.anchor_id = n.anchor_id AND p.place <= 5 AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""
