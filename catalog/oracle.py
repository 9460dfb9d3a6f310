"""DuckDB SQL with the meaning of each registered query.

The statements are put together from common table expressions; they spell each
step on its own and do not mirror how the Spark side computes it.
"""

from __future__ import annotations

from lectern.functions.stopwords import ENGLISH_STOP_WORDS

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)

_PYTHON_BLANKS = " || ".join(
    f"chr({c})"
    for c in (
        9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)


def _clean_expr(text: str) -> str:
    lowered = f"lower(trim({text}, ' '))"
    no_markup = f"regexp_replace({lowered}, '<[^>]+>', ' ', 'g')"
    no_breaks = f"regexp_replace({no_markup}, '[\\r\\n\\t]', ' ', 'g')"
    no_controls = f"regexp_replace({no_breaks}, '[\\x00-\\x1F\\x7F]', ' ', 'g')"
    return f"regexp_replace({no_controls}, '\\s+', ' ', 'g')"


def _clean(source: str, *keep: str) -> str:
    kept = "".join(f", {c}" for c in keep)
    return f"""
        SELECT * FROM (
          SELECT id{kept}, {_clean_expr('text')} AS text,
                 regexp_replace(lower(trim(title, ' ')), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS title
          FROM {source} WHERE text IS NOT NULL AND length(trim(text, ' ')) > 0)
        WHERE length(text) >= 30"""


def _tokens(source: str, pattern: str = "[^a-zA-Z]+", stop: bool = True) -> str:
    dropped = f"AND word NOT IN ({_STOP})" if stop else ""
    return f"""
        SELECT id, word, seq FROM (
          SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS seq
          FROM (SELECT id, regexp_split_to_array(lower(text), '{pattern}') AS words FROM {source}))
        WHERE length(word) >= 2 {dropped}"""


def _once_per_text(source: str) -> str:
    return (
        f"SELECT * FROM {source} "
        "QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY id) = 1"
    )


def _leaves(docs: str, tf: str) -> str:
    """The leaf of every document in each of 20 trees that ask for three words of the vocabulary."""
    return f"""
        SELECT d.id, t.tree,
               CASE WHEN coalesce(p.w0, false) THEN (CASE WHEN coalesce(p.w2, false) THEN 6 ELSE 5 END)
                    ELSE (CASE WHEN coalesce(p.w1, false) THEN 3 ELSE 2 END) END AS node
        FROM {docs} d CROSS JOIN (SELECT DISTINCT idx // 3 AS tree FROM vocabulary WHERE idx < 60) t
        LEFT JOIN (
          SELECT f.id, v.idx // 3 AS tree, bool_or(v.idx % 3 = 0 AND v.idf > 0) AS w0,
                 bool_or(v.idx % 3 = 1 AND v.idf > 0) AS w1, bool_or(v.idx % 3 = 2 AND v.idf > 0) AS w2
          FROM {tf} f JOIN vocabulary v ON f.word = v.word WHERE v.idx < 60 GROUP BY f.id, v.idx // 3) p
        ON p.id = d.id AND p.tree = t.tree"""


_DRAW = "md5(CAST(id AS VARCHAR) || ':42')"

# In order of dependence; a statement takes those it names, and theirs.
_PARTS: dict[str, str] = {
    "docs": """
        SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text, source AS subject
        FROM documents""",
    "corpus": """
        SELECT d.id, d.title, d.text, d.subject, CAST(NULL AS VARCHAR) AS date,
               CAST(l.quality AS INTEGER) AS label
        FROM docs d JOIN labels l ON d.id = l.doc_id""",
    "unlabelled": """
        SELECT * FROM docs WHERE id NOT IN (SELECT doc_id FROM labels)""",
    "clean_docs": _clean("docs", "subject"),
    "clean_unlabelled": _clean("unlabelled", "subject"),
    "clean_corpus": _clean("corpus", "subject", "label"),
    "prepared": _once_per_text("clean_corpus"),
    "split_docs": f"""
        SELECT *, CASE WHEN substr({_DRAW}, 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split
        FROM prepared""",
    "raw_split": f"""
        SELECT *, CASE WHEN substr({_DRAW}, 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS split
        FROM corpus WHERE text IS NOT NULL AND length(trim(text, ' ')) > 0""",
    "train": "SELECT * FROM split_docs WHERE split = 'train'",
    "train_tokens": _tokens("train"),
    "train_tf": "SELECT id, word, count(*) AS tf FROM train_tokens GROUP BY id, word",
    "word_stats": """
        SELECT word, CAST(sum(tf) AS BIGINT) AS corpus_count, count(*) AS doc_freq
        FROM train_tf GROUP BY word""",
    "vocabulary": """
        SELECT CAST(row_number() OVER (ORDER BY corpus_count DESC, word) - 1 AS INTEGER) AS idx,
               word, corpus_count, doc_freq,
               ln(((SELECT count(*) FROM train) + 1.0) / (doc_freq + 1.0)) AS idf
        FROM word_stats WHERE doc_freq >= 5
        ORDER BY corpus_count DESC, word LIMIT 2000""",
    "prepared_tokens": _tokens("prepared"),
    "prepared_tf": "SELECT id, word, count(*) AS tf FROM prepared_tokens GROUP BY id, word",
    "class_sizes": """
        SELECT count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) AS n0 FROM train""",
    "weights": """
        SELECT v.idx, v.word, v.idf,
               round(0.1 * (ln((count(*) FILTER (t.label = 1) + 1.0) / (n1 + 2.0))
                          - ln((count(*) FILTER (t.label = 0) + 1.0) / (n0 + 2.0))), 9) AS coefficient
        FROM vocabulary v JOIN train_tf f ON v.word = f.word JOIN train t ON t.id = f.id, class_sizes
        GROUP BY v.idx, v.word, v.idf, n1, n0""",
    "intercept": "SELECT round(ln((n1 + 1.0) / (n0 + 1.0)), 9) AS b FROM class_sizes",
    "unlabelled_tokens": _tokens("clean_unlabelled"),
    "unlabelled_tf": "SELECT id, word, count(*) AS tf FROM unlabelled_tokens GROUP BY id, word",
    "unlabelled_scores": """
        SELECT d.id, d.text, (SELECT b FROM intercept) + coalesce(s.margin, 0.0) AS score
        FROM clean_unlabelled d LEFT JOIN (
          SELECT f.id, sum(w.idf * w.coefficient) AS margin
          FROM unlabelled_tf f JOIN weights w ON f.word = w.word GROUP BY f.id) s ON d.id = s.id""",
    "counted_scores": """
        SELECT d.id, (SELECT b FROM intercept) + coalesce(s.margin, 0.0) AS score
        FROM clean_unlabelled d LEFT JOIN (
          SELECT f.id, sum(f.tf * w.idf * w.coefficient) AS margin
          FROM unlabelled_tf f JOIN weights w ON f.word = w.word GROUP BY f.id) s ON d.id = s.id""",
    "predictions": """
        SELECT d.id, d.title, d.text, d.label, d.split,
               (SELECT b FROM intercept) + coalesce(s.margin, 0.0) AS score,
               1 / (1 + exp(-((SELECT b FROM intercept) + coalesce(s.margin, 0.0)))) AS probability
        FROM split_docs d LEFT JOIN (
          SELECT f.id, sum(w.idf * w.coefficient) AS margin
          FROM prepared_tf f JOIN weights w ON f.word = w.word GROUP BY f.id) s ON d.id = s.id""",
    "train_leaves": _leaves("train", "train_tf"),
    "tree_shares": """
        SELECT l.tree, l.node, count(*) AS n, count(*) FILTER (t.label = 1) AS n_real
        FROM train_leaves l JOIN train t ON l.id = t.id GROUP BY l.tree, l.node""",
    "unlabelled_leaves": _leaves("clean_unlabelled", "unlabelled_tf"),
    "decided": """
        SELECT *, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction FROM predictions""",
    "importances": """
        SELECT 'log_odds' AS model, idx, round(abs(coefficient), 9) AS importance FROM weights
        UNION ALL
        SELECT 'idf_mass', idx, round(doc_freq * idf, 9) FROM vocabulary""",
    "shares": """
        SELECT model, idx, importance / sum(importance) OVER (PARTITION BY model) AS p
        FROM importances""",
    "bench_docs": f"""
        SELECT item_id AS id, trim(text, {_PYTHON_BLANKS}) AS text FROM benchmark
        WHERE trim(text, {_PYTHON_BLANKS}) <> ''""",
    "bench_clean": f"SELECT id, {_clean_expr('text')} AS text FROM bench_docs",
    "bench_tokens": _tokens("bench_clean"),
    "bench_scores": """
        SELECT d.id, d.text, (SELECT b FROM intercept) + coalesce(s.margin, 0.0) AS score
        FROM bench_clean d LEFT JOIN (
          SELECT f.id, sum(w.idf * w.coefficient) AS margin
          FROM (SELECT DISTINCT id, word FROM bench_tokens) f JOIN weights w ON f.word = w.word
          GROUP BY f.id) s ON d.id = s.id""",
}


def _words_of(sql: str) -> set[str]:
    return set("".join(c if c.isalnum() or c == "_" else " " for c in sql).split())


def _statement(select: str) -> str:
    """Prefix ``select`` with the parts it needs, in order."""
    needed: set[str] = set()
    queue = [select]
    while queue:
        for name in (_words_of(queue.pop()) & set(_PARTS)) - needed:
            needed.add(name)
            queue.append(_PARTS[name])
    ctes = ",\n".join(f"{n} AS ({sql})" for n, sql in _PARTS.items() if n in needed)
    return f"WITH {ctes}\n{select}" if ctes else select


def _r(expr: str, alias: str, digits: int = 6) -> str:
    # Adding 0.0 turns a negative zero into zero.
    return f"round({expr}, {digits}) + 0.0 AS {alias}"


_CELLS = """
    count(*) FILTER (label = 1 AND prediction = 1) AS tp,
    count(*) FILTER (label = 0 AND prediction = 0) AS tn,
    count(*) FILTER (label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (label = 1 AND prediction = 0) AS fn"""

_METRICS = f"""
    tp, tn, fp, fn, tp + tn + fp + fn AS total,
    {_r('CASE WHEN tp + tn + fp + fn > 0 THEN (tp + tn) / (tp + tn + fp + fn) ELSE 0.0 END', 'accuracy')},
    {_r('p', 'precision')}, {_r('r', 'recall')},
    {_r('CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END', 'f1')}"""

_WITH_PR = """SELECT *,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r FROM"""

_PROBABILITY = _r("1 / (1 + exp(-score))", "probability")
_SCORED_TWICE = f"""
        SELECT CASE WHEN copy < 2 THEN id END AS id, {_r('score', 'score')}, {_PROBABILITY},
               CASE WHEN 1 / (1 + exp(-score)) >= 0.5 THEN CAST(1 AS DOUBLE) ELSE 0 END AS prediction
        FROM unlabelled_scores, range(3) t(copy)"""

_CORPUS_COLUMNS = "SELECT id, title, text, subject, date, label FROM corpus"

_LENGTH = "CAST({}(length(text)) AS INTEGER)"

_SELECTS: dict[str, str] = {
    "labelled_union": _CORPUS_COLUMNS,
    "csv_sources": _CORPUS_COLUMNS,
    "labelled_union_strict": """
        SELECT id, text, CAST(label AS DOUBLE) AS label FROM corpus
        WHERE length(trim(text, ' ')) > 0""",
    "normalize_schema": "SELECT id, text AS title, text, subject, date, label FROM corpus",
    "drop_invalid": """
        SELECT * FROM (
          SELECT d.doc_id AS id, CAST(l.quality AS INTEGER) AS label,
                 CASE WHEN lang = 'es' THEN '   ' WHEN lang <> 'de' THEN text END AS text
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
        WHERE label IS NOT NULL AND text IS NOT NULL AND length(trim(text, ' ')) > 0""",
    "unlabelled_docs": "SELECT id, title, text, subject FROM unlabelled",
    "score_inputs": "SELECT id, text FROM bench_docs",
    "clean_text": "SELECT id, title, text, subject FROM clean_docs",
    "dedup_text": f"SELECT id, title, text, subject FROM ({_once_per_text('clean_docs')})",
    "dedup_colliding_ids": "SELECT min(id // 2) AS id, text FROM clean_docs GROUP BY text",
    "duplicate_groups": """
        SELECT sha256(c.text) AS text_hash, count(*) AS copies, min(c.id) AS min_id,
               CAST(count(DISTINCT l.quality) AS INTEGER) AS n_labels
        FROM clean_docs c LEFT JOIN labels l ON c.id = l.doc_id
        GROUP BY 1 HAVING count(*) > 1""",
    "clean_meta": """
        SELECT *, rows_before - rows_after AS dropped,
               CAST(30 AS INTEGER) AS min_text_length, true AS dedup
        FROM (SELECT (SELECT count(*) FROM docs) AS rows_before,
                     (SELECT count(DISTINCT sha256(text)) FROM clean_docs) AS rows_after)""",
    "strip_html": """
        SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS text FROM pages""",
    "clip_text": "SELECT id, substr(text, 1, 2000) AS text FROM docs",
    "parse_date": """
        SELECT event_id, CAST(ts AS DATE) AS day_iso,
               CAST(try_strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS day_plain,
               CAST(try_strptime(strftime(ts, '%B %-d, %Y'), '%B %d, %Y') AS DATE) AS day_long,
               CAST(try_strptime(strftime(ts, '%-d-%b-%y'), '%d-%b-%y') AS DATE) AS day_short,
               CAST(try_strptime(event_type, '%Y-%m-%d') AS DATE) AS day_none
        FROM events""",
    "hash_sample": f"SELECT id, label, text FROM prepared WHERE substr({_DRAW}, 1, 8) < '19999999'",
    "random_n": f"SELECT id, label, text FROM prepared ORDER BY {_DRAW}, id LIMIT 100",
    "train_test_split": "SELECT id, label, split FROM split_docs",
    "class_balance": "SELECT label, count(*) AS n FROM prepared GROUP BY label",
    "length_stats": f"""
        SELECT label, count(*) AS n, {_LENGTH.format('min')} AS min_len,
               {_LENGTH.format('max')} AS max_len, {_r('avg(length(text))', 'avg_len')}
        FROM prepared GROUP BY label""",
    "length_median": f"""
        SELECT label, {_LENGTH.format('min')} AS min_len,
               {_r('quantile_cont(length(text), 0.5)', 'median_len')},
               {_r('avg(length(text))', 'avg_len')}, {_LENGTH.format('max')} AS max_len
        FROM prepared GROUP BY label""",
    "top_subjects": """
        SELECT subject, count(*) AS n FROM prepared GROUP BY subject
        ORDER BY n DESC, subject NULLS FIRST LIMIT 6""",
    "top_subject_docs": """
        SELECT p.id, p.subject, p.label FROM prepared p JOIN (
          SELECT subject, count(*) AS n FROM prepared GROUP BY subject
          ORDER BY n DESC, subject NULLS FIRST LIMIT 6) t ON p.subject = t.subject""",
    "subject_label_pivot": """
        SELECT p.subject, count(*) FILTER (p.label = 0) AS n_fake,
               count(*) FILTER (p.label = 1) AS n_real
        FROM prepared p JOIN (
          SELECT subject, count(*) AS n FROM prepared GROUP BY subject
          ORDER BY n DESC, subject NULLS FIRST LIMIT 6) t ON p.subject = t.subject
        GROUP BY p.subject""",
    "word_counts": """
        SELECT p.label, t.word, count(*) AS n FROM prepared_tokens t JOIN prepared p ON t.id = p.id
        GROUP BY p.label, t.word""",
    "top_words_per_label": """
        SELECT label, word, n, CAST(rank AS INTEGER) AS rank FROM (
          SELECT p.label, t.word, count(*) AS n,
                 row_number() OVER (PARTITION BY p.label ORDER BY count(*) DESC, t.word) AS rank
          FROM prepared_tokens t JOIN prepared p ON t.id = p.id GROUP BY p.label, t.word)
        WHERE rank <= 15""",
    "tokenize": f"""
        SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY seq) - 1 AS INTEGER) AS pos, word
        FROM ({_tokens('prepared', '[^0-9A-Za-z_]+', stop=False)})""",
    "remove_stopwords": """
        SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY seq) - 1 AS INTEGER) AS pos, word
        FROM prepared_tokens""",
    "vocabulary_table": "SELECT idx, word, corpus_count, doc_freq FROM vocabulary",
    "idf_values": f"SELECT idx, word, {_r('idf', 'idf')} FROM vocabulary",
    "vocab_import": f"SELECT idx, word, {_r('idf', 'idf')} FROM vocabulary",
    "term_frequency": """
        SELECT f.id, v.idx, f.word, CAST(f.tf AS DOUBLE) AS tf
        FROM prepared_tf f JOIN vocabulary v ON f.word = v.word""",
    "tfidf_weights": f"""
        SELECT f.id, v.idx, f.word, CAST(1 AS DOUBLE) AS tf, {_r('v.idf', 'idf')},
               {_r('v.idf', 'tfidf')}
        FROM prepared_tf f JOIN vocabulary v ON f.word = v.word""",
    "large_vocabulary_features": f"""
        SELECT f.id, v.idx, {_r('v.idf', 'tfidf')}
        FROM prepared_tf f JOIN vocabulary v ON f.word = v.word""",
    "tree_nodes": f"""
        SELECT CAST(t.tree AS INTEGER) AS tree, CAST(t.tree AS BIGINT) * 4294967296 + n.node AS node,
               CASE WHEN n.word IS NOT NULL THEN CAST(3 * t.tree + n.word AS INTEGER) END AS idx,
               CAST(t.tree AS BIGINT) * 4294967296 + n.l AS left,
               CAST(t.tree AS BIGINT) * 4294967296 + n.r AS right,
               CASE WHEN n.word IS NULL THEN
                 round((coalesce(c.n_real, 0) + 1.0) / (coalesce(c.n, 0) + 2.0), 6) END AS for_1
        FROM (SELECT DISTINCT idx // 3 AS tree FROM vocabulary WHERE idx < 60) t
        CROSS JOIN (VALUES (0, 0, 1, 4), (1, 1, 2, 3), (4, 2, 5, 6), (2, NULL, NULL, NULL),
          (3, NULL, NULL, NULL), (5, NULL, NULL, NULL), (6, NULL, NULL, NULL)) n(node, word, l, r)
        LEFT JOIN tree_shares c ON c.tree = t.tree AND c.node = n.node""",
    "score_trees": f"""
        SELECT l.id, {_r('sum((coalesce(c.n_real, 0) + 1.0) / (coalesce(c.n, 0) + 2.0))', 'score')},
               round(sum((coalesce(c.n_real, 0) + 1.0) / (coalesce(c.n, 0) + 2.0)) / count(*), 6) AS probability
        FROM unlabelled_leaves l LEFT JOIN tree_shares c ON c.tree = l.tree AND c.node = l.node
        GROUP BY l.id""",
    "hashing_tf": f"""
        SELECT p.id, coalesce(t.n, 0) AS n_tokens FROM prepared p LEFT JOIN (
          SELECT id, count(*) AS n FROM ({_tokens('prepared', '[^0-9A-Za-z_]+')}) GROUP BY id) t
        ON p.id = t.id""",
    "score_logreg": f"""
        SELECT id, {_r('score', 'score')}, {_PROBABILITY},
               CASE WHEN 1 / (1 + exp(-score)) >= 0.5 THEN CAST(1 AS DOUBLE) ELSE 0 END AS prediction
        FROM unlabelled_scores""",
    "score_linearsvc": f"""
        SELECT id, {_r('score', 'score')},
               CASE WHEN score >= 0 THEN CAST(1 AS DOUBLE) ELSE 0 END AS prediction
        FROM unlabelled_scores""",
    "score_texts_in_place": _SCORED_TWICE,
    "score_texts_by_join": _SCORED_TWICE,
    "score_by_lookup": f"""
        SELECT id, {_r('score', 'score')}, {_PROBABILITY},
               CASE WHEN 1 / (1 + exp(-score)) >= 0.5 THEN CAST(1 AS DOUBLE) ELSE 0 END AS prediction
        FROM counted_scores""",
    "score_benchmark": f"""
        SELECT id, text, {_r('score', 'score')}, {_PROBABILITY},
               CASE WHEN 1 / (1 + exp(-score)) >= 0.5 THEN CAST(1 AS DOUBLE) ELSE 0 END AS prediction
        FROM bench_scores""",
    "predictions_csv": f"""
        SELECT id, text, {_PROBABILITY},
               CASE WHEN 1 / (1 + exp(-score)) >= 0.5 THEN CAST(1 AS DOUBLE) ELSE 0 END AS prediction
        FROM unlabelled_scores""",
    "artifact_consistency": """
        SELECT count(v.idx) AS n_vocabulary, count(v.idf) AS n_idf,
               count(w.coefficient) AS n_coefficients,
               count(*) FILTER (w.idx IS NULL) AS words_without_weight,
               count(*) FILTER (v.idx IS NULL) AS weights_without_word
        FROM vocabulary v FULL JOIN weights w ON v.idx = w.idx""",
    "confusion_matrix": f"SELECT {_CELLS} FROM decided",
    "classification_metrics": f"""
        SELECT split, {_METRICS}
        FROM ({_WITH_PR} (SELECT split, {_CELLS} FROM decided GROUP BY split))""",
    "metrics_at_thresholds": f"""
        SELECT threshold, {_METRICS} FROM ({_WITH_PR} (
          SELECT threshold, {_CELLS} FROM (
            SELECT label, t.threshold,
                   CASE WHEN probability >= t.threshold THEN 1 ELSE 0 END AS prediction
            FROM predictions, (SELECT CAST(unnest([0.1, 0.3, 0.5, 0.7, 0.9]) AS DOUBLE)
                               AS threshold) t)
          GROUP BY threshold))""",
    "report_history": f"""
        SELECT threshold, run_id, {_METRICS} FROM ({_WITH_PR} (
          SELECT threshold, run_id, {_CELLS} FROM (
            SELECT label, t.threshold, t.run_id,
                   CASE WHEN probability >= t.threshold THEN 1 ELSE 0 END AS prediction
            FROM predictions, (VALUES (CAST(0.5 AS DOUBLE), '10'), (CAST(0.3 AS DOUBLE), '2'))
                               t(threshold, run_id))
          GROUP BY threshold, run_id))""",
    "top_errors": f"""
        SELECT error, CAST(rank AS INTEGER) AS rank, id, label, {_r('score', 'score')}, title, text
        FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY abs(score) DESC, id) AS rank,
                CASE WHEN label = 0 THEN 'false_positive' ELSE 'false_negative' END AS error
              FROM decided WHERE label <> prediction)
        WHERE rank <= 5""",
    "prediction_sample": """
        SELECT id, text, label, CAST(prediction AS INTEGER) AS prediction FROM decided
        ORDER BY id LIMIT 200""",
    "importance_concentration": f"""
        SELECT model, {_r('sum(p * p)', 'hhi')}, {_r('1 / sum(p * p)', 'n_eff')},
               {_r('sum(CASE WHEN rank <= 50 THEN p ELSE 0 END)', 'top_share')}
        FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY p DESC, idx) AS rank
              FROM shares) GROUP BY model""",
    "cumulative_importance": f"""
        SELECT model, idx, rank, {_r('p', 'p')},
               {_r('sum(p) OVER (PARTITION BY model ORDER BY rank)', 'cumulative')}
        FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY p DESC, idx) AS rank
              FROM (SELECT model, idx, importance / sum(importance) OVER (PARTITION BY model) AS p
                    FROM importances))""",
    "importance_spearman": f"""
        SELECT 'log_odds' AS model_a, 'idf_mass' AS model_b, count(*) AS n_features,
               {_r('corr(a.rank, b.rank)', 'spearman')}
        FROM (SELECT idx, row_number() OVER (ORDER BY importance, idx) AS rank
              FROM importances WHERE model = 'log_odds') a
        JOIN (SELECT idx, row_number() OVER (ORDER BY importance, idx) AS rank
              FROM importances WHERE model = 'idf_mass') b ON a.idx = b.idx""",
}
# Two forms of the same scores: every document is scored, none differs.
_SELECTS["logreg_agreement"] = _SELECTS["linearsvc_agreement"] = """
    SELECT count(*) AS n_docs, CAST(0 AS BIGINT) AS n_differ FROM clean_unlabelled"""
_SELECTS["score_model"] = _SELECTS["logreg_agreement"]
_SELECTS["forest_agreement"] = _SELECTS["gbt_agreement"] = _SELECTS["logreg_agreement"]


# What of a fit does not hang on it.  That scores part the classes of the training
# rows, that metrics follow from counts and that weights are optimal is decided by
# the query, and must be true.
def _fitted(source: str, *models: str) -> str:
    names = ", ".join(f"'{m}'" for m in models)
    return f"""
        SELECT model, count(*) AS n_test, count(*) FILTER (label = 1) AS n_real,
               count(*) FILTER (label = 0) AS n_fake, true AS metrics_hold
        FROM {source}, (SELECT unnest([{names}]) AS model) WHERE split = 'test' GROUP BY model"""


def _trained(*models: str) -> str:
    return f"""
        SELECT *, true AS learns, (SELECT count(*) FROM train) AS n_train
        FROM ({_fitted('split_docs', *models)})"""


_SELECTS |= {
    "train_logreg": _trained("logreg"),
    "train_linearsvc": _trained("linearsvc"),
    "train_random_forest": _trained("randomforest"),
    "train_gbt": _trained("gbt"),
    "model_comparison": _trained("logreg", "linearsvc", "randomforest", "gbt"),
    "grid_comparison": f"""
        SELECT *, true AS best_at_optimum, CAST(1 AS BIGINT) AS n_best FROM ({
            _fitted('split_docs', *(f'logreg(regParam={p})' for p in (0.05, 0.1, 0.5)))})""",
    "hashing_model": _fitted("raw_split", "logreg"),
    "linear_weights": """
        SELECT 'linearsvc' AS model, count(*) AS n_words, CAST(1 AS BIGINT) AS n_intercepts,
               CAST(0 AS BIGINT) AS n_missing FROM vocabulary""",
    "logreg_optimum": "SELECT count(*) + 1 AS n_weights, true AS at_optimum FROM vocabulary",
    "tree_importances": """
        SELECT 'randomforest' AS model, count(*) AS n_words, CAST(0 AS BIGINT) AS n_negative,
               true AS adds_up FROM vocabulary""",
    "worst_model_errors": """
        SELECT 'logreg' AS model, true AS complete, CAST(0 AS BIGINT) AS n_wrong""",
}
_SELECTS["score_from_json"] = _SELECTS["score_logreg"]
_SELECTS["tokenize_expression"] = _SELECTS["remove_stopwords"]

ORACLE: dict[str, str] = {name: _statement(select) for name, select in _SELECTS.items()}
