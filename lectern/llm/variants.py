"""Spelling variants: groups words one edit apart around the more frequent form.

Near words are found by asymmetric chunks.  One word is cut into two disjoint
chunks, its halves; an edit leaves one of them whole.  The other word contributes
the grams at every place where such a chunk can lie: an edit moves what follows it by
one place at most.  Equal chunk and gram make a candidate, and the edit distance
decides.

Where very many words share a chunk, what lies outside of it is cut into halves in
the same way: the edit leaves one of those whole, too.  At the end all but one code
point agree, so such a group is bounded by the alphabet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

# What a run of letters is, and what is lower-cased.
RUN = r"[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Pairs of a chunk and a gram that a group may hold before it is cut further.
GROUP_PAIRS = 20_000
#: Ids whose crc32 with the run is divisible by this lose a letter.
TYPO = 97


def runs(text: Column) -> Column:
    """Lower-cased runs of letters of a text; none of a null text."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(RUN), F.lit(0))


def damaged(doc_id: Column, run: Column, every: int = TYPO) -> Column:
    """The run, without one code point where its hash with the id is divisible by ``every``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % every == 0, cut).otherwise(run)


def word_counts(docs: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """word, n of all sufficiently long and frequent words of ``docs(doc_id, text)``."""
    run = docs.select("doc_id", F.explode(runs(F.col("text"))).alias("run"))
    run = run.filter(F.length("run") >= min_length)  # a cut makes it shorter only
    words = run.select(damaged(F.col("doc_id"), F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


def _key(length: Column, head: Column, head_length: Column, tail: Column, tail_length: Column) -> Column:
    """Names a place: the length of the word that was cut, and what agrees at both ends."""
    return F.xxhash64(length, head_length, tail_length, head, tail)


def _cut(sides: DataFrame, is_chunk: bool) -> DataFrame:
    """Both halves of what is still open between ``head`` and ``tail``, as rows of their own.

    ``length`` is that of the word cut into chunks; a gram's word may have one
    code point more or less.
    """
    word, length, head, tail = F.col("word"), F.col("length"), F.col("head"), F.col("tail")
    first = _half(length - head - tail)
    choices = [(head + first, tail), (head, length - head - first)]
    both = F.array(*(F.struct(h.cast("int").alias("head"), t.cast("int").alias("tail")) for h, t in choices))
    rows = sides.select("word", "n", "length", F.inline(both))
    size = F.length(word)
    if not is_chunk:  # both ends have to fit into the word
        rows = rows.filter(F.col("head") + F.col("tail") <= size)
    key = _key(
        length, F.substring(word, F.lit(1), F.col("head")), F.col("head"),
        F.substr(word, size - F.col("tail") + 1), F.col("tail"),
    )
    return rows.withColumn("key", key)


def near_pairs(words: DataFrame, group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """word, n, near, near_n of all ordered pairs of ``words(word, n)`` one edit apart.

    ``words`` is a written table of distinct words.
    """
    length = F.length("word")
    chunks = words.select("word", "n", length.alias("length"), F.lit(0).alias("head"), F.lit(0).alias("tail"))
    lengths = F.filter(F.array(length - 1, length, length + 1), lambda x: x > 0)
    grams = words.select("word", "n", F.explode(lengths).alias("length"), F.lit(0).alias("head"), F.lit(0).alias("tail"))
    found: list[DataFrame] = []
    while True:
        chunks, grams = materialize(_cut(chunks, True), "chunks"), materialize(_cut(grams, False), "grams")
        sizes = chunks.groupBy("key").agg(F.count("*").alias("a"))
        sizes = sizes.join(grams.groupBy("key").agg(F.count("*").alias("b")), "key")
        hot = sizes.filter(F.col("a") * F.col("b") > group_pairs).select("key")
        # Where one code point is open there is nothing left to cut.
        is_open = F.col("length") - F.col("head") - F.col("tail") > 1
        hot = chunks.filter(is_open).join(hot, "key", "left_semi").select("key").distinct()
        hot = materialize(hot, "hot-chunks")
        cold = chunks.join(hot, "key", "left_anti").select("key", "word", "n")
        pairs = cold.join(grams.select("key", F.col("word").alias("near"), F.col("n").alias("near_n")), "key")
        is_near = F.levenshtein("word", "near", 1) == 1
        found.append(materialize(pairs.filter(is_near).select("word", "n", "near", "near_n"), "near"))
        if hot.isEmpty():
            break
        chunks, grams = (side.join(hot, "key", "left_semi") for side in (chunks, grams))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.distinct()  # both halves may be whole


def roots(forms: DataFrame) -> DataFrame:
    """word, root: forms followed to the last, for every word of ``forms(word, form)``.

    A form is more frequent than its word, so there is no way round.  Each round
    doubles the steps that have been taken.
    """
    reached = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = materialize(reached.join(ahead, "root", "left"), "roots")
        more = step.filter(F.col("ahead").isNotNull())
        if more.isEmpty():
            return step.select("word", "root")
        reached = step.select("word", F.coalesce("ahead", "root").alias("root"))


def variant_groups(words: DataFrame, ratio: int = 2, group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words(word, n)``, a written table.

    The form is the near word of largest n, ties to the first in code-point order,
    if it is ``ratio`` times as frequent.
    """
    pairs = near_pairs(words, group_pairs)
    best = F.min(F.struct((-F.col("near_n")).alias("falling"), "near"))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    form_n = -F.col("best.falling")
    taken = F.coalesce(form_n >= ratio * F.col("n"), F.lit(False))
    table = joined.select(
        "word",
        F.when(taken, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, form_n).alias("form_n"),
    )
    table = materialize(table, "forms")
    root = roots(table.filter(F.col("form").isNotNull()))
    rooted = table.join(root, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """Variant groups of all words of ``docs(doc_id, text)``.

    Null and empty texts have no words; a null id counts as the empty string in the
    hash that damages runs.  Rows that repeat count as often as they occur; further
    columns are ignored.
    """
    return variant_groups(materialize(word_counts(docs, min_length, min_count), "words"))
