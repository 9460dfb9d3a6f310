"""Quality selection by importance resampling.

Words and word pairs are hashed into buckets.  Two generative models, of the target
texts and of all raw texts, give each bucket a probability; a document's weight is
the mean log ratio of its n-grams.  Documents are drawn without replacement, in
proportion to their weights, by the Gumbel top-k method: noise is added to the log
weight and the largest keys are taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

_TOKEN = re.compile(r"\w+|[^\w\s]")
_REMEMBERED = 400_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class ResamplingSettings:
    """``max_target`` bounds the labelled texts behind the target model.

    ``sharpness`` scales the mean log ratio against the noise; ``fraction`` of all
    rows are drawn.
    """

    buckets: int = 16_384
    smoothing: float = 1.0
    max_target: int = 200_000
    sharpness: float = 20.0
    fraction: float = 0.8
    seed: int = 17


class Buckets:
    """Bucket numbers of a text's words and word pairs, remembering word hashes."""

    def __init__(self, buckets: int):
        self.buckets = np.uint64(buckets)
        self.known: dict[str, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = _TOKEN.findall(text.lower()) if text else []
        if not words:
            return np.zeros(0, np.int64)
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        one = np.array([known[w] for w in words], np.uint64)
        two = (one[:-1] * _SPREAD) ^ (one[1:] >> np.uint64(7))
        return (np.concatenate([one, two * _SPREAD >> np.uint64(11)]) % self.buckets).astype(np.int64)


def bucket_counts(docs: DataFrame, buckets: int, text_col: str = "text") -> np.ndarray:
    """Occurrences of every bucket over all rows; tasks count, and their counts are summed."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                total += np.bincount(hashed.of(text), minlength=buckets)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used.astype(np.int32), "n": total[used]})

    counted = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "bucket int, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``buckets`` rows at most
        out[row["bucket"]] = row["n"]
    return out


def log_ratios(docs: DataFrame, target_ids: DataFrame, settings: ResamplingSettings) -> np.ndarray:
    """log p_target - log p_raw of every bucket.

    The raw model counts all documents.  The target model counts those of
    ``target_ids(doc_id)``, or the ``max_target`` of smallest hash if there are
    more; without any, all ratios are 0.
    """
    s = settings
    ids = target_ids.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.max_target)
    chosen = docs.join(F.broadcast(ids), "doc_id", "left_semi")  # max_target numbers at most
    raw, target = bucket_counts(docs, s.buckets), bucket_counts(chosen, s.buckets)
    if not target.sum():
        return np.zeros(s.buckets)
    logs = [np.log((c + s.smoothing) / (c.sum() + s.smoothing * s.buckets)) for c in (target, raw)]
    return logs[0] - logs[1]


def weight(docs: DataFrame, ratios: np.ndarray, text_col: str = "text") -> Column:
    """Mean log ratio of a text's n-grams; 0 for a null text or one without words."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared.value
        hashed = Buckets(len(table))
        for texts in batches:
            found = map(hashed.of, texts)
            yield pd.Series([float(table[b].mean()) if len(b) else 0.0 for b in found], dtype="float64")

    return F.pandas_udf(score, "double")(F.col(text_col))


def gumbel(id_col: str, seed: int) -> Column:
    """Gumbel noise that depends on the id and the seed alone."""
    unit = (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(unit))


def kth_key(keyed: DataFrame, k: int, bins: int = 1000, few: int = 10_000) -> tuple[float, int | None] | None:
    """(key, doc_id) of the k-th row by falling key and rising doc_id.

    The interval that holds it is cut into bins until one holds few rows, or one
    key only; so each job returns ``bins`` or ``few`` rows.  ``keyed`` is read in
    every round and should be a written table.
    """
    if k <= 0:
        return None
    low, high = keyed.agg(F.min("key"), F.max("key")).first()
    above, inside = 0, keyed
    while low < high:
        step = (high - low) / bins
        number = F.least(F.lit(bins - 1), F.floor((F.col("key") - low) / step)) if step else F.lit(0)
        counted = inside.groupBy(number.alias("bin")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        for row in sorted(counted.collect(), key=lambda r: -r["bin"]):
            if above + row["n"] >= k:
                break
            above += row["n"]
        if (row["low"], row["high"]) == (low, high):
            break
        low, high = row["low"], row["high"]
        inside = keyed.filter(F.col("key").between(low, high))
        if row["n"] <= few:
            break
    last = inside.orderBy(F.col("key").desc(), F.col("doc_id").asc_nulls_first())
    if low == high:  # equal keys come from equal ids: repeated rows
        return low, inside.agg(F.max("doc_id")).first()[0]
    row = last.select("key", "doc_id").limit(k - above).collect()[-1]
    return row["key"], row["doc_id"]


def resample(docs: DataFrame, target_ids: DataFrame, settings: ResamplingSettings = ResamplingSettings()) -> DataFrame:
    """doc_id, log_weight, key, selected of every row of ``docs(doc_id, text)``.

    Null texts and texts without words have weight 0, that of a text as likely
    under either model.  Ties go to the smaller doc_id, null first; rows that
    repeat the last id drawn are all selected.
    """
    s = settings
    ratios = log_ratios(docs, target_ids, s)
    weighed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), weight(docs, ratios).alias("log_weight"))
    keyed = weighed.withColumn("key", s.sharpness * F.col("log_weight") + gumbel("doc_id", s.seed))
    keyed = materialize(keyed, "keys")
    last = kth_key(keyed, round(s.fraction * keyed.count()))
    if last is None:
        return keyed.withColumn("selected", F.lit(False))
    key, doc_id = last
    tied = F.col("doc_id").isNull() if doc_id is None else F.coalesce(F.col("doc_id") <= doc_id, F.lit(True))
    return keyed.withColumn("selected", (F.col("key") > key) | ((F.col("key") == key) & tied))


def select_quality(docs: DataFrame, labels: DataFrame, settings: ResamplingSettings = ResamplingSettings()) -> DataFrame:
    """Resample ``docs`` towards the documents labelled as of good quality."""
    return resample(docs, labels.filter(F.col("quality") == 1), settings)
