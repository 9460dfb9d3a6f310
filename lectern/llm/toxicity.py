"""Toxicity: a linear classifier with a counterfactual penalty.

Every labelled text also has a counterfactual, in which each identity term is
swapped for another of its group.  Besides the logistic loss, training pays for
the squared change of the score between the two, so a neutral mention of a group
moves no score.  Features are the presence of words that the two classes use
differently.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

_WORD = re.compile(r"[^\W\d_]+")

#: Groups of terms that can stand for each other.
IDENTITY_GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("man", "woman"),
    ("men", "women"),
    ("male", "female"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "arab", "chinese", "mexican", "indian"),
    ("immigrant", "citizen", "refugee"),
    ("immigrants", "citizens", "refugees"),
    ("young", "old"),
    ("deaf", "blind", "disabled"),
)


@dataclass(frozen=True)
class ToxicitySettings:
    """``max_rows`` bounds the labelled rows that the classifier is fitted on."""

    max_rows: int = 20_000
    min_rows: int = 10
    max_words: int = 8192
    min_z: float = 4.0
    l2: float = 2e-5
    counterfactual: float = 1.0
    steps: int = 40
    rate: float = 0.5
    groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def swap_words(words: set[str], groups: tuple[tuple[str, ...], ...]) -> set[str]:
    """The words with each identity term replaced by the next one of its group."""
    swap = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    return {swap.get(w, w) for w in words}


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    intercept: float

    def score(self, text: str | None) -> float:
        known = self.weights.keys() & words_of(text)
        z = self.intercept + math.fsum(self.weights[w] for w in known)
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()
) -> ToxicityModel:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    Null labels and labels without a document are left out; a document labelled
    twice counts as toxic if one label says so.  If there are more than
    ``max_rows`` labelled ids, those of smallest hash are used.  With labels of
    one class only, or none, every text scores below 0.5.
    """
    s = settings
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(s.max_rows)
    )
    # At most max_rows short rows: the broadcast has that bound.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), 500):
                part = batch.iloc[first : first + 500]
                found = [words_of(t) for t in part["text"]]
                yield pd.DataFrame(
                    {
                        "toxic": part["toxic"].to_list(),
                        "words": [sorted(w) for w in found],
                        "swapped": [sorted(swap_words(w, s.groups)) for w in found],
                    }
                )

    schema = "toxic int, words array<string>, swapped array<string>"
    table = materialize(rows.select("toxic", "text").mapInPandas(features, schema), "toxic-rows")
    classes = {r["toxic"]: r["n"] for r in table.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    positive, negative = classes.get(1, 0), classes.get(0, 0)
    if not positive or not negative:
        return ToxicityModel({}, -1.0)

    vocabulary = _vocabulary(table, positive, negative, s)
    index = {w: i for i, w in enumerate(vocabulary)}
    w, b = np.zeros(len(vocabulary)), math.log(positive / negative)
    coded = _coded(table, index)
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    n = positive + negative
    for step in range(1, s.steps + 1):  # Adam over the whole sample
        total = _gradient(coded, np.append(w, b), s.counterfactual)
        grad = total / n
        grad[:-1] += s.l2 * w
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        move = s.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return ToxicityModel({v: float(x) for v, x in zip(vocabulary, w, strict=True) if x}, float(b))


def _vocabulary(table: DataFrame, positive: int, negative: int, s: ToxicitySettings) -> list[str]:
    """Identity terms, and the words whose shares of rows differ most between the classes."""
    terms = sorted({t for g in s.groups for t in g})
    share = (F.col("p") + F.col("q")) / (positive + negative)
    spread = F.sqrt(share * (1 - share) * (1 / positive + 1 / negative))
    z = F.abs(F.col("p") / positive - F.col("q") / negative) / F.greatest(spread, F.lit(1e-12))
    found = (
        table.select("toxic", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count_if(F.col("toxic") == 1).alias("p"), F.count_if(F.col("toxic") != 1).alias("q"))
        .filter(F.col("p") + F.col("q") >= s.min_rows)
        .withColumn("z", z)
        .filter((F.col("z") >= s.min_z) | F.col("word").isin(terms))
        .orderBy(F.col("word").isin(terms).desc(), F.col("z").desc(), "word")
        .limit(s.max_words)
        .collect()
    )
    return sorted(r["word"] for r in found)


def _coded(table: DataFrame, index: dict[str, int]) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(index)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = shared.value.get
        pick = lambda words: [i for i in map(get, words) if i is not None]
        for batch in batches:
            yield pd.DataFrame(
                {
                    "toxic": batch["toxic"],
                    "words": batch["words"].map(pick),
                    "swapped": batch["swapped"].map(pick),
                }
            )

    schema = "toxic int, words array<int>, swapped array<int>"
    return materialize(table.mapInPandas(code, schema).coalesce(6), "toxic-coded")


def _gradient(coded: DataFrame, model: np.ndarray, counterfactual: float) -> np.ndarray:
    """Sum over all rows of the gradient of loss and counterfactual penalty."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, total = model[:-1], np.zeros(len(model))
        for batch in batches:
            for toxic, words, swapped in zip(batch["toxic"], batch["words"], batch["swapped"], strict=True):
                words, swapped = np.asarray(words, np.int64), np.asarray(swapped, np.int64)
                z = w[words].sum()
                error = 1 / (1 + math.exp(-max(-700.0, min(700.0, z + model[-1])))) - (toxic == 1)
                total[words] += error
                total[-1] += error
                if not np.array_equal(words, swapped):
                    change = 2 * counterfactual * (z - w[swapped].sum())
                    total[words] += change
                    total[swapped] -= change
        yield pd.DataFrame({"gradient": [total]})

    parts = coded.mapInPandas(partial, "gradient array<double>")
    # One vector per task, and the coded rows lie in at most six tasks.
    return np.sum([np.zeros(len(model)), *(r["gradient"] for r in parts.collect())], axis=0)


def toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> Column:
    """Score column, a narrow expression.  Null and empty texts get the intercept's score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(shared.value.score)

    return F.pandas_udf(score, "double")(F.col(text_col))


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """True for the ids whose crc32 falls in the held-out fold; a null id is never in it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit_toxicity(docs.filter(~held_out()), labels)
    found = docs.select("doc_id", held_out().alias("held_out"), toxicity(docs, model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
