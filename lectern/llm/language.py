"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram is the product of its
letters' vectors, each permuted (rotated) once for every place it stands before
the last, and a text is the sum of its trigrams.  A language prototype is the sum
over its training texts.  A document gets the language of highest cosine.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = 64  # symbol 0 is the gap between words
DIMENSIONS = 1024
SEED = 20240
#: Languages a model may hold; it is collected, so their number is checked.
MAX_LANGUAGES = 2000
UNKNOWN = "und"
#: Texts counted into one dense matrix.
_SLICE = 128


@cache
def _symbols() -> np.ndarray:
    """Symbol of every code point: 0 for what is no letter.

    a-z have symbols of their own; other letters share the remaining ones.
    """
    rest = SYMBOLS - 27
    table = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for point in range(sys.maxunicode + 1):
        if chr(point).isalpha():
            table[point] = 1 + point - 97 if 97 <= point <= 122 else 27 + point % rest
    return table


def _codes(text: str) -> np.ndarray:
    """Trigrams of a text as numbers; a gap stands before and after each word."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbols = np.zeros(len(points) + 2, dtype=np.int32)
    symbols[1:-1] = _symbols()[points]
    middle = symbols[1:-1]
    codes = (symbols[:-2] * SYMBOLS + middle) * SYMBOLS + symbols[2:]
    return codes[middle > 0]


def _lettered(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass(frozen=True)
class Letters:
    """Random letter vectors, permuted for the three places of a trigram."""

    first: np.ndarray
    second: np.ndarray
    third: np.ndarray

    @staticmethod
    def draw(dimensions: int = DIMENSIONS, seed: int = SEED) -> Letters:
        signs = np.random.default_rng(seed).integers(0, 2, (SYMBOLS, dimensions)) * 2 - 1
        base = signs.astype(np.float32)
        return Letters(np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base)

    def bind(self, codes: np.ndarray) -> np.ndarray:
        a, rest = np.divmod(codes, SYMBOLS * SYMBOLS)
        b, c = np.divmod(rest, SYMBOLS)
        return self.first[a] * self.second[b] * self.third[c]

    def bundle(self, texts: list[str]) -> np.ndarray:
        """One vector per text."""
        codes = [_codes(t) for t in texts]
        flat = np.concatenate(codes) if codes else np.zeros(0, np.int32)
        used = np.flatnonzero(np.bincount(flat, minlength=SYMBOLS**3))
        if not len(used):
            return np.zeros((len(texts), self.third.shape[1]), np.float32)
        place = np.zeros(SYMBOLS**3, dtype=np.int64)
        place[used] = np.arange(len(used))
        row = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
        counts = np.bincount(row * len(used) + place[flat], minlength=len(texts) * len(used))
        out = np.zeros((len(texts), self.third.shape[1]), np.float32)
        for start in range(0, len(used), 8192):
            part = slice(start, start + 8192)
            counted = counts.reshape(len(texts), -1)[:, part].astype(np.float32)
            out += counted @ self.bind(used[part])
        return out


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # one unit vector per language
    letters: Letters

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        for start in range(0, len(texts), _SLICE):
            part = [t or "" for t in texts[start : start + _SLICE]]
            vectors = self.letters.bundle(part)
            norms = np.linalg.norm(vectors, axis=1)
            lettered = [_lettered(t) if n == 0 else True for t, n in zip(part, norms, strict=True)]
            if not self.languages:
                out += [(UNKNOWN, 0.0)] * len(part)
                continue
            cosines = vectors @ self.prototypes.T / np.maximum(norms, 1e-9)[:, None]
            best = cosines.argmax(axis=1)
            for i, k in enumerate(best):
                score = float(min(1.0, max(0.0, cosines[i, k])))
                out.append((self.languages[k], score) if lettered[i] else (UNKNOWN, 0.0))
        return out


def fit_profiles(
    train: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
    max_languages: int = MAX_LANGUAGES,
) -> Profiles:
    """Prototypes from all rows with a language.

    Tasks count trigrams per language and bundle them once, so only a vector per
    task and language is shuffled.  Rows without text or language add nothing;
    without any row the model knows no language.  More than ``max_languages``
    distinct languages raise an error.
    """
    letters = Letters.draw(dimensions, seed)
    shared = train.sparkSession.sparkContext.broadcast(letters)

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}

        def vectors() -> Iterator[pd.DataFrame]:
            for lang, counted in counts.items():
                used, total = np.flatnonzero(counted), np.zeros(dimensions)
                for start in range(0, len(used), 8192):
                    part = used[start : start + 8192]
                    total += counted[part].astype(np.float64) @ shared.value.bind(part)
                yield pd.DataFrame({"lang": [lang], "vector": [total]})
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                if lang not in counts:
                    if len(counts) == 64:  # bounds what a task holds
                        yield from vectors()
                    counts[lang] = np.zeros(SYMBOLS**3, dtype=np.int64)
                codes, times = np.unique(_codes(text), return_counts=True)
                counts[lang][codes] += times
        yield from vectors()

    rows = train.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    summed = (
        rows.mapInPandas(bundle, "lang string, vector array<double>")
        .select("lang", F.posexplode("vector").alias("place", "value"))
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("cells"))
        .select("lang", F.col("cells.value").alias("vector"))
        .orderBy("lang")
        .limit(max_languages + 1)
        .collect()
    )
    if len(summed) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    matrix = np.array([r["vector"] for r in summed], dtype=np.float64).reshape(-1, dimensions)
    norms = np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    return Profiles([r["lang"] for r in summed], (matrix / norms).astype(np.float32), letters)


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> Column:
    """Column (lang, score): a narrow expression, so every row keeps its place.

    Null texts and texts without a letter get (und, 0); so do all without a
    trained language.  Ties go to the first language by spelling.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(shared.value.predict(list(texts)), columns=["lang", "score"])

    return F.pandas_udf(predict, "lang string, score double")(F.col(text_col))


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """True for the ids whose crc32 falls in the held-out fold; a null id is never in it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def predictions(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Prototypes come from the documents outside the held-out fold that name a
    language.
    """
    profiles = fit_profiles(docs.filter(~held_out()))
    found = docs.select("doc_id", held_out().alias("held_out"), identify(docs, profiles).alias("found"))
    return found.select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def keep_identified(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """The documents, all columns, whose language is known with ``min_score`` at least.

    As scores are never negative, at 0 only null texts and texts without letters
    are rejected, whatever the profiles; where there is no language to learn,
    these are rejected at any ``min_score``.  ``lang`` keeps its value.
    """
    profiles = fit_profiles(docs.filter(~held_out()))
    if not profiles.languages:
        return docs.filter(_has_letters(F.col("text")))
    mark = "__language"
    while mark in docs.columns:
        mark += "_"
    known = F.col(f"{mark}.lang") != UNKNOWN
    if UNKNOWN in profiles.languages:  # documents may name it, too
        known = _has_letters(F.col("text"))
    known &= F.col(f"{mark}.score") >= min_score
    return docs.withColumn(mark, identify(docs, profiles)).filter(known).drop(mark)


def _has_letters(text: Column) -> Column:
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(_lettered).astype(bool)

    return F.pandas_udf(look, "boolean")(text)
