"""Exploration: class balance, lengths, subjects, frequent words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.functions.stopwords import ENGLISH_STOP_WORDS


def class_balance(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label")


def require_both_classes(df: DataFrame) -> DataFrame:
    """``df`` itself, or an error when fewer than two labels occur.

    Runs one job that returns two numbers.
    """
    seen = df.agg(F.min("label").alias("low"), F.max("label").alias("high")).first()
    if seen["low"] is None or seen["low"] == seen["high"]:
        raise ValueError("fewer than two classes present; take a larger sample")
    return df


def length_stats(df: DataFrame) -> DataFrame:
    size = F.length("text")
    return (
        df.groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(size).alias("min_len"),
            F.max(size).alias("max_len"),
            F.avg(size).alias("avg_len"),
        )
        .orderBy("label")
    )


def length_median(df: DataFrame) -> DataFrame:
    """Exact median with min, mean and max.

    Rows are first counted per (label, length), so what reaches the percentile
    is one row per distinct length, however many texts there are.
    """
    counted = (
        df.select("label", F.length("text").alias("text_length"))
        .groupBy("label", "text_length")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    size, n = F.col("text_length"), F.col("n")
    return (
        counted.groupBy("label")
        .agg(
            F.min(size).alias("min_len"),
            F.percentile(size, 0.5, n).alias("median_len"),
            (F.sum(size * n) / F.sum(n)).alias("avg_len"),
            F.max(size).alias("max_len"),
        )
        .orderBy("label")
    )


def top_subjects(df: DataFrame, k: int = 6) -> DataFrame:
    """The k most frequent subjects; a missing subject counts as one."""
    return (
        df.groupBy("subject")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_first("subject"))
        .limit(k)
    )


def restrict_to_top_subjects(df: DataFrame, k: int = 6) -> DataFrame:
    """Rows whose subject is among the k most frequent; null never matches.

    The broadcast side has at most k rows.
    """
    return df.join(F.broadcast(top_subjects(df, k).select("subject")), "subject", "left_semi")


def subject_label_pivot(df: DataFrame, k: int = 6) -> DataFrame:
    """Label counts of the k most frequent subjects, one column per label.

    The total that ranks subjects and the counts per label come from the same
    aggregation, so the corpus is read once and joined with nothing.
    """
    counts = df.groupBy("subject").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("label") == 0).alias("n_fake"),
        F.count_if(F.col("label") == 1).alias("n_real"),
    )
    return (
        counts.orderBy(F.desc("_n"), F.asc_nulls_first("subject"))
        .limit(k)
        .filter(F.col("subject").isNotNull())
        .select("subject", "n_fake", "n_real")
        .orderBy("subject")
    )


def word_rows(
    df: DataFrame,
    keep: Sequence[str] = ("label",),
    pattern: str = tx.LETTERS_ONLY,
    min_length: int = tx.MIN_TOKEN_LENGTH,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """One row per token that is no stop word.

    Tokens are filtered after the explode, inside generated code; a filter on
    the array would be interpreted.
    """
    word = F.col("word")
    return df.select(*keep, F.explode(tx.split_words(F.col("text"), pattern)).alias("word")).filter(
        tx.is_token(word, min_length) & ~tx.is_stop_word(word, stop_words)
    )


def word_counts(df: DataFrame, **tokens) -> DataFrame:
    return word_rows(df, **tokens).groupBy("label", "word").agg(F.count(F.lit(1)).alias("n"))


def top_words_per_label(df: DataFrame, k: int = 15, **tokens) -> DataFrame:
    """The k most frequent words of each label, ties by word.

    Every task keeps k words per label before the final ranking.
    """
    by_label = Window.partitionBy("label").orderBy(F.desc("n"), "word")
    return (
        word_counts(df, **tokens)
        .withColumn("rank", F.row_number().over(by_label))
        .filter(F.col("rank") <= k)
    )
