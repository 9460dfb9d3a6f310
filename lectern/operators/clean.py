"""Cleaning, de-duplication by content, row accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx

# Fixed value: cleaned texts shorter than this are dropped.
MIN_TEXT_LENGTH = 30


def clean_text(
    df: DataFrame, min_text_length: int = MIN_TEXT_LENGTH, require_title: bool = False
) -> DataFrame:
    """Drop absent texts, clean text and title, drop what is then too short.

    Narrow: one pass, no shuffle, also valid on a stream.  The cleaned text
    leaves through a generator: Catalyst would otherwise copy the replacements
    into the length filter and scan every text twice.
    """
    kept = [F.col(c) for c in df.columns if c not in ("title", "text")]
    if "title" in df.columns:
        kept.append(tx.clean_title(F.col("title")).alias("title"))
    once = F.explode(F.array(tx.clean_body(F.col("text")))).alias("text")
    out = df.filter(tx.is_present(F.col("text"))).select(*kept, once)
    out = out.filter(F.length("text") >= min_text_length)
    if require_title:
        out = out.filter(tx.is_present(F.col("title")))
    return out.select(*df.columns)


def clean_columns(df: DataFrame) -> DataFrame:
    """Cleaned text and title, all rows kept."""
    cleaned = {"text": tx.clean_body(F.col("text"))}
    if "title" in df.columns:
        cleaned["title"] = tx.clean_title(F.col("title"))
    return df.withColumns(cleaned)


def content_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """(key, digest, hash): all that de-duplication needs to know about a row.

    The digest tells texts apart; the hash, cheaper to take again, finds the row of
    a key that repeats.
    """
    text = F.col("text")
    digest, hashed = tx.content_digest(text).alias("digest"), F.xxhash64(text).alias("hash")
    return df.select(tx.row_key(key).alias(key), digest, hashed)


def dedup_text(df: DataFrame, key: str | None = "id", keys: DataFrame | None = None) -> DataFrame:
    """One row per distinct text: the one with the smallest key.

    Survivors are found on keys and hashes alone.  Those aggregate on the map side,
    so a text with very many copies costs one short row per map task.  The wide rows
    are then filtered by key and hash, which are evenly spread, and not shuffled at
    all if they already lie by key (after a join on it, or in a table bucketed by
    it).  A key may repeat, as when two sources number theirs alike: its texts are
    judged each by itself, and of rows that share key and text one stays.

    ``keys`` replaces ``content_keys(df)`` for a caller who can get the same
    pairs cheaper, say from before a join that would carry the texts along.

    Without a key the smallest whole row of each text survives; this too is
    independent of partitioning, but moves whole rows.
    """
    if key is None:
        row = F.struct(*df.columns)
        return (
            df.groupBy(tx.content_digest(F.col("text")).alias("_digest"))
            .agg(F.min(row).alias("_row"))
            .select("_row.*")
        )
    keys = content_keys(df, key) if keys is None else keys
    smallest = keys.groupBy("digest", F.col("hash").alias("_hash")).agg(F.min(key).alias(key))
    survivors = smallest.select(key, "_hash")
    marked = df.withColumn("_hash", F.xxhash64("text"))
    kept = marked.join(survivors, [key, "_hash"], "left_semi").dropDuplicates([key, "_hash"])
    return kept.select(*df.columns)


def _surviving(keys: DataFrame, key: str) -> DataFrame:
    return keys.groupBy("digest").agg(F.min(key).alias(key)).select(key)


def clean_and_dedup(
    df: DataFrame,
    min_text_length: int = MIN_TEXT_LENGTH,
    key: str = "id",
    keys: DataFrame | None = None,
) -> DataFrame:
    """``dedup_text(clean_text(df))`` for a unique key, arranged for the optimizer.

    A key that repeats among the rows, as when two sources number theirs alike,
    fails the job: filtering by it would keep rejected rows.

    A surviving key has passed every filter of the cleaner, so the rows are only
    filtered by key and cleaned afterwards.  A query that does not use the texts
    then never reads them here, and no rejected or repeated text is cleaned.
    """
    if keys is None:
        keys = _all_keys(df, min_text_length, key)
    return clean_columns(df.join(_surviving(_unique(keys, key), key), key, "left_semi"))


def _all_keys(df: DataFrame, min_text_length: int, key: str) -> DataFrame:
    """``content_keys`` of all rows; the digest is null where the cleaner drops the row."""
    once = F.explode(F.array(tx.clean_body(F.col("text")))).alias("text")
    cleaned = df.select(key, tx.is_present(F.col("text")).alias("_there"), once)
    kept = F.coalesce(F.col("_there") & (F.length("text") >= min_text_length), F.lit(False))
    digest = F.when(kept, tx.content_digest(F.col("text"))).alias("digest")
    return cleaned.select(tx.row_key(key).alias(key), digest)


def _unique(keys: DataFrame, key: str) -> DataFrame:
    """The keys that have a digest; an error where one occurs twice."""
    twice = F.raise_error(F.lit(f"{key} is not unique: number all sources together, or use no key"))
    found = keys.groupBy(key).agg(F.max("digest").alias("digest"), F.count(F.lit(1)).alias("n"))
    checked = F.when(F.col("n") > 1, twice.cast("binary")).otherwise(F.col("digest"))
    return found.select(key, checked.alias("digest")).filter(F.col("digest").isNotNull())


def dedup_text_any(df: DataFrame) -> DataFrame:
    """One arbitrary row per distinct text: cheapest when no key exists and the
    choice does not matter."""
    hashed = df.withColumn("_hash", tx.content_hash(F.col("text")))
    return hashed.dropDuplicates(["_hash"]).drop("_hash")


def duplicate_groups(df: DataFrame, key: str = "id") -> DataFrame:
    """Texts that occur more than once: copies, smallest key, distinct labels.

    ``n_labels`` above 1 marks a text that carries contradicting labels.
    """
    return (
        df.select(key, "label", tx.content_digest(F.col("text")).alias("digest"))
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(key).alias("min_id"),
            (
                F.max(F.when(F.col("label") == 0, 1).otherwise(0))
                + F.max(F.when(F.col("label") == 1, 1).otherwise(0))
            ).alias("n_labels"),
        )
        .filter(F.col("copies") > 1)
        .select(F.lower(F.hex("digest")).alias("text_hash"), "copies", "min_id", "n_labels")
    )


def clean_report(
    df: DataFrame, min_text_length: int = MIN_TEXT_LENGTH, dedup: bool = True
) -> DataFrame:
    """One row with the rows before and after cleaning, in a single pass.

    Rejected rows share the null hash, accepted rows are counted per hash on the
    map side; neither form of skew reaches a single task.
    """
    body = df.select(
        F.explode(
            F.array(F.when(tx.is_present(F.col("text")), tx.clean_body(F.col("text"))))
        ).alias("text")
    )
    hashed = body.select(
        F.when(F.length("text") >= min_text_length, tx.content_digest(F.col("text"))).alias("h")
    )
    per_hash = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    after = F.count("h") if dedup else F.sum(F.when(F.col("h").isNotNull(), F.col("n")))
    totals = per_hash.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.coalesce(after, F.lit(0)).alias("rows_after"),
    )
    return totals.select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("dropped"),
        F.lit(min_text_length).alias("min_text_length"),
        F.lit(dedup).alias("dedup"),
    )
