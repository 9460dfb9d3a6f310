"""Samples and splits that depend on row keys only, never on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators.ranking import largest, top_k
from lectern.plans.storage import materialize

SEED = 42
#: Rows that one task may gather.
GATHERED_ROWS = 1000
_BITS = 32


def _draw(key: str, seed: int) -> Column:
    """32 hex digits per key: a uniform draw that any engine can repeat."""
    return F.md5(F.concat(tx.row_key(key).cast("string"), F.lit(f":{seed}")))


def _below(key: str, fraction: float, seed: int) -> Column:
    """The draw lies below a fraction of its range, to a precision of 2**-32."""
    if fraction >= 1.0:
        return F.lit(True)
    return F.substring(_draw(key, seed), 1, 8) < F.lit(f"{int(fraction * (1 << _BITS)):08x}")


def sample_rows(df: DataFrame, fraction: float, seed: int = SEED, key: str = "id") -> DataFrame:
    """Bernoulli sample by key.  Copies of a key fall on the same side."""
    return df.filter(_below(key, fraction, seed))


def sample_rows_by_position(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """Spark's own Bernoulli sample; changes with the partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_rows(df: DataFrame, n: int, seed: int = SEED, key: str = "id") -> DataFrame:
    """The ``n`` rows with the smallest draws; ties by key.

    A few rows are gathered in one job.  Of very many only the last draw is found,
    and no task holds them; the rows are written for that.
    """
    if n <= GATHERED_ROWS:
        return top_k(df, [_draw(key, seed), key], n).drop("rank")
    # The first 60 bits of a draw as a number; largest() takes the other end.
    first = -F.conv(F.substring("_draw", 1, 15), 16, 10).cast("bigint")
    drawn = df.withColumn("_draw", _draw(key, seed)).withColumn("_first", first)
    return largest(materialize(drawn, "drawn"), "_first", ["_draw", key], n).select(*df.columns)


def first_rows(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    return top_k(df, [key], n).drop("rank")


def assign_split(
    df: DataFrame,
    weights: dict[str, float] | None = None,
    seed: int = SEED,
    key: str = "id",
) -> DataFrame:
    """Adds column ``split``; the default is 80 % train, 20 % test.

    Narrow.  Use ``key="text"`` for sources without an id.
    """
    weights = weights or {"train": 0.8, "test": 0.2}
    names, total = list(weights), sum(weights.values())
    column, edge = F.lit(names[-1]), 1.0
    for name, nxt in zip(reversed(names[:-1]), reversed(names[1:])):
        edge -= weights[nxt] / total
        column = F.when(_below(key, edge, seed), name).otherwise(column)
    return df.withColumn("split", column)


def split_rows(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = SEED, key: str = "id"
) -> list[DataFrame]:
    named = {str(i): w for i, w in enumerate(weights)}
    marked = assign_split(df, named, seed, key)
    return [marked.filter(F.col("split") == name).drop("split") for name in named]


def split_rows_by_position(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = SEED
) -> list[DataFrame]:
    """Spark's ``randomSplit``; changes with the partitioning."""
    return df.randomSplit(list(weights), seed=seed)
