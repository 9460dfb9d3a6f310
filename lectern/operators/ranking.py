"""Top-k, selection of very many, ranks and running sums, none of them in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

# Tasks that share the first merge of the per-task candidates.
MERGE_TASKS = 64


def top_k(df: DataFrame, order: Sequence[Column | str], k: int, by: Sequence[str] = ()) -> DataFrame:
    """The first k rows per group ``by`` under a total ``order``, as column ``rank``.

    Each task keeps k rows per group, some tasks merge those of many, and only
    then one task per group takes the final k.  Which tasks are merged together
    does not matter to the result.
    """
    merge = F.pmod(F.spark_partition_id(), F.lit(MERGE_TASKS))
    first = Window.partitionBy(*by, "_merge").orderBy(*order)
    last = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order)
    candidates = (
        df.withColumn("_merge", merge)
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= k)
        .drop("_rank", "_merge")
    )
    return candidates.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)


@dataclass(frozen=True)
class Cut:
    """Where the k-th value lies: ``above`` rows exceed it, ``equal`` rows have it."""

    value: int | float
    above: int
    equal: int


def kth_cut(df: DataFrame, column: str, k: int, bins: int = 1024) -> Cut | None:
    """The k-th largest value of a numeric column; None if there are fewer than k.

    Histograms are refined around it: each job returns a row per bin, and the next
    one looks only at the bin that holds the value.  So no task ranks anything and
    none hands on k rows.  ``df`` is read in every round and should be written.
    """
    value = F.col(column)
    low, high, n = df.agg(F.min(value), F.max(value), F.count(value)).first()
    if k < 1 or n < k:
        return None
    above, equal = 0, n
    while low < high:
        width = (high - low) / bins
        # Bins too narrow for a double leave the largest value apart from the others.
        place = F.floor((value - low) / width) if low + width > low else F.when(value == high, bins - 1).otherwise(0)
        counted = (
            df.filter(value.between(low, high))
            .groupBy(F.least(F.lit(bins - 1), place).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        )
        for row in sorted(counted.collect(), key=lambda r: -r["bin"]):
            if above + row["n"] >= k:
                break
            above += row["n"]
        low, high, equal = row["low"], row["high"], row["n"]
    return Cut(low, above, equal)


def largest(df: DataFrame, column: str, ties_by: Sequence[Column | str], k: int) -> DataFrame:
    """The k rows of largest ``column``, ties in the order ``ties_by``, of a written table.

    For a k too large to gather in one task.  Rows without a value come in no
    place.  Only the rows that tie with the last one are ranked.
    """
    cut = kth_cut(df, column, k)
    if cut is None:
        return df.filter(F.col(column).isNotNull() & F.lit(k > 0))
    more, ties = df.filter(F.col(column) > cut.value), df.filter(F.col(column) == cut.value)
    if cut.above + cut.equal > k:
        ties = numbered(ties, ties_by).filter(F.col("rank") <= k - cut.above).drop("rank")
    return more.unionByName(ties)


def first_by_hash(ids: DataFrame, key: str, k: int) -> DataFrame:
    """The k rows whose ``key`` hashes lowest, ties by key: a bounded sample of distinct
    keys that does not depend on partitioning and is drawn in no single task."""
    marked = ids.withColumn("_hash", F.xxhash64(key))
    # 53 bits, falling as the hash rises: differences of these do not overflow.
    marked = marked.withColumn("_order", F.bitwise_not(F.shiftright("_hash", 11)))
    chosen = largest(materialize(marked, "hashed"), "_order", ["_hash", key], k)
    return chosen.drop("_hash", "_order")


def _ordered_parts(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` in written ranges of the order, with the range (_part) and the place in it (_at).

    Range bounds are drawn from a sample, so they hold only once they are written.
    """
    ordered = df.repartitionByRange(*(F.col(c) if isinstance(c, str) else c for c in order))
    ordered = ordered.sortWithinPartitions(*order)
    # An increasing id holds the partition above 33 bits that count its rows.
    place = F.monotonically_increasing_id()
    at = place.bitwiseAND(F.lit((1 << 33) - 1))
    return materialize(ordered.withColumn("_part", F.shiftright(place, 33).cast("int")).withColumn("_at", at), "ranges")


def _offsets(counts: Sequence[tuple], spark: SparkSession, by: Sequence[tuple[str, str]], kind: str) -> DataFrame:
    """What the earlier ranges of a group hold: rows (_part, group, _before).

    ``counts`` has a row per range and group, in the order of ranges.
    """
    rows, so_far = [], {}
    for part, *group, held in counts:
        rows.append((part, *group, so_far.get(tuple(group), type(held)(0))))
        so_far[tuple(group)] = rows[-1][-1] + held
    schema = ", ".join(f"`{name}` {t}" for name, t in [("_part", "int"), *by, ("_before", kind)])
    return spark.createDataFrame(rows, schema)


def numbered(
    df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = (), total: str | None = None
) -> DataFrame:
    """Adds ``rank``, from 1 under a total ``order`` inside the groups ``by``, to any number of rows.

    With ``total``, adds ``running`` as well: the sum of that column up to the row.

    Rows are range-partitioned by group and order, so that a large group covers many
    ranges.  A range counts and sums what it holds; the sums of the ranges before it,
    one row per range and group, are broadcast; the rest happens inside ranges.
    """
    spark, by = df.sparkSession, list(by)
    parts = _ordered_parts(df, [*by, *order])
    inside = Window.partitionBy("_part", *by).orderBy("_at")
    sums = [F.count(F.lit(1)).alias("n")]
    if total:
        sums.append(F.coalesce(F.sum(F.col(total).cast("double")), F.lit(0.0)).alias("total"))
    held = sorted(parts.groupBy("_part", *by).agg(*sums).collect(), key=lambda r: r["_part"])
    types = [(name, df.schema[name].dataType.simpleString()) for name in by]

    def shifted(rows: DataFrame, own: Column, field: str, kind: str, name: str) -> DataFrame:
        before = _offsets([(r["_part"], *(r[b] for b in by), r[field]) for r in held], spark, types, kind)
        rows = rows.withColumn("_own", own)
        same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("_part", *by)]
        joined = rows.alias("l").join(F.broadcast(before).alias("r"), same)  # one row per range and group
        return joined.select("l.*", (F.col("_own") + F.col("_before")).alias(name)).drop("_own")

    out = shifted(parts, F.row_number().over(inside).cast("bigint"), "n", "bigint", "rank")
    if total:
        upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        own = F.coalesce(F.sum(F.col(total).cast("double")).over(upto), F.lit(0.0))
        out = shifted(out, own, "total", "double", "running")
    return out.drop("_part", "_at")
