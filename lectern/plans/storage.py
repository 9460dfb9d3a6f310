"""Written intermediate tables and joins with small lookup tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup table is broadcast, or held by a model, only below both bounds.
MAX_LOOKUP_ROWS = 1 << 18
MAX_LOOKUP_BYTES = 64 << 20

# A key of the shuffled join is hot if it has more fact rows than both of these: a
# share of all rows, and rows that one task reads with ease.
HOT_SHARE = 1e-3
HOT_ROWS = 1 << 17
# Keys that the sketch of frequent keys follows; its error is below a quarter of HOT_SHARE.
HOT_TRACKED = 1 << 14

# The folder of a local session that names none.
_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: the one the cluster names for checkpoints.

    Only a local session that names none gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="lectern-"))
    return _OWN[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on the plan behind ``df`` nor on any executor
    staying alive, and later readers prune its columns and partitions.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize_vectors(df: DataFrame, size: int, entries: str, out: str, name: str = "vectors") -> DataFrame:
    """``materialize`` with sparse vectors of ``size`` made from a column of entries.

    ``entries`` is an array of (idx, value) in rising order, or null for a vector of
    zeros; ``out`` replaces it.  Files hold a vector as the struct it consists of, so
    that struct is written and read back as a vector: no row passes through Python.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    known = F.coalesce(entries, F.array().cast(df.schema[entries].dataType))
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"),  # fixed value: sparse
        F.lit(size).alias("size"),
        known["idx"].alias("indices"),
        known["value"].alias("values"),
    )
    kept = [c for c in df.columns if c not in (entries, out)]
    df.select(*kept, parts.alias(out)).write.parquet(path)
    fields = [T.StructField(c, df.schema[c].dataType) for c in kept]
    return spark.read.schema(T.StructType([*fields, T.StructField(out, VectorUDT())])).parquet(path)


def spread(df: DataFrame, key: str = "id") -> DataFrame:
    """Repartition by ``key`` an input of fewer tasks than there are cores.

    Meant for files that cannot be split, such as CSV with quoted line breaks.
    Any input of enough splits passes unchanged.  Plans the input, runs nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


@dataclass(frozen=True)
class LookupSize:
    rows: int
    nbytes: int

    @property
    def small(self) -> bool:
        return self.rows <= MAX_LOOKUP_ROWS and self.nbytes <= MAX_LOOKUP_BYTES


def measure_lookup(lookup: DataFrame, text_col: str) -> LookupSize:
    """Rows and approximate bytes of a written lookup table, in one small job."""
    fixed = 8 * len(lookup.columns)
    row = lookup.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.col(text_col)) + fixed), F.lit(0)).alias("nbytes"),
    ).first()
    return LookupSize(int(row["rows"]), int(row["nbytes"]))


def hot_keys(facts: DataFrame, on: str, share: float = HOT_SHARE, rows: int = HOT_ROWS) -> DataFrame:
    """Table (_key, _copies) of the frequent values of ``on``, by their hashes.

    A sketch of frequent items per task, merged, looks at every fact row in one job.
    It misses no key of more than ``share`` of the rows, and there are at most
    1 / ``share`` such keys, so the table is small whatever the data.  ``_copies`` is
    the number of tasks that bring the rows of a key below that share (or to ``rows``,
    if that is more).  Null counts as a key.  Only hashes are kept: where two keys
    share one, both are spread.
    """
    most = math.ceil(1 / share)
    sketch = F.expr(f"approx_top_k(_key, {most}, {max(HOT_TRACKED, most)})")
    row = facts.select(F.xxhash64(on).alias("_key")).agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).first()
    bound = max(share * row["n"], rows)
    found = [(r["item"], math.ceil(r["count"] / bound)) for r in row["top"] or [] if r["count"] > bound]
    return facts.sparkSession.createDataFrame(found, "_key bigint, _copies int")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    size: LookupSize,
    how: str = "inner",
    spread_by: Sequence[str] = ("id",),
    share: float = HOT_SHARE,
    rows: int = HOT_ROWS,
) -> DataFrame:
    """Join many fact rows with a lookup table whose ``on`` values are unique.

    A lookup table of measured small size is broadcast.  A larger one is shuffled.
    A single frequent word can hold a large part of the fact rows, so the hot keys
    are found first (``hot_keys``; the fact rows are read once more for it).  The rows
    of such a key are dealt by ``spread_by`` over as many salts as its share asks for,
    and only its lookup row is copied; all other keys are shuffled once and not copied.
    """
    if size.small:
        return facts.join(F.broadcast(lookup), on, how)
    hot = F.broadcast(hot_keys(facts, on, share, rows))  # at most 1 / share rows of two numbers

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", F.xxhash64(on)).join(hot, "_key", "left").drop("_key")

    copies = F.coalesce(F.col("_copies"), F.lit(1))
    dealt = F.pmod(F.xxhash64(*spread_by), copies).cast("int")
    salted_facts = marked(facts).withColumn("_salt", dealt).drop("_copies")
    salts = F.sequence(F.lit(0), copies - 1)
    salted_lookup = marked(lookup).withColumn("_salt", F.explode(salts)).drop("_copies")
    return salted_facts.join(salted_lookup, [on, "_salt"], how).drop("_salt")
