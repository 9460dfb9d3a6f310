"""Exact top-k inner products by aggregation without random access.

Candidates are dealt into shards.  A shard keeps one list per dimension, sorted by
value.  For a query the lists are read in step, each from the end that its query
component favours.  What is read raises a candidate's lower bound and lowers its
upper bound; reading stops when no candidate outside a small set can still reach
the k-th best lower bound, and the scores of that set are then resolved.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

K = 10
SCALE = 1024
SHARD_ROWS = 8192
QUERY_ROWS = 512
#: Candidates whose scores are resolved directly once reading has stopped.
RESOLVED = 512
#: Scores are bigint.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null for a vector that takes no part.

    That is one that is null or empty, or holds a null, NaN or infinite component.
    A finite component whose value is no bigint is an error.
    """
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def cell(x: Column) -> Column:
        y = x.cast("double") * scale
        whole = (y >= float(LEAST)) & (y < -float(LEAST))
        return F.when(whole, F.floor(y)).otherwise(F.raise_error(F.lit("a component is too large for a bigint")))

    return F.when((F.size(vector) > 0) & F.forall(vector, fits), F.transform(vector, cell))


def _largest(x: np.ndarray) -> int:
    """Largest absolute value of whole numbers, which may be that of ``LEAST``."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


class SortedLists:
    """One list per dimension over the candidates of a shard, rising by value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.cells = vectors.astype(np.float64)
        self.places = np.argsort(self.cells, axis=0, kind="stable")
        self.values = np.take_along_axis(self.cells, self.places, axis=0)

    def search(self, own: np.ndarray, queries: np.ndarray, k: int):
        """(query number, ids, scores) of the best ``k`` for each row of ``queries``.

        All queries read the lists in step, those with a positive component from
        the high end, those with a negative one from the low end; a query that has
        stopped reads no further.  ``own`` are the ids no query may return for
        itself.  Ties go to smaller ids.  Scores are exact: Python integers where
        sums might pass 64 bits.
        """
        n, dims = self.cells.shape
        low, high = self.values[0], self.values[-1]
        column = np.arange(dims)
        from_high, from_low = np.zeros((n, dims), bool), np.zeros((n, dims), bool)
        open_ = np.arange(len(queries))
        slack = 1e-12 * dims * np.abs(self.cells).max(initial=0) * np.abs(queries).max(initial=0)
        wide = dims * _largest(self.vectors) * _largest(queries) > MOST
        depth, step = 0, max(1, n // 16)
        while len(open_):
            end = min(n, depth + step)
            from_high[self.places[n - end : n - depth], column] = True
            from_low[self.places[depth:end], column] = True
            depth, step = end, 2 * step
            asked = queries[open_].astype(np.float64).T
            plus, minus = np.maximum(asked, 0), np.minimum(asked, 0)
            # An unread entry lies between the far end of its list and the place reached.
            lower = np.where(from_high, self.cells, low) @ plus
            lower += np.where(from_low, self.cells, high) @ minus
            upper = np.where(from_high, self.cells, self.values[n - depth]) @ plus
            upper += np.where(from_low, self.cells, self.values[depth - 1]) @ minus
            lower[self.ids[:, None] == own[open_]] = -np.inf
            kth = np.partition(lower, n - k, axis=0)[n - k] if n > k else np.full(len(open_), -np.inf)
            qualify = upper >= kth - slack
            done = (qualify.sum(axis=0) <= max(RESOLVED, k)) | (depth == n)
            for at in np.flatnonzero(done):
                query = open_[at]
                rows = np.flatnonzero(qualify[:, at] & (self.ids != own[query]))
                if wide:
                    score = self.vectors[rows].astype(object) @ queries[query].astype(object)
                    best = sorted(range(len(rows)), key=lambda i: (-score[i], self.ids[rows[i]]))[:k]
                else:
                    score = self.vectors[rows] @ queries[query]
                    best = np.lexsort((self.ids[rows], -score))[:k]
                yield query, self.ids[rows[best]], score[best]
            open_ = open_[~done]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "cells",
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of every query.

    ``vector_col`` holds integer arrays of one length; rows where it or the id is
    null take no part, vectors of another length than the query's meet no such
    query.  A query's own row is no candidate for it.  Fewer candidates than ``k``
    give fewer rows; a repeated id is a candidate for each of its rows, a repeated
    query is answered once.  A score among the best that is no bigint is an error.

    Every pair of a shard and a block of queries is one group of bounded size.
    """
    cand = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("cells"))
    cand = cand.filter(F.col("vec_id").isNotNull() & F.col("cells").isNotNull())
    asked = queries.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("cells"))
    asked = asked.filter(F.col("vec_id").isNotNull() & F.col("cells").isNotNull()).dropDuplicates(["vec_id"])
    cand, asked = materialize(cand, "candidates"), materialize(asked, "queries")
    shards = max(1, -(-cand.count() // shard_rows))
    blocks = max(1, -(-asked.count() // query_rows))

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda col, n: F.pmod(F.xxhash64(*col), F.lit(n)).cast("int")
    left = cand.withColumn("shard", place(("vec_id", "cells"), shards)).withColumn("block", every(blocks))
    right = asked.withColumn("block", place(("vec_id",), blocks)).withColumn("shard", every(shards))

    def search(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        widths = shard["cells"].map(len)
        for width in widths.unique():
            part, asked = shard[widths == width], block[block["cells"].map(len) == width]
            if len(asked):
                own = asked["vec_id"].to_numpy(np.int64)
                lists = SortedLists(part["vec_id"].to_numpy(np.int64), np.stack(part["cells"].to_numpy()))
                for query, got, score in lists.search(own, np.stack(asked["cells"].to_numpy()), k):
                    found.append((np.full(len(got), own[query]), got, score))
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "beyond": []})
        query, vec, score = map(np.concatenate, zip(*found, strict=True))
        beyond = (score > MOST).astype(np.int64) - (score < LEAST).astype(np.int64)
        score = np.where(beyond == 0, score, 0).astype(np.int64)
        return pd.DataFrame({"query_id": query, "vec_id": vec, "score": score, "beyond": beyond})

    partial = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInPandas(search, "query_id bigint, vec_id bigint, score bigint, beyond bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("beyond").desc(), F.col("score").desc(), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    error = F.raise_error(F.lit("a score is too large for a bigint"))
    score = F.when(F.col("beyond") == 0, F.col("score")).otherwise(error)
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))


def nearest(embeddings: DataFrame, every: int = 100, k: int = K) -> DataFrame:
    """Top ``k`` for the rows whose vec_id is divisible by ``every``, against all rows."""
    table = embeddings.select("vec_id", quantized(F.col("embedding")).alias("cells"))
    return top_k(table, table.filter(F.col("vec_id") % every == 0), k)
