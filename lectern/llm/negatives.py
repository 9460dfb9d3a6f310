"""Hard negatives by a vertical scan of dimensions that prunes by bounds (BOND).

Vectors lie in shards, one column of values per dimension.  For an anchor the
dimensions are read in the order of its falling magnitude.  Each adds to the partial
scores; the smallest and largest contribution of the dimensions not yet read bound
what is missing.  A bitmap holds the candidates that can still count, and shrinks
with every dimension, until the scores of those left are exact.

Two scans are made: one for the best rows of an anchor's own label, and, as these
fix the windows of scores, one for the best rows of other labels in each window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

SHARD_ROWS = 8192
#: Anchors that one scan holds, and the bytes of their vectors that may be broadcast.
SCAN_ANCHORS = 4096
SCAN_BYTES = 32 << 20
#: Dimensions read between two looks at the bounds, at least.  The next look waits
#: until what is unread can add this share of what it could at the last one.
STRIDE = 4
LOOK_SHARE = 0.5
#: Scores are bigint.  Whole numbers below this are exact in floating point.
MOST = (1 << 63) - 1
EXACT = 1 << 53


@dataclass(frozen=True)
class MiningSettings:
    """Windows are ``low`` to ``high`` hundredths of a positive's score."""

    scale: int = 256
    anchors_every: int = 50
    relabel_every: int = 7
    labels: int = 10
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95


def cells(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null if one is null, NaN, infinite, or there is none."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def cell(x: Column) -> Column:
        y = x.cast("double") * scale
        whole = (y >= -float(1 << 63)) & (y < float(1 << 63))
        return F.when(whole, F.floor(y)).otherwise(F.raise_error(F.lit("a component is too large for a bigint")))

    return F.when((F.size(vector) > 0) & fits, F.transform(vector, cell))


def usable(embeddings: DataFrame, settings: MiningSettings) -> DataFrame:
    """vec_id, label, cells of the rows that take part, with the labels changed."""
    s = settings
    rows = embeddings.select("vec_id", "label", cells(F.col("embedding"), s.scale).alias("cells"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("cells").isNotNull())
    changed = (F.col("label").cast("bigint") + 1) % s.labels
    label = F.when(F.col("vec_id") % s.relabel_every == 0, changed).otherwise(F.col("label"))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), "cells")


def sharded(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """dims, shard, ids, labels, columns: ``shard_rows`` vectors a row, by dimension.

    Rows are numbered first, so that those that repeat are spread as well.  A
    shard's ``columns`` holds one array per dimension.
    """
    numbered = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "vectors")
    shards = max(1, -(-numbered.count() // shard_rows))
    dealt = numbered.withColumn("shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))

    def stand(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        columns = list(np.stack(part["cells"].to_numpy()).T.astype(np.int64))
        row = (key[0], key[1], part["vec_id"].to_numpy(), part["label"].to_numpy(), columns)
        return pd.DataFrame([row], columns=["dims", "shard", "ids", "labels", "columns"])

    schema = "dims int, shard bigint, ids array<bigint>, labels array<bigint>, columns array<array<bigint>>"
    by = dealt.groupBy(F.size("cells").alias("dims"), "shard")
    return materialize(by.applyInPandas(stand, schema), "shards")


class Shard:
    """Vectors by dimension, with the least and largest value of each."""

    def __init__(self, ids, labels, columns):
        self.ids, self.labels = np.asarray(ids, np.int64), np.asarray(labels, np.int64)
        self.columns = [np.asarray(c, np.int64) for c in columns]
        self.low = np.array([c.min() for c in self.columns])
        self.high = np.array([c.max() for c in self.columns])
        self.largest = max(abs(int(x)) for x in (*self.low, *self.high))
        self.floats = [c.astype(np.float64) for c in self.columns] if self.largest < EXACT else None

    def bounds(self, anchor: np.ndarray) -> tuple[np.ndarray, list, list, np.ndarray]:
        """(reading order, least and largest sum of what is unread after n dimensions, anchor).

        Floating point serves where all sums are exact in it.  Python integers replace
        64 bits where sums might pass them.
        """
        bound = len(anchor) * self.largest * max(abs(int(x)) for x in anchor)
        order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
        if bound > MOST:
            anchor = anchor.astype(object)
        elif bound < EXACT and self.floats is not None:
            anchor = anchor.astype(np.float64)
        ends = np.stack([anchor * self.low.astype(anchor.dtype), anchor * self.high.astype(anchor.dtype)])[:, order]
        zero = np.zeros(1, ends.dtype)
        rest = [np.concatenate([np.cumsum(part[::-1])[::-1], zero]) for part in (ends.min(axis=0), ends.max(axis=0))]
        return order, list(rest[0]), list(rest[1]), anchor

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, exact scores, values read) of the candidates that ``keep`` leaves to the end.

        ``keep(lower, upper)`` tells which candidates can still count.
        """
        order, least, most, anchor = self.bounds(anchor)
        columns = self.floats if anchor.dtype == np.float64 else self.columns
        bitmap, read, looked = bitmap.copy(), 0, 0
        rows = np.flatnonzero(bitmap)
        # While most rows are candidates, whole columns are read: that is cheaper than picking.
        whole = np.zeros(len(bitmap), anchor.dtype) if 2 * len(rows) > len(bitmap) else None
        partial = np.zeros(len(rows), anchor.dtype)
        for start in range(0, len(order), STRIDE):
            if not len(rows):
                break
            for d in order[start : start + STRIDE]:
                if whole is not None:
                    whole += anchor[d] * columns[d].astype(anchor.dtype, copy=False)
                else:
                    partial += anchor[d] * columns[d][rows].astype(anchor.dtype, copy=False)
                read += len(rows)
            n = min(start + STRIDE, len(order))
            if n < len(order) and most[n] - least[n] > LOOK_SHARE * (most[looked] - least[looked]):
                continue
            looked = n
            partial = partial if whole is None else whole[rows]
            stay = keep(partial + least[n], partial + most[n])
            if not stay.all():
                bitmap[rows[~stay]] = False
                rows, partial = np.flatnonzero(bitmap), partial[stay]
                whole = whole if 2 * len(rows) > len(bitmap) else None
        return rows, partial.astype(np.int64) if columns is self.floats else partial, read

    def positives(self, own: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best ``k`` other rows of the label, ties to smaller ids."""

        def keep(lower, upper):
            return upper >= np.partition(lower, len(lower) - k)[len(lower) - k] if len(lower) > k else np.ones(len(lower), bool)

        rows, scores, _ = self.scan(anchor, (self.labels == label) & (self.ids != own), keep)
        return _first(self.ids[rows], scores, k)

    def negatives(self, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> list:
        """(ids, scores) per window (least, most score): the best ``k`` rows of other labels in it."""

        reach = {window: window[0] for window in windows}

        def keep(lower, upper):
            stay = np.zeros(len(lower), bool)
            for (least, most), known in reach.items():
                # Rows surely inside set what a further row has to reach.  Bounds only
                # close in, so those that did so before still count.
                sure = lower[(lower >= known) & (upper <= most)]
                if len(sure) >= k:
                    known = reach[least, most] = np.partition(sure, len(sure) - k)[len(sure) - k]
                stay |= (upper >= known) & (lower <= most)
            return stay

        rows, scores, _ = self.scan(anchor, self.labels != label, keep)
        out = []
        for least, most in windows:
            inside = (scores >= least) & (scores <= most)
            out.append(_first(self.ids[rows[inside]], scores[inside], k))
        return out


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` of highest score, ties to smaller ids."""
    if scores.dtype == object:
        best = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    else:
        best = np.lexsort((ids, -scores))[:k]
    return ids[best], scores[best]


def _score(values) -> list[int]:
    if any(abs(int(x)) > MOST for x in values):
        raise ValueError("a score is too large for a bigint")
    return [int(x) for x in values]


def dealt_anchors(rows: DataFrame, settings: MiningSettings, scan_anchors: int) -> tuple[DataFrame, int]:
    """(turn, anchor_id, label, cells of every anchor once; number of turns), evenly dealt.

    An id that repeats asks with its least row.
    """
    chosen = rows.filter(F.col("vec_id") % settings.anchors_every == 0).groupBy("vec_id")
    chosen = chosen.agg(F.min(F.struct("label", "cells")).alias("row"))
    chosen = materialize(chosen.select(F.col("vec_id").alias("anchor_id"), "row.*"), "anchors")
    widest, n = chosen.agg(F.max(F.size("cells")), F.count("*")).first()
    turns = -(-n // max(1, min(scan_anchors, SCAN_BYTES // (8 * (widest or 1) + 400))))
    turn = F.pmod(F.xxhash64("anchor_id"), F.lit(max(1, turns)))
    return chosen.withColumn("turn", turn), turns


def _scanned(shards: DataFrame, rows: list, search, schema: str) -> DataFrame:
    """One scan of all shards for the broadcast anchors ``rows``."""
    by_width: dict[int, list] = {}
    for r in rows:
        by_width.setdefault(len(r["cells"]), []).append(r)
    shared = shards.sparkSession.sparkContext.broadcast(by_width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, ids, labels, columns in zip(
                batch["dims"], batch["ids"], batch["labels"], batch["columns"], strict=True
            ):
                asked = shared.value.get(dims, [])
                shard = Shard(ids, labels, columns) if asked else None
                found = [row for r in asked for row in search(shard, r)]
                yield pd.DataFrame(found, columns=[c.split()[0] for c in schema.split(", ")])

    return shards.select("dims", "ids", "labels", "columns").mapInPandas(run, schema)


def _best(found: DataFrame, by: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), tie)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mined(
    rows: DataFrame,
    settings: MiningSettings = MiningSettings(),
    shard_rows: int = SHARD_ROWS,
    scan_anchors: int = SCAN_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows(vec_id, label, cells)`` as from ``usable``.  Rows that share an anchor's
    id are none of its other rows; apart from that each row of a repeated id counts.
    Vectors meet those of their own length only.  Candidates are never copied: a
    pass reads the shards where they lie, against a bounded number of anchors.
    """
    s = settings
    shards = sharded(rows, shard_rows)
    anchors, turns = dealt_anchors(rows, s, scan_anchors)

    def positives(shard: Shard, r) -> Iterator[tuple]:
        ids, scores = shard.positives(r["anchor_id"], r["label"], np.array(r["cells"], np.int64), s.positives)
        for vec, score in zip(ids, _score(scores), strict=True):
            yield r["anchor_id"], int(vec), score

    def negatives(shard: Shard, r) -> Iterator[tuple]:
        windows = [(-(-s.low * p["score"] // 100), s.high * p["score"] // 100) for p in r["positives"]]
        found = shard.negatives(r["label"], np.array(r["cells"], np.int64), windows, s.negatives)
        for p, (ids, scores) in zip(r["positives"], found, strict=True):
            for vec, score in zip(ids, _score(scores), strict=True):
                yield r["anchor_id"], p["place"], p["positive_id"], p["score"], int(vec), score

    results = []
    for turn in range(turns):
        here = anchors.filter(F.col("turn") == turn)
        schema = "anchor_id bigint, positive_id bigint, score bigint"
        best = _scanned(shards, here.collect(), positives, schema)
        best = _best(best, ["anchor_id"], "score", "positive_id", s.positives)
        each = F.struct(F.col("rank").alias("place"), "positive_id", "score")
        given = best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(each)).alias("positives"))
        given = here.join(given, "anchor_id").collect()
        schema = (
            "anchor_id bigint, place int, positive_id bigint, positive_score bigint, "
            "negative_id bigint, negative_score bigint"
        )
        found = _scanned(shards, given, negatives, schema)
        found = _best(found, ["anchor_id", "place"], "negative_score", "negative_id", s.negatives)
        results.append(materialize(found.drop("place"), "negatives"))
    if not results:
        shape = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return rows.sparkSession.createDataFrame([], shape)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return reduce(DataFrame.unionByName, results).select(*names)


def hard_negatives(embeddings: DataFrame, settings: MiningSettings = MiningSettings()) -> DataFrame:
    """Hard negatives for the rows whose vec_id is divisible by ``anchors_every``."""
    return mined(usable(embeddings, settings), settings)
