"""Edit-aware token counts.

A document's tree has leaves of consecutive pre-tokens, each with its token count,
and sums above them.  An edit re-encodes only the leaves that hold the edited
characters and the characters next to them, and adds the difference on the way to
the root.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm import pii
from lectern.llm.packing import ChunkEncoder, _encoder
from lectern.plans.storage import materialize

#: Pre-tokens, parted by ASCII white space, in a leaf.
LEAF = 32
_PRETOKEN = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass
class CountTree:
    """``starts``: first character of every leaf; ``sums``: a heap, the root at 1."""

    starts: list[int]
    sums: list[int]

    @staticmethod
    def build(text: str, encoder: ChunkEncoder, leaf: int = LEAF) -> CountTree:
        tokens = _PRETOKEN.finditer(text)
        places = [(m.start(), m[0].encode("utf-8", "surrogatepass")) for m in tokens]
        counts = encoder.counts([c for _, c in places])
        starts = [0, *(places[i][0] for i in range(leaf, len(places), leaf))]
        leaves = [sum(counts[i : i + leaf]) for i in range(0, len(places), leaf)] or [0]
        width = 1 << (len(leaves) - 1).bit_length()
        sums = [0] * width + leaves + [0] * (width - len(leaves))
        for i in range(width - 1, 0, -1):
            sums[i] = sums[2 * i] + sums[2 * i + 1]
        return CountTree(starts, sums)

    @property
    def total(self) -> int:
        return self.sums[1]

    def _leaf(self, place: int) -> int:
        return max(0, bisect_right(self.starts, place) - 1)

    def _add(self, leaf: int, change: int) -> None:
        node = len(self.sums) // 2 + leaf
        while node:
            self.sums[node] += change
            node //= 2

    def edit(self, text: str, edits: list[tuple[int, int, str]], encoder: ChunkEncoder) -> tuple[str, int]:
        """Apply (start, end, replacement), sorted and apart; (new text, pre-tokens re-encoded).

        Leaves are parted by white space, so text next to an edit can only change
        with the leaf of the character before it or behind it.
        """
        regions: list[list] = []  # first leaf, last leaf, its edits
        for start, end, new in edits:
            first, last = self._leaf(max(0, start - 1)), self._leaf(end)
            if regions and first <= regions[-1][1]:
                regions[-1][1] = max(regions[-1][1], last)
                regions[-1][2].append((start, end, new))
            else:
                regions.append([first, last, [(start, end, new)]])
        out, at, work, moves = [], 0, 0, []
        width = len(self.sums) // 2
        for first, last, own in regions:
            begin = self.starts[first]
            stop = self.starts[last + 1] if last + 1 < len(self.starts) else len(text)
            parts, here = [], begin
            for start, end, new in own:
                parts += [text[here:start], new]
                here = end
            changed = "".join([*parts, text[here:stop]])
            chunks = [x.encode("utf-8", "surrogatepass") for x in _PRETOKEN.findall(changed)]
            work += len(chunks)
            before = [self.sums[width + leaf] for leaf in range(first, last + 1)]
            self._add(first, sum(encoder.counts(chunks)) - before[0])
            for leaf, n in zip(range(first + 1, last + 1), before[1:], strict=True):
                self._add(leaf, -n)
            out += [text[at:begin], changed]
            at = stop
            moves.append((first, last, len(changed) - (stop - begin)))
        out.append(text[at:])
        shift, starts = 0, list(self.starts)
        bounds = [*moves, (len(starts), len(starts), 0)]
        for i, (first, last, change) in enumerate(bounds[:-1]):
            starts[first] = self.starts[first] + shift
            shift += change
            behind = self.starts[last + 1] if last + 1 < len(self.starts) else len(text)
            for leaf in range(first + 1, last + 1):  # merged into the first
                starts[leaf] = behind + shift
            for leaf in range(last + 1, bounds[i + 1][0]):
                starts[leaf] = self.starts[leaf] + shift
        self.starts = starts
        return "".join(out), work


TREE = "doc_id string, version bigint, n_tokens bigint, starts array<int>, sums array<bigint>"


def build_trees(docs: DataFrame, tokenizer: str, leaf: int = LEAF) -> DataFrame:
    """A tree per document, with a hash of the text it belongs to.  Null texts count as empty."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            trees = [CountTree.build(t or "", encoder, leaf) for t in batch["text"]]
            columns = {"n_tokens": [t.total for t in trees], "starts": [t.starts for t in trees], "sums": [t.sums for t in trees]}
            yield batch[["doc_id", "version"]].assign(**columns)

    # Ids pass as text: a column with nulls would become floating-point numbers.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
    return rows.mapInPandas(build, TREE).withColumn("doc_id", F.col("doc_id").cast("bigint"))


def apply_edits(trees: DataFrame, edited: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, version, n_edits, n_tokens_edited, n_reencoded of ``edited(doc_id, text, edits)``.

    ``edits``: array of (start, end, new), in code points of the text, sorted and
    not overlapping.  Trees are found by id and text hash.
    """

    def update(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            out = []
            for doc_id, version, text, edits, starts, sums in zip(
                *(batch[c] for c in ("doc_id", "version", "text", "edits", "starts", "sums")), strict=True
            ):
                tree = CountTree(np.asarray(starts).tolist(), np.asarray(sums).tolist())
                changes = [(e["start"], e["end"], e["new"]) for e in edits]
                _, work = tree.edit(text or "", changes, encoder)
                out.append((doc_id, version, len(changes), tree.total, work))
            names = ["doc_id", "version", "n_edits", "n_tokens_edited", "n_reencoded"]
            yield pd.DataFrame(out, columns=names)

    rows = edited.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("version"), "text", "edits")
    rows = rows.dropDuplicates(["doc_id", "version"]).alias("e")
    kept = trees.dropDuplicates(["doc_id", "version"]).alias("t")
    same = F.col("e.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("e.version") == F.col("t.version"))
    both = rows.join(kept, same).select("e.*", "t.starts", "t.sums")
    both = both.withColumn("doc_id", F.col("doc_id").cast("string"))
    changed = both.mapInPandas(
        update, "doc_id string, version bigint, n_edits bigint, n_tokens_edited bigint, n_reencoded bigint"
    )
    return changed.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def personal_edits(text_col: str = "text") -> Column:
    """Edits that replace the base kinds of personal data; overlapping spans are one edit."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def labelled(kind: str) -> Column:
        new = F.lit(f"<{kind.upper()}>").alias("new")
        return F.transform(pii.proposed(text, kind), lambda s: F.struct(s["start"], s["end"], new))

    spans = F.array_sort(F.concat(*map(labelled, pii.BASE)))

    def merge(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["new"].alias("new"))
        overlaps = (F.size(done) > 0) & (s["start"] < last["end"])
        return F.when(overlaps, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(s))
        )

    none = F.array().cast("array<struct<start:int,end:int,new:string>>")
    return F.aggregate(spans, none, merge)


def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_edited, n_reencoded of every document.

    Trees of all documents are built and kept, then the personal data in the texts
    is edited away and the counts follow.  Repeated rows have a row each.
    """
    trees = materialize(build_trees(docs, tokenizer), "trees")
    edited = docs.select("doc_id", "text", personal_edits().alias("edits")).filter(F.size("edits") > 0)
    changed = apply_edits(trees, edited, tokenizer).alias("c")
    same = F.col("t.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("t.version") == F.col("c.version"))
    rows = trees.select("doc_id", "version", "n_tokens").alias("t").join(changed, same, "left")
    zero = F.lit(0).cast("bigint")
    return rows.select(
        "t.doc_id",
        "n_tokens",
        F.coalesce("n_edits", zero).alias("n_edits"),
        F.coalesce("n_tokens_edited", "n_tokens").alias("n_tokens_edited"),
        F.coalesce("n_reencoded", zero).alias("n_reencoded"),
    )
