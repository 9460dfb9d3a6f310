"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is the words of the benchmark.  Patterns of one length share a
shift table over blocks of words, so a text position whose block occurs in no
pattern lets the search skip almost a whole window.  A block with shift 0 names a
bucket of patterns with that suffix, ordered by their prefixes, and direct
comparison confirms them.

Patterns are places in one array of word numbers, so a window costs a few numbers
and not a tuple of its words.  A benchmark of more windows than one table may hold
is searched in passes, each a job of its own: no worker holds two tables.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

# After A-Z are lower-cased: digits, a-z and everything outside ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

WINDOW = 10
#: Windows in the tables of one pass.
PASS_WINDOWS = 1 << 20
# Windows that stay together when a benchmark is dealt over passes.
CHUNK_WINDOWS = 1 << 12

STATE = "n_words bigint, n_hit bigint, hits array<int>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text; none for null."""
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def chunks_of(words: list[bytes], window: int = WINDOW, most: int = CHUNK_WINDOWS) -> Iterator[list[bytes]]:
    """Runs of words whose windows, together, are those of ``words``, each in one run."""
    for first in range(0, max(1, len(words) - window + 1) if words else 0, most):
        yield words[first : first + most + window - 1]


@dataclass
class _Length:
    """Wu-Manber tables of the distinct patterns of one length.

    ``shift`` maps a block (its words as one number) to the words that may be skipped,
    or to minus the number of the bucket that ends in it.  Bucket ``i`` is the patterns
    from ``bounds[i]`` to ``bounds[i + 1]``, in the order of their prefix blocks; pattern
    ``j`` starts at ``places[j]`` of the words and comes from the chunks
    ``owners[owner_bounds[j] : owner_bounds[j + 1]]``.
    """

    length: int
    block: int
    base: int
    shift: dict[int, int]
    bounds: np.ndarray
    prefixes: np.ndarray
    places: np.ndarray
    owners: np.ndarray
    owner_bounds: np.ndarray

    @classmethod
    def build(cls, flat: np.ndarray, starts: np.ndarray, chunks: np.ndarray, length: int, base: int) -> _Length:
        """Tables of the windows at ``starts``, of the chunks ``chunks``."""
        block = min(2, length)
        windows = np.lib.stride_tricks.sliding_window_view(flat, length)[starts]

        def blocks(end: int) -> np.ndarray:
            last = windows[:, end - 1].astype(np.int64)
            return windows[:, end - 2].astype(np.int64) * base + last if block == 2 else last

        # Equal windows become one pattern with several owners.
        order = np.lexsort((chunks, *windows.T[::-1], blocks(block), blocks(length)))
        windows, chunks, starts = windows[order], chunks[order], starts[order]
        new = np.ones(len(order), bool)
        new[1:] = (windows[1:] != windows[:-1]).any(axis=1)
        owned = new.copy()
        owned[1:] |= chunks[1:] != chunks[:-1]
        pattern = np.cumsum(new) - 1
        owner_bounds = np.searchsorted(pattern[owned], np.arange(pattern[-1] + 2)).astype(np.int32)
        owners = chunks[owned].astype(np.int32)
        windows, places = windows[new], starts[new].astype(np.int32)
        suffixes, prefixes = blocks(length), blocks(block)
        keys, bounds = np.unique(suffixes, return_index=True)
        shift = dict(zip(keys.tolist(), range(0, -len(keys), -1), strict=True))
        for step in range(1, length - block + 1):  # smaller shifts come first and stay
            for key in np.unique(blocks(length - step)).tolist():
                shift.setdefault(key, step)
        bounds = np.append(bounds, len(places)).astype(np.int32)
        return cls(length, block, base, shift, bounds, prefixes, places, owners, owner_bounds)

    def search(self, text: list[int], flat: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, pattern) of every occurrence in a text of word numbers, -1 for others."""
        length, two, base, shift = self.length, self.block == 2, self.base, self.shift
        skip = length - self.block + 1
        end, n = length, len(text)
        while end <= n:
            last = text[end - 1]
            if last < 0:  # no pattern has this word
                end += length
                continue
            step = shift.get(text[end - 2] * base + last if two else last, skip)
            if step > 0:
                end += step
                continue
            start = end - length
            prefix = text[start] * base + text[start + 1] if two else text[start]
            low, high = int(self.bounds[-step]), int(self.bounds[1 - step])
            window = text[start:end]
            for at in range(bisect_left(self.prefixes, prefix, low, high), high):
                if self.prefixes[at] != prefix:
                    break
                place = self.places[at]
                if flat[place : place + length].tolist() == window:
                    yield start, at
                    break  # patterns are distinct
            end += 1


class WuManber:
    """Tables for chunks of benchmark words, each with the ids of the items it is from."""

    def __init__(self, chunks: list[tuple[bytes, list[str]]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        self.items = [items for _, items in chunks]
        coded = [[self.ids.setdefault(w, len(self.ids)) for w in words.split(b" ")] for words, _ in chunks]
        sizes = np.array([len(c) for c in coded], np.int64)
        self.flat = np.fromiter((w for c in coded for w in c), np.int32, int(sizes.sum()))
        first = np.cumsum(sizes) - sizes
        lengths = np.minimum(sizes, window)
        self.tables = []
        for length in np.unique(lengths).tolist():
            mine = np.flatnonzero(lengths == length)
            held = sizes[mine] - length + 1
            owner = np.repeat(mine, held)
            inside = np.arange(int(held.sum())) - np.repeat(np.cumsum(held) - held, held)
            table = _Length.build(self.flat, first[owner] + inside, owner, length, len(self.ids))
            self.tables.append(table)

    def scan(self, words: list[bytes], hits: np.ndarray, found: set[str]) -> None:
        """Mark the words inside occurrences in ``hits``, add their items to ``found``."""
        get = self.ids.get
        text = [get(w, -1) for w in words]
        chunks: set[int] = set()
        for table in self.tables:
            for start, at in table.search(text, self.flat):
                hits[start : start + table.length] = True
                chunks.update(table.owners[table.owner_bounds[at] : table.owner_bounds[at + 1]].tolist())
        for chunk in chunks:
            found.update(self.items[chunk])


def _scanner(matcher):
    """UDF text -> its words, and those hit and the items found by the tables."""

    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = matcher.value
        for texts in batches:
            out = []
            for text in texts:
                words = words_of(text)
                hits = np.zeros(len(words), dtype=bool)
                found: set[str] = set()
                tables.scan(words, hits, found)
                places = np.flatnonzero(hits).astype(np.int32)
                out.append((len(words), len(places), places, sorted(found)))
            yield pd.DataFrame(out, columns=["n_words", "n_hit", "hits", "items"])

    return F.pandas_udf(scan, STATE)


def benchmark_chunks(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Written table (words, windows, items) of the distinct chunks of ``items(item, text)``.

    ``items`` are the ids of all items a chunk occurs in, null ids left out; texts that
    repeat, whole or from their start, share chunks and cost one table entry.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (item, b" ".join(words), max(1, len(words) - window + 1))
                for item, text in zip(batch["item"], batch["text"], strict=True)
                for words in chunks_of(words_of(text), window)
            ]
            yield pd.DataFrame(out, columns=["item", "words", "windows"])

    chunks = items.mapInPandas(cut, "item string, words binary, windows bigint")
    distinct = chunks.groupBy("words", "windows").agg(F.collect_set("item").alias("items"))
    return materialize(distinct, "benchmark-chunks")


def _passes(docs: DataFrame, benchmark: DataFrame, item_col, item_text_col, window, pass_windows) -> Iterator:
    """The scanner of each pass over the texts, at least one."""
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")
    )
    chunks = benchmark_chunks(items, window)
    held = chunks.agg(F.sum("windows")).first()[0] or 0
    # Chunks are dealt by hash, so passes are planned half full.
    n = 1 if held <= pass_windows else -(-2 * held // pass_windows)
    for number in range(n):
        part = chunks.filter(F.pmod(F.xxhash64("words"), F.lit(n)) == number)
        rows = [(bytes(r["words"]), r["items"]) for r in part.select("words", "items").collect()]
        yield _scanner(docs.sparkSession.sparkContext.broadcast(WuManber(rows, window)))  # about pass_windows


def with_overlap(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    pass_windows: int = PASS_WINDOWS,
    out: str = "overlap",
) -> DataFrame:
    """``docs`` with a column (n_words, n_hit, hits, items): what each text shares with
    the benchmark.

    ``hits`` are the places of the words hit, from 0 and rising; ``items`` the ids, as
    sorted strings, of the items with a window in the text.  Every row is judged by its
    own text, so repeated or null ids need no care.  Null and empty texts have no words
    and no hits; null and empty items match nothing; an item with a null id marks words
    but is not listed.  An empty benchmark leaves every text clean.

    Windows are counted first.  Up to ``pass_windows`` of them the column is a narrow
    expression over ``docs``: no shuffle, no join.  Beyond, ``docs`` are numbered and
    written, each pass reads them with tables of about half as many windows, and what it
    found is merged by number: one row per document and one more per pass that hit it.
    """
    scanners = _passes(docs, benchmark, item_col, item_text_col, window, pass_windows)
    scanner, more = next(scanners), next(scanners, None)
    if more is None:
        return docs.withColumn(out, scanner(F.col(text_col)))
    row, state = _free("__row", docs.columns), F.col("found")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    texts = numbered.select(row, F.col(text_col).alias("text"))
    parts = materialize(texts.select(row, scanner("text").alias("found")), "overlap")
    while more is not None:
        hit = texts.select(row, more("text").alias("found")).filter(state["n_hit"] > 0)
        parts, more = parts.unionByName(materialize(hit, "overlap")), next(scanners, None)
    merged = parts.groupBy(row).agg(
        F.max(state["n_words"]).alias("n_words"),
        _union(state["hits"]).alias("hits"),
        _union(state["items"]).alias("items"),
    )
    n_hit = F.size("hits").cast("bigint").alias("n_hit")
    found = merged.select(row, F.struct("n_words", n_hit, "hits", "items").alias(out))
    return numbered.drop(out).join(found, row).drop(row)


def _union(lists: Column) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(lists))))


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    text = options.get("text_col", "text")
    narrow = docs.select(F.col("doc_id"), F.col(text))
    found = with_overlap(narrow, benchmark, **{**options, "out": "found"})
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all columns, that share no window with the benchmark."""
    mark = _free("__overlap", docs.columns)
    marked = with_overlap(docs, benchmark, **{**options, "out": mark})
    return marked.filter(F.col(f"{mark}.n_hit") == 0).select(*docs.columns)
