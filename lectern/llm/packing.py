"""Best-fit packing of token sequences, bulk-synchronous.

Documents become pieces of at most ``capacity`` tokens.  Pieces are taken by
falling length, all pieces of one length in a superstep: each goes to the smallest
gap that holds it, its successor among the sorted gaps, and what is left of the
gaps is sorted in again for the next superstep.  Where many pieces want the same
gaps, their rank within the length decides.

Lengths and gaps are integers up to the capacity, so sorted pieces are runs of
equal length and sorted gaps runs of equal size: a superstep only moves run
counts.  The ranks are taken by Spark, over a fixed number of splits per length,
and each piece finds its sequence by its rank alone.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

CAPACITY = 2048
#: Largest capacity whose runs the driver may hold.
MAX_CAPACITY = 1 << 16
#: Pieces of one length that are ranked in one task, about.
RANKED_TOGETHER = 200_000
#: Chunks of text, and words, whose ids a worker remembers.
_REMEMBERED = 1_200_000
#: Words encoded as one text.
_TOGETHER = 200
#: Letters below this code point are lower-cased one by one.
_PLAIN_END = "\u0130"

PIECES = "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = ("piece", "start", "length", "ids_crc32")


def _plain(word: str) -> bool:
    return word.isalpha() and (word.isascii() or max(word) < _PLAIN_END)


def _lowered(text: str) -> bytes:
    """UTF-8, in lower case if that is the same for each character alone."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.encode("utf-8", "surrogatepass")
    # Special tokens are spelled as they are.
    return (text if "<|" in text else text.lower()).encode("utf-8")


class ChunkEncoder:
    """Token ids of whole texts, remembering the ids of chunks.

    The tokenizer must never join text across ASCII white space; every chunk
    between such white space then has ids of its own.  It must also lower-case
    plain letters and part them from a full stop or comma behind them, so chunks
    of that form share what is remembered for their word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.chunks: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.word_ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.word_ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    @staticmethod
    def _parts(chunk: bytes) -> tuple[str, str]:
        text = chunk.decode("utf-8", "replace")
        body, tail = (text[:-1], text[-1]) if text[-1] in ".," else (text, "")
        return (body.lower(), tail) if _plain(body) else (text, "")

    def _encode_parts(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of each part; plain words are encoded together and cut at word ends."""
        words, rest = [], []
        for part in parts:
            (words if _plain(part) else rest).append(part)
        runs = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        joined = self.tokenizer.encode_batch_fast([" ".join(x) for x in runs], add_special_tokens=False)
        for run, encoded in zip(runs, joined, strict=True):
            ids = np.array(encoded.ids, "<u4")
            ends = np.flatnonzero(self.word_ends[ids]) + 1
            if len(ends) != len(run):  # the tokenizer parts some of these words
                rest += run
                continue
            raw, cuts = ids.tobytes(), [0, *(ends * 4).tolist()]
            yield from zip(run, (raw[x:y] for x, y in zip(cuts, cuts[1:], strict=False)), strict=True)
        single = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        yield from zip(rest, (np.array(e.ids, "<u4").tobytes() for e in single), strict=True)

    def _learn(self, chunks: set[bytes]) -> None:
        parts = [(c, self._parts(c)) for c in chunks]
        self.parts.update(self._encode_parts(list({x for _, pair in parts for x in pair if x not in self.parts})))
        self.chunks.update((c, self.parts[body] + self.parts[tail]) for c, (body, tail) in parts)

    def _forget(self) -> None:
        if len(self.chunks) > _REMEMBERED or len(self.parts) > _REMEMBERED:
            self.chunks.clear()
            self.parts.clear()

    def counts(self, chunks: list[bytes]) -> list[int]:
        """Tokens of each chunk."""
        self._forget()
        known = self.chunks
        self._learn({c for c in chunks if c not in known})
        return [len(known[c]) // 4 for c in chunks]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        self._forget()
        split = [_lowered(t).split() if t else [] for t in texts]
        known = self.chunks
        ids = [list(map(known.get, chunks)) for chunks in split]
        gaps = [(i, j) for i, got in enumerate(ids) if None in got for j, x in enumerate(got) if x is None]
        self._learn({split[i][j] for i, j in gaps})
        for i, j in gaps:
            ids[i][j] = known[split[i][j]]
        return [np.frombuffer(b"".join(got), "<u4") for got in ids]


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids, then ``end_id``, cut.

    A null or empty text has the end id alone.  Repeated rows are documents of
    their own.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer)
        end = np.array([end_id], "<u4")
        for batch in batches:
            ids_of, out = list(batch["doc_id"]), []
            for first in range(0, len(batch), 64):
                texts = list(batch["text"][first : first + 64])
                for doc_id, ids in zip(ids_of[first : first + 64], encoder.encode(texts), strict=True):
                    ids = np.concatenate([ids, end])
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        out.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    # Ids pass as text: a column with nulls would become floating-point numbers.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(cut, PIECES)
    return rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))


@dataclass
class Plan:
    """Where the ranks of each length go, as runs.

    ``runs[length]`` has (first rank, first sequence, pieces per sequence, offset).
    """

    capacity: int
    runs: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    sequences: int = 0


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Supersteps over the lengths, largest first.

    Gaps are runs (size, first sequence, number of sequences), kept sorted.
    """
    plan = Plan(capacity)
    gaps: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left, rank, runs = counts[length], 0, []
        changed: list[tuple[int, int, int]] = []
        at = bisect_right(gaps, (length, -1, -1))  # the successor: smallest gap that fits
        while left and at < len(gaps):
            size, first, number = gaps[at]
            each = size // length  # a gap stays the best fit while the length fits
            whole = min(number, left // each)
            if whole:
                runs.append((rank, first, each, capacity - size))
                changed.append((size - each * length, first, whole))
                rank, left = rank + whole * each, left - whole * each
            if whole < number:
                rest = [(size, first + whole, number - whole)]
                if left:  # fewer than ``each``: the last sequence of this superstep
                    runs.append((rank, first + whole, left, capacity - size))
                    changed.append((size - left * length, first + whole, 1))
                    rest, left = [(size, first + whole + 1, number - whole - 1)], 0
                gaps[at] = rest[0]
                if not gaps[at][2]:
                    del gaps[at]
            else:
                del gaps[at]
        if left:
            each, first = capacity // length, plan.sequences
            whole, rest = divmod(left, each)
            if whole:
                runs.append((rank, first, each, 0))
                changed.append((capacity - each * length, first, whole))
            if rest:
                runs.append((rank + whole * each, first + whole, rest, 0))
                changed.append((capacity - rest * length, first + whole, 1))
            plan.sequences += whole + (rest > 0)
        for gap in changed:
            if gap[0]:
                insort(gaps, gap)
        plan.runs[length] = runs
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    ``pieces`` must be a written table: it is read once for the counts and once
    for the ranks.  Only the counts per length, ``capacity`` of them at most,
    reach the driver.
    """
    if capacity > MAX_CAPACITY:
        raise ValueError(f"capacity above {MAX_CAPACITY}")
    total = pieces.count()
    splits = max(16, -(-total // RANKED_TOGETHER))
    split = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(splits)).cast("int")
    marked = pieces.withColumn("split", split)
    counted = marked.groupBy("length", "split").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    shares = counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    lengths = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = best_fit({r["length"]: r["n"] for r in lengths}, capacity)

    order = Window.partitionBy("length", "split").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        marked.withColumn("within", F.row_number().over(order) - 1)
        .join(shares.select("length", "split", "before"), ["length", "split"])
        .withColumn("rank", F.col("before") + F.col("within"))
        .select(F.col("doc_id").cast("string"), *PLACED, "rank")
    )
    shared = pieces.sparkSession.sparkContext.broadcast(
        {length: np.array(runs, dtype=np.int64) for length, runs in plan.runs.items()}
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length in np.unique(lengths):
                rows, runs = np.flatnonzero(lengths == length), shared.value[length]
                rank = ranks[rows]
                run = runs[np.searchsorted(runs[:, 0], rank, side="right") - 1]
                nth = rank - run[:, 0]
                sequence[rows] = run[:, 1] + nth // run[:, 2]
                offset[rows] = run[:, 3] + nth % run[:, 2] * length
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    placed = ranked.mapInPandas(place, f"{PIECES}, sequence_id bigint, offset bigint")
    return placed.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """Tokenise, cut and pack all documents: one row per piece."""
    pieces = materialize(cut_pieces(docs, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, capacity)
