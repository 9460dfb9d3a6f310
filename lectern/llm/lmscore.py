"""Language-model scores from a log-frequency Bloom filter.

The n-grams of the training texts are counted in Spark.  A count is quantised to a
level, the whole logarithm of it, and an n-gram of level q puts the q pairs
(n-gram, 1) to (n-gram, q) into a Bloom filter.  Asked for an n-gram, the filter is
probed for level 1, 2 and so on until a probe fails; the last level found stands for
the count.  It is never too low and seldom too high.  The filter is cut into parts by
hash, each built by one task, and broadcast to the workers, which score whole texts.

An n-gram's probability is its count, plus ``prior`` times the probability of the
n-gram without its first word, over the count of its history plus ``prior``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from math import log10

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

#: The word after the last one of a text, and before the first.  No word holds white space.
END = b"\n"
#: Levels an n-gram can have; counts of 2^40 and more share the last.
LEVELS = 41
#: Words and tokens a task keeps before it hands them on.
_HELD_WORDS = 400_000
_HELD_TOKENS = 1 << 21
#: Documents whose n-grams are looked up together.
_LOOKED_UP = 128
#: Bytes of the filter that pass through the driver at a time, or one part.
SHARED_BYTES = 16 << 20

#: A byte that UTF-8 does not use: the end among hashed words.
_END_BYTE = b"\xff"
#: Bytes hashed at a time, and the odd base of their powers.
_CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C55

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_ORDER_BITS = np.uint64(3)


@dataclass(frozen=True)
class ModelSettings:
    """``order`` is the longest n-gram, 4 at most.

    ``probes`` are the hash functions of level 1 and of all others: a wrong first
    level makes an unseen n-gram a seen one, so it gets more.  ``pass_bytes`` bounds
    what is broadcast at a time, ``part_tokens`` what a task builds a part from.
    Words that make up more than 1 in ``hot_share`` of all tokens are looked up in
    place; there are fewer than ``hot_share`` of them.
    """

    order: int = 2
    prior: float = 200.0
    probes: tuple[int, int] = (8, 6)
    pass_bytes: int = 128 << 20
    part_tokens: int = 1 << 22
    hot_share: int = 1 << 18
    folds: int = 5
    fold: int = 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD[0]
    x = (x ^ (x >> np.uint64(27))) * _ODD[1]
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, and the end."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    words.append(END)
    return words


class Grams:
    """64-bit names of the n-grams of texts.

    A word's hash is the sum over its bytes of a random number per byte times a
    power of its place in the word, taken as a difference of running sums.
    """

    def __init__(self, order: int):
        self.order = order
        powers = np.full(_CHUNK_BYTES, _BASE, np.uint64)
        powers[0] = 1
        inverse = np.full(_CHUNK_BYTES, pow(_BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.powers, self.inverse = np.cumprod(powers), np.cumprod(inverse)
        self.per_byte = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.end = self.words(_END_BYTE)[0]

    def words(self, data: bytes) -> np.ndarray:
        """Hash of every run of bytes other than ASCII white space."""
        raw = np.frombuffer(data, np.uint8)
        blank = np.concatenate([[True], (raw == 32) | ((raw >= 9) & (raw <= 13)), [True]])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = edges[::2], edges[1::2]
        out = np.zeros(len(starts), np.uint64)
        # A long buffer is summed in pieces; what one piece has of a word is added up.
        for low in range(0, len(raw), _CHUNK_BYTES):
            high = min(low + _CHUNK_BYTES, len(raw))
            i, j = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
            first, last = np.maximum(starts[i:j], low), np.minimum(ends[i:j], high)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(self.per_byte[raw[low:high]] * self.powers[: high - low])])
            piece = (sums[last - low] - sums[first - low]) * self.inverse[first - low]
            inside = first > starts[i:j]  # the rest of a word that began before
            if inside.any():
                behind = (first - starts[i:j])[inside]
                piece[inside] *= np.array([pow(_BASE, int(n), 1 << 64) for n in behind], np.uint64)
            out[i:j] += piece
        return _mixed(out ^ (ends - starts).astype(np.uint64) * _ODD[0])

    def of(self, texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """(names of the 1-, 2-, ... grams that end at every token, places in the text, lengths).

        The end of a text stands before its first word, too.  An n-gram that would
        begin before that has the name 0.  The low bits hold the order.
        """
        data = [t.encode("utf-8", "surrogatepass").lower() if isinstance(t, str) else b"" for t in texts]
        one = self.words(b"".join(d + b" " + _END_BYTE + b" " for d in data))
        ends = np.flatnonzero(one == self.end)
        lengths = np.diff(ends, prepend=-1)
        first = ends - lengths + 1
        place = np.arange(len(one)) - np.repeat(first, lengths)
        raw, names = one, [one & ~_ORDER_BITS]
        for k in range(2, self.order + 1):
            before = np.empty_like(raw)
            before[1:] = raw[:-1]
            before[first] = self.end  # used for k = 2 only
            raw = _mixed(before * _ODD[2] + one)
            name = (raw & ~_ORDER_BITS) | np.uint64(k - 1)
            names.append(np.where(place >= k - 2, name, np.uint64(0)))
        return names, place, lengths


def part_of(names: np.ndarray, parts: int) -> np.ndarray:
    """Part of every name: ranges of equal width, so it rises with the name."""
    return (((names >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, 2 for 2 and 3, 3 for 4 to 7 and so on."""
    return np.minimum(np.frexp(counts.astype(np.float64))[1], LEVELS - 1)


def _pair(names: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the pairs (name, level), from which all probes follow."""
    a = _mixed(names + np.uint64(level * int(_ODD[2]) % (1 << 64)))
    return a, (a * _ODD[0]) ^ (a >> np.uint64(29)) | np.uint64(1)


def _place(a: np.ndarray, b: np.ndarray, probe: int, bits) -> np.ndarray:
    """The bit, among ``bits`` (fewer than 2^32), that a probe looks at."""
    return (((a + np.uint64(probe) * b) >> np.uint64(32)) * bits) >> np.uint64(32)


def build_part(names: np.ndarray, counts: np.ndarray, probes: tuple[int, int]) -> tuple[bytes, int]:
    """(bits, number of bits) of a part that holds distinct n-grams with their counts.

    Half of the bits end up set, where a filter is smallest for its error.
    """
    levels = levels_of(counts)
    held = [int((levels >= j).sum()) for j in range(1, LEVELS)]
    wanted = held[0] * probes[0] + sum(held[1:]) * probes[1]
    bits = max(64, -(-int(wanted / np.log(2)) // 64) * 64)
    flags = np.zeros(bits, np.uint8)
    for j in range(1, LEVELS):
        a, b = _pair(names[levels >= j], j)
        for probe in range(probes[0] if j == 1 else probes[1]):
            flags[_place(a, b, probe, np.uint64(bits))] = 1
    return np.packbits(flags, bitorder="little").tobytes(), bits


@dataclass(frozen=True)
class Filter:
    """Consecutive parts of a filter, from part ``first`` on, of ``parts`` in all."""

    parts: int
    first: int
    bits: np.ndarray  # bits of each part held
    starts: np.ndarray  # byte where each part begins
    data: np.ndarray
    probes: tuple[int, int]

    def levels(self, names: np.ndarray) -> np.ndarray:
        """Level of every name; 0 where it is unseen, or belongs to a part not held."""
        out = np.zeros(len(names), np.uint8)
        part = part_of(names, self.parts) - self.first
        left = np.flatnonzero((part >= 0) & (part < len(self.bits)) & (names != 0))
        bits, starts = self.bits[part[left]], self.starts[part[left]]
        asked = names[left]
        for j in range(1, LEVELS):
            a, b = _pair(asked, j)
            hit = np.ones(len(left), bool)
            last = (self.probes[0] if j == 1 else self.probes[1]) - 1
            for probe in range(last + 1):
                at = _place(a, b, probe, bits)
                byte = self.data[starts + (at >> np.uint64(3)).astype(np.int64)]
                hit &= (byte >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
                # A name that failed a probe needs no more, where dropping such pays.
                if probe == last or 4 * np.count_nonzero(hit) < 3 * len(hit):
                    left, asked, bits, starts, a, b = (x[hit] for x in (left, asked, bits, starts, a, b))
                    hit = np.ones(len(left), bool)
            if not len(left):
                break
            out[left] = j
        return out


def levels_among(filters: Iterable[Filter], names: np.ndarray) -> np.ndarray:
    """Level of every one of the sorted ``names`` in filters that hold different parts."""
    out = np.zeros(len(names), np.uint8)
    for held in filters:
        part = part_of(names, held.parts)
        i, j = np.searchsorted(part, [held.first, held.first + len(held.bits)])
        out[i:j] = held.levels(names[i:j])
    return out


def spans(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """(first, last) of runs of the parts (part, bytes) of at most ``most`` bytes, or one part."""
    out: list[tuple[int, int]] = []
    room = 0
    for part, n in sizes:
        if not out or n > room:
            out.append((part, part))
            room = most
        out[-1] = (out[-1][0], part)
        room -= n
    return out


@dataclass(frozen=True)
class Counts:
    """What the training texts hold: a written table of words, and totals."""

    words: DataFrame  # word, n (in training texts), seen (in all texts)
    tokens: int
    types: int
    seen: int

    @property
    def denominator(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)


def count_words(docs: DataFrame) -> Counts:
    """Exact counts of every word of ``docs(text, held_out)``, the ends among them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every, learned = Counter(), Counter()

        def handed() -> pd.DataFrame:
            words = list(every)
            n, seen = [learned[w] for w in words], [every[w] for w in words]
            every.clear(), learned.clear()
            return pd.DataFrame({"word": pd.Series(words, dtype=object), "n": n, "seen": seen})

        for batch in batches:
            for text, held_out in zip(batch["text"], batch["held_out"], strict=True):
                words = words_of(text)
                every.update(words)
                if not held_out:
                    learned.update(words)
                if len(every) > _HELD_WORDS:
                    yield handed()
        if every:
            yield handed()

    found = docs.select("text", "held_out").mapInPandas(count, "word binary, n bigint, seen bigint")
    words = materialize(found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")), "lm-words")
    total = words.agg(F.sum("n"), F.count_if(F.col("n") > 0), F.sum("seen")).first()
    return Counts(words, *(int(x or 0) for x in total))


def build_filter(docs: DataFrame, counts: Counts, settings: ModelSettings) -> DataFrame:
    """part, data, bits, grams, total: the filter over the texts of ``docs`` not held out.

    ``grams`` and ``total`` hold the number of n-grams and the sum of their counts
    by order and level.  Tasks count their n-grams and send them to the parts in
    sorted runs; a part comes from ``part_tokens`` tokens or so, as names are
    spread evenly and a frequent n-gram is one entry per run.
    """
    s = settings
    parts = max(1, -(-counts.tokens * s.order // s.part_tokens))

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, held, size = Grams(s.order), [], 0

        def runs() -> Iterator[pd.DataFrame]:
            names, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            n, names = n[names != 0].astype(np.uint32), names[names != 0]
            part = part_of(names, parts)
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
            rows = [(int(part[i]), names[i:j].tobytes(), n[i:j].tobytes()) for i, j in zip(cuts, cuts[1:], strict=False)]
            for start in range(0, len(rows), 256):
                yield pd.DataFrame(rows[start : start + 256], columns=["part", "names", "counts"])

        for batch in batches:
            for start in range(0, len(batch), 64):
                names, _, lengths = grams.of(list(batch["text"][start : start + 64]))
                held += names
                size += int(lengths.sum())
                if size >= _HELD_TOKENS:
                    yield from runs()
                    size = 0
        if held:
            yield from runs()

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        names = np.frombuffer(b"".join(rows["names"]), np.uint64)
        n = np.frombuffer(b"".join(rows["counts"]), np.uint32)
        order = np.argsort(names, kind="stable")
        names, n = names[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        names, n = names[first], np.add.reduceat(n, first)
        data, bits = build_part(names, n, s.probes)
        cell = (names & _ORDER_BITS).astype(np.int64) * LEVELS + levels_of(n)
        grams = np.bincount(cell, minlength=4 * LEVELS).astype(np.int64)
        total = np.bincount(cell, weights=n, minlength=4 * LEVELS)
        return pd.DataFrame({"part": [key[0]], "data": [data], "bits": [bits], "grams": [grams], "total": [total]})

    learned = docs.filter(~F.col("held_out")).select("text")
    runs_ = learned.mapInPandas(name, "part bigint, names binary, counts binary")
    schema = "part bigint, data binary, bits bigint, grams array<bigint>, total array<double>"
    return materialize(runs_.groupBy("part").applyInPandas(build, schema), "lm-filter")


@dataclass(frozen=True)
class Model:
    counts: Counts
    filter: DataFrame
    parts: int
    sizes: list[tuple[int, int]]  # part, bytes
    values: np.ndarray  # the count a level stands for, by order and level
    settings: ModelSettings

    @property
    def passes(self) -> list[tuple[int, int]]:
        """First and last part of every pass."""
        return spans(self.sizes, self.settings.pass_bytes)

    def shared(self, first: int, last: int) -> list[Broadcast]:
        """The parts of one pass, ``pass_bytes`` or one part, broadcast.

        The driver holds no more of them at a time than ``SHARED_BYTES``.
        """
        context = self.filter.sparkSession.sparkContext
        here = [x for x in self.sizes if first <= x[0] <= last]
        return [context.broadcast(self._held(*span)) for span in spans(here, SHARED_BYTES)]

    def _held(self, first: int, last: int) -> Filter:
        rows = self.filter.filter(F.col("part").between(first, last)).select("part", "bits", "data").collect()
        by_part = {r["part"]: r for r in rows}
        found = [by_part.get(p) for p in range(first, last + 1)]  # a part without n-grams has no row
        data = [bytes(r["data"]) if r else b"\0" * 8 for r in found]
        starts = np.cumsum([0, *map(len, data)])[:-1].astype(np.int64)
        bits = np.array([r["bits"] if r else 64 for r in found], np.uint64)
        joined = np.frombuffer(b"".join(data) or b"\0", np.uint8)
        return Filter(self.parts, first, bits, starts, joined, self.settings.probes)


def fit(docs: DataFrame, settings: ModelSettings = ModelSettings()) -> Model:
    """Count the texts of ``docs(text, held_out)`` and build the filter from those not held out."""
    counts = count_words(docs)
    table = build_filter(docs, counts, settings)
    rows = table.select("part", F.octet_length("data").alias("n")).orderBy("part").collect()  # numbers only
    sizes = [(r["part"], r["n"]) for r in rows]
    cells = table.select(F.posexplode(F.arrays_zip("grams", "total"))).groupBy("pos")
    sums = cells.agg(F.sum("col.grams").alias("grams"), F.sum("col.total").alias("total"))
    values = np.zeros(4 * LEVELS)
    for row in sums.filter(F.col("grams") > 0).collect():  # orders times levels
        values[row["pos"]] = row["total"] / row["grams"]
    parts = max(1, -(-counts.tokens * settings.order // settings.part_tokens))
    return Model(counts, table, parts, sizes, values.reshape(4, LEVELS), settings)


def log_probabilities(
    levels: list[np.ndarray], place: np.ndarray, last: np.ndarray, values: np.ndarray, prior: float, counts: tuple
) -> np.ndarray:
    """log10 probability of every token from the levels of the n-grams that end there.

    ``last`` is, for every token, where the end of its text lies.  Counts that
    contradict those of shorter n-grams are lowered to them.
    """
    tokens, denominator = counts
    one = values[0][levels[0]]
    p = (one + 0.5) / denominator
    shorter = one
    for k in range(1, len(levels)):
        before = np.empty_like(shorter)
        before[1:] = shorter[:-1]
        if k == 1:  # the history of a text's first word is an end
            before[place == 0] = one[last[place == 0]]
        usable = place >= k - 1
        count = np.minimum(np.minimum(values[k][levels[k]], shorter), before)
        p = np.where(usable, (count + prior * p) / (before + prior), p)
        shorter = np.where(usable, count, 0)
    return np.log10(p)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Where the filter takes one pass, texts are read once.  In more passes the
    documents are numbered and written, each pass finds the levels of its part of
    the n-grams, and the levels of a text are merged.  Words too frequent to be
    shuffled are looked up in place, the others joined with their counts.
    """
    s, counts = model.settings, model.counts
    hot_rows = counts.words.filter(F.col("seen") * s.hot_share > counts.seen).collect()  # below hot_share rows
    hot = {bytes(r["word"]): (r["n"] > 0, log10((r["n"] + 0.5) / counts.denominator)) for r in hot_rows}
    context = docs.sparkSession.sparkContext
    shared_hot, values, totals = context.broadcast(hot), model.values, (counts.tokens, counts.denominator)
    passes = model.passes
    single = len(passes) <= 1
    numbered = docs.select("doc_id", "held_out", "text").withColumn("_row", F.monotonically_increasing_id())
    if not single:
        numbered = materialize(numbered, "lm-documents")

    def found(batch: pd.DataFrame, grams: Grams, held: list[Filter]) -> Iterator[tuple]:
        """(documents of a slice, levels by order, places, lengths)."""
        for start in range(0, len(batch), _LOOKED_UP):
            rows = batch.iloc[start : start + _LOOKED_UP]
            names, place, lengths = grams.of(list(rows["text"]))
            unique, back = np.unique(np.concatenate(names), return_inverse=True)
            yield rows, levels_among(held, unique)[back].reshape(s.order, -1), place, lengths

    def summed(levels, place: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        last = np.repeat(np.cumsum(lengths) - 1, lengths)
        logs = log_probabilities(list(levels), place, last, values, s.prior, totals)
        return np.add.reduceat(logs, np.cumsum(lengths) - lengths)

    def based(words: list[bytes]) -> tuple:
        known, base, rest, times = 0, 0.0, [], []
        for w, n in Counter(words).items():
            at = shared_hot.value.get(w)
            if at is None:
                rest.append(w)
                times.append(n)
            else:
                known += n * at[0]
                base += n * at[1]
        return len(words), known, base, rest, times

    def first_pass(shared: list[Broadcast], with_score: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grams, held = Grams(s.order), [x.value for x in shared]
            for batch in batches:
                for rows, levels, place, lengths in found(batch, grams, held):
                    out = pd.DataFrame({"_row": rows["_row"].to_numpy(), "held_out": rows["held_out"].to_numpy()})
                    out["doc_id"] = rows["doc_id"].to_numpy()
                    base = [based(words_of(t)) for t in rows["text"]]
                    for k, name in enumerate(("n_tokens", "known", "base", "rest", "times")):
                        out[name] = pd.Series([b[k] for b in base], dtype=object if k > 2 else None)
                    out["score"] = summed(levels, place, lengths) if with_score else None
                    yield out

        return run

    def later_pass(shared: list[Broadcast]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            grams, held = Grams(s.order), [x.value for x in shared]
            for batch in batches:
                for rows, levels, _, lengths in found(batch, grams, held):
                    cut = np.cumsum(lengths)[:-1]
                    packed = [x.tobytes() for x in np.split(levels, cut, axis=1)]
                    yield pd.DataFrame({"_row": rows["_row"].to_numpy(), "levels": packed})

        return run

    def passed(rows: DataFrame, one_pass, part: tuple[int, int] | None, schema: str, name: str, *args) -> DataFrame:
        """The written result of one pass, whose parts of the filter are dropped after it."""
        shared = model.shared(*part) if part else []
        try:
            return materialize(rows.mapInPandas(one_pass(shared, *args), schema), name)
        finally:
            for x in shared:
                x.destroy()

    # Ids pass as text: a column with nulls would become floating-point numbers.
    numbered = numbered.withColumn("doc_id", F.col("doc_id").cast("string"))
    schema = (
        "_row bigint, held_out boolean, doc_id string, n_tokens bigint, known bigint, base double, "
        "rest array<binary>, times array<int>, score double"
    )
    whole = passes[0] if single and passes else None
    scored = passed(numbered, first_pass, whole, schema, "lm-scored", single)
    if not single:
        texts = numbered.select("_row", "text")
        parts = [passed(texts, later_pass, p, "_row bigint, levels binary", "lm-levels") for p in passes]

        def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for every in batch["every"]:
                    levels = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in every]).reshape(s.order, -1)
                    n = levels.shape[1]
                    out.append(summed(levels, np.arange(n), np.array([n]))[0])
                yield pd.DataFrame({"_row": batch["_row"], "score": out})

        every = reduce(DataFrame.unionByName, parts).groupBy("_row").agg(F.collect_list("levels").alias("every"))
        scored = scored.drop("score").join(every.mapInPandas(merged, "_row bigint, score double"), "_row")

    rest = scored.select("_row", F.inline(F.arrays_zip(F.col("rest").alias("word"), F.col("times").alias("times"))))
    part = F.col("times") * F.log10((F.col("n") + 0.5) / F.lit(counts.denominator))
    joined = rest.join(counts.words.select("word", "n"), "word").groupBy("_row").agg(
        F.sum(part).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known")
    )
    zero = F.lit(0)
    return scored.drop("rest", "times").join(joined, "_row", "left").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(counts.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", zero)).alias("base_score"),
        "score",
    )


def score_documents(docs: DataFrame, settings: ModelSettings = ModelSettings()) -> DataFrame:
    """Scores every row of ``docs(doc_id, text)``, learning from those outside the held-out fold.

    A null text is empty and has its end only.  A null id is never held out.  Rows
    that repeat an id are scored each by its own text; without training rows every
    token has the same probability.  Further columns are ignored.
    """
    remainder = F.crc32(F.col("doc_id").cast("string")) % settings.folds
    held_out = F.coalesce(remainder == settings.fold, F.lit(False))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return score(rows, fit(rows, settings))
