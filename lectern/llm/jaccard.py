"""N-gram Jaccard join: links between texts with similar shingle sets.

Sets are compared only inside tiles.  Sizes are cut into bands; a set joins its
own band and, if it can still link with a larger set there, the next.  Of two
linked sets of a band at most ``differ`` shingles belong to one set alone.  Shingles
are dealt into more segments than that, so linked sets agree on whole segments: a
tile holds the sets of a band with the same shingles in one segment.

Inside a tile, the bit counts of hashed bitmaps bound the overlap of two sets from
above; pairs that pass are decided by intersecting their sorted shingles.  First
all sets of a tile are compared with its most central one.  Only tiles that still
hold sets of different components are then compared in full, block by block, and
only across components, so a large group of near copies costs a row per set and
tile, not one per pair.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.plans.storage import materialize

#: Sets of a tile that are compared with each other in one group.
BLOCK_SETS = 2048
#: Ids that may be broadcast, 8 bytes each, to pick the texts of candidates.
BROADCAST_IDS = 1_000_000
#: An end of more pairs than both this number and this share of all is split, so
#: at most 2 / HOT_SHARE ends are.
HOT_PAIRS = 1000
HOT_SHARE = 1e-4
_REMEMBERED = 200_000
#: Rows a task hands on at a time.
_SLICE = 1000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class JoinSettings:
    """Two sets link when ``of * overlap >= least * union``."""

    words: int = 4
    least: int = 85
    of: int = 100
    band_ratio: float = 1.5

    @cached_property
    def edges(self) -> list[int]:
        """Smallest size of every band."""
        out = [1]
        while out[-1] < 1 << 40:
            out.append(max(out[-1] + 1, int(out[-1] * self.band_ratio)))
        return out

    def bands(self, size: int) -> list[int]:
        own = bisect_right(self.edges, size) - 1
        out = [own]
        while self.of * size >= self.least * self.edges[out[-1] + 1]:
            out.append(out[-1] + 1)
        return out

    def segments(self, band: int) -> tuple[int, int]:
        """(segments, empty ones a set may have without naming them).

        Linked sets agree on all but ``differ`` segments, hence on more than
        ``spare``.  If one has at most ``spare`` empty segments, one that they
        agree on is not empty; else both have more, and both name them.
        """
        both = 2 * (self.edges[band + 1] - 1)
        differ = both * (self.of - self.least) // (self.of + self.least)
        spare = 4 + differ // 32 if differ else 0
        return differ + 1 + spare, spare

    def linked(self, overlap, total):
        """``total`` is the sum of the two sizes."""
        return self.of * overlap >= self.least * (total - overlap)


class Shingler:
    """Shingle sets of texts as sorted 64-bit numbers, remembering the hashes of words."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        hashed = np.array([known[w] for w in words], np.uint64)
        n = min(self.words, len(words))
        out = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            out = _mixed(out * _ODD[2] + hashed[k : len(words) - n + 1 + k])
        return np.unique(out)


def bitmap(shingles: np.ndarray) -> bytes:
    """Parities of the shingles by hash; as many bits as shingles, at least 64, a power of two."""
    bits = 1 << max(6, (len(shingles) - 1).bit_length())
    parity = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, nbytes: int) -> np.ndarray:
    """The bitmap as it would be with fewer bits."""
    x = np.frombuffer(bits, np.uint64)
    while x.nbytes > nbytes:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def tile_keys(shingles: np.ndarray, settings: JoinSettings) -> np.ndarray:
    keys = []
    for band in settings.bands(len(shingles)):
        segments, spare = settings.segments(band)
        place = ((shingles >> np.uint64(20)) % np.uint64(segments)).astype(np.int64)
        counts = np.bincount(place, minlength=segments)
        sums = np.zeros(segments, np.uint64)
        np.add.at(sums, place, _mixed(shingles))
        name = _mixed(np.arange(segments, dtype=np.uint64) * _ODD[3] + np.uint64(band))
        key = _mixed(sums + name * _ODD[2])
        keys.append(key if (counts == 0).sum() > spare else key[counts > 0])
    return np.concatenate(keys)


def signatures(docs: DataFrame, settings: JoinSettings) -> DataFrame:
    """doc_id, text_name, size, set_id, bits, keys of every document; set_id is null without words.

    A task gives the bits and keys of a set once, at a row with an id, so copies of
    a text add no rows to its tiles.
    """

    def framed(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["doc_id", "text_name", "size", "set_id", "bits", "keys"], dtype=object)
        return frame.astype({"text_name": "int64", "size": "int64", "set_id": "Int64"})

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, given = Shingler(settings.words), set()
        for batch in batches:
            out = []
            if len(given) > _REMEMBERED:
                given.clear()
            for doc_id, text_name, text in zip(batch["doc_id"], batch["text_name"], batch["text"], strict=True):
                s = shingler.shingles(text)
                if len(s):
                    name = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)
                    bits = keys = None
                    if not (pd.isna(doc_id) or name in given):
                        bits, keys = bitmap(s), tile_keys(s, settings).astype(np.int64)
                        given.add(name)
                    out.append((doc_id, text_name, len(s), name, bits, keys))
                else:
                    out.append((doc_id, text_name, 0, None, None, None))
                if len(out) == _SLICE:
                    yield framed(out)
                    out.clear()
            yield framed(out)

    # Ids pass as text: a column with nulls would become floating-point numbers.
    schema = "doc_id string, text_name bigint, size bigint, set_id bigint, bits binary, keys array<bigint>"
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), _text_name("text").alias("text_name"), "text")
    found = named.mapInPandas(sign, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def shared_tiles(signed: DataFrame) -> DataFrame:
    """key, set_id of the tiles with more than one set.

    Keys are shuffled once, for finding the shared ones and for picking their rows.
    """
    keys = signed.select(F.explode("keys").alias("key"), "set_id").repartition("key")
    shared = (
        keys.groupBy("key")
        .agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"))
        .filter(F.col("low") != F.col("high"))
        .select("key")
    )
    return keys.join(shared, "key").distinct()


def by_tile(tiles: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """``tiles(key, set_id)`` with the columns of the written table ``groups(key, n, ...)``.

    The tiles of more than ``least`` sets are broadcast; their number is bounded by
    ``HOT_SHARE``.  Only the rows of the others are shuffled.
    """
    hot = groups.filter(F.col("n") > least)
    dealt = tiles.join(F.broadcast(hot), "key", "left")
    rest = dealt.filter(F.col("n").isNull()).select(*tiles.columns)
    rest = rest.join(groups.filter(F.col("n") <= least), "key")
    return dealt.filter(F.col("n").isNotNull()).unionByName(rest)


def with_leaders(tiles: DataFrame) -> DataFrame:
    """The tiles with their number of sets and their leader.

    The leader shares most tiles with others: in a group of near copies, one with
    few changes of its own.
    """
    least = max(HOT_PAIRS, int(HOT_SHARE * tiles.count()))
    sizes = materialize(tiles.groupBy("key").agg(F.count("*").alias("n")), "tile-sizes")
    sized = by_tile(tiles, sizes, least)
    central = sized.groupBy("set_id").agg(F.sum("n").alias("central"))
    top = F.max(F.struct("central", "set_id")).alias("top")
    leaders = sized.join(central, "set_id").groupBy("key").agg(F.max("n").alias("n"), top)
    leaders = leaders.select("key", "n", F.col("top.set_id").alias("leader"))
    return by_tile(tiles, materialize(leaders, "leaders"), least)


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def joined_ends(pairs: DataFrame, rows: DataFrame, on: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with the columns of ``rows(set_id, ...)`` of both ends, as ``*_a`` and ``*_b``.

    ``on`` holds set_id and splits of the ends of very many pairs, from
    ``hot_ends``: their pairs are dealt over so many groups, each with a copy of
    the row.
    """
    for end in ("a", "b"):
        side = rows.join(F.broadcast(on), "set_id", "left")
        side = side.withColumn("split", F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1)))
        side = side.select("split", *(F.col(c).alias(end if c == "set_id" else f"{c}_{end}") for c in rows.columns))
        named = F.broadcast(on.select(F.col("set_id").alias(end), "splits"))
        split = F.pmod(F.xxhash64("a", "b"), F.coalesce("splits", F.lit(1))).cast("int")
        dealt = pairs.join(named, end, "left").withColumn("split", split).drop("splits")
        pairs = dealt.join(side, [end, "split"]).drop("split")
    return pairs


def hot_ends(pairs: DataFrame) -> DataFrame:
    """set_id, splits of the ends that hold very many of ``pairs(a, b)``, a written table.

    Their number is bounded by ``HOT_SHARE``, whatever the number of pairs.
    """
    least = max(HOT_PAIRS, int(HOT_SHARE * pairs.count()))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).groupBy("set_id").agg(F.count("*").alias("n"))
    hot = ends.filter(F.col("n") > least)
    return materialize(hot.select("set_id", F.ceil(F.col("n") / least).cast("int").alias("splits")), "hot-ends")


def verified(pairs: DataFrame, signed: DataFrame, docs: DataFrame, settings: JoinSettings) -> DataFrame:
    """The pairs (a, b) of set ids that link."""
    pairs = materialize(pairs, "pairs")
    sets = signed.select("set_id", "size", "bits").filter(F.col("bits").isNotNull()).dropDuplicates(["set_id"])
    both = joined_ends(pairs, sets, hot_ends(pairs))

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total = (batch["size_a"] + batch["size_b"]).to_numpy()
            apart = np.zeros(len(batch), np.int64)
            for i, (x, y) in enumerate(zip(batch["bits_a"], batch["bits_b"], strict=True)):
                nbytes = min(len(x), len(y))
                apart[i] = np.bitwise_count(folded(x, nbytes) ^ folded(y, nbytes)).sum()
            yield batch[["a", "b"]][settings.linked((total - apart) // 2, total)]

    possible = both.select("a", "b", "size_a", "size_b", "bits_a", "bits_b").mapInPandas(bounded, "a bigint, b bigint")
    possible = materialize(possible, "possible")
    named = possible.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    owners = signed.filter(F.col("doc_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    wanted = materialize(owners.join(named, "set_id", "left_semi").select("doc_id").distinct(), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(settings.words)
        for batch in batches:
            found = [s for s in map(shingler.shingles, batch["text"]) if len(s)]
            names = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in found]
            arrays = pd.Series([s.view(np.int64) for s in found], dtype=object)  # none of blank texts
            yield pd.DataFrame({"set_id": pd.Series(names, dtype="int64"), "shingles": arrays})

    arrays = texts.mapInPandas(sets_of, "set_id bigint, shingles array<bigint>")
    arrays = materialize(arrays.join(named, "set_id", "left_semi").dropDuplicates(["set_id"]), "arrays")

    def overlapping(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["shingles_a"], batch["shingles_b"], strict=True):
                x, y = np.asarray(x).view(np.uint64), np.asarray(y).view(np.uint64)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                keep.append(bool(settings.linked(int((y[at] == x).sum()), len(x) + len(y))))
            yield batch[["a", "b"]][keep]

    exact = joined_ends(possible, arrays, hot_ends(possible)).select("a", "b", "shingles_a", "shingles_b")
    return materialize(exact.mapInPandas(overlapping, "a bigint, b bigint"), "links")


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of ``links(a, b)``: the smallest node reachable.

    Each round every node moves to its smallest neighbour and links are redrawn
    between where their ends moved, until none is left; then the moves are followed
    back from the last round to the first.
    """
    links = materialize(links.select("a", "b").filter(F.col("a") != F.col("b")), "links")
    moves: list[DataFrame] = []
    while not links.isEmpty():
        ends = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        ends = ends.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        move = ends.groupBy("node").agg(F.min("other").alias("other"))
        move = materialize(move.select("node", F.least("node", "other").alias("to")), "moves")
        moves.append(move)
        ends = joined_ends(links, move.withColumnRenamed("node", "set_id"), hot_ends(links))
        moved = ends.filter(F.col("to_a") != F.col("to_b"))
        links = materialize(moved.select(*_ordered("to_a", "to_b")).distinct(), "links")
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = moves[0].select("node", F.col("to").alias("component"))
    for move in moves[1:]:
        step = move.select(F.col("node").alias("component"), "to")
        found = found.join(step, "component", "left")
        found = found.select("node", F.coalesce("to", "component").alias("component"))
    return materialize(found, "components")


def open_pairs(tiles: DataFrame, found: DataFrame, signed: DataFrame, settings: JoinSettings) -> DataFrame:
    """Pairs of the tiles across components that the bitmaps leave possible.

    ``tiles`` with leaders; pairs with a leader are left out, as they are decided.
    """
    three = tiles.filter(F.col("n") > 2).join(found, F.col("set_id") == F.col("node"), "left")
    three = three.withColumn("component", F.coalesce("component", "set_id")).drop("node")
    mixed = (
        three.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.max(F.when(F.col("set_id") == F.col("leader"), F.col("component"))).alias("main"),
        )
        .filter(F.col("low") != F.col("high"))
        .select("key", "main")
    )
    rows = three.join(mixed, "key").filter(F.col("set_id") != F.col("leader"))
    sets = signed.select("set_id", "size", "bits").filter(F.col("bits").isNotNull()).dropDuplicates(["set_id"])
    rows = materialize(rows.join(sets, "set_id"), "open-tiles")
    blocks = F.ceil(F.col("n") / BLOCK_SETS).cast("int")
    own = F.pmod(F.xxhash64("set_id"), blocks).cast("int")
    every = F.sequence(F.lit(0), blocks - 1)
    # An outsider is in another component than the leader; one end of a pair is.
    ends = rows.withColumn("own", own).withColumn("every", every)
    left = ends.filter(F.col("component") != F.col("main"))
    left = left.withColumn("i", F.col("own")).withColumn("j", F.explode("every")).withColumn("left", F.lit(True))
    right = ends.withColumn("j", F.col("own")).withColumn("i", F.explode("every")).withColumn("left", F.lit(False))
    cells = left.unionByName(right).select("key", "i", "j", "left", "set_id", "component", "size", "bits")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            cell = rows[["key", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
            bounds = [0, *cuts]
            for first, last in zip(bounds, bounds[1:], strict=False):
                yield _possible(rows.iloc[first:last], settings)
            rest = rows.iloc[bounds[-1] :]
        if rest is not None and len(rest):
            yield _possible(rest, settings)

    parts = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInPandas(compare, "a bigint, b bigint").distinct()


def _possible(cell: pd.DataFrame, settings: JoinSettings) -> pd.DataFrame:
    """Pairs of one cell across components whose bit counts allow a link."""
    is_left = cell["left"].to_numpy(bool)
    ids, parts, sizes = (cell[c].to_numpy(np.int64) for c in ("set_id", "component", "size"))
    nbytes = min(map(len, cell["bits"]), default=0)
    bits = np.stack([folded(x, nbytes) for x in cell["bits"]])
    right = np.flatnonzero(~is_left)
    found_a, found_b = [], []
    for at in np.flatnonzero(is_left):
        apart = np.bitwise_count(bits[right] ^ bits[at]).sum(axis=1, dtype=np.int64)
        total = sizes[right] + sizes[at]
        good = right[settings.linked((total - apart) // 2, total) & (parts[right] != parts[at])]
        found_a.append(np.minimum(ids[good], ids[at]))
        found_b.append(np.maximum(ids[good], ids[at]))
    none = [np.zeros(0, np.int64)]
    return pd.DataFrame({"a": np.concatenate(found_a or none), "b": np.concatenate(found_b or none)}).drop_duplicates()


def with_heads(rows: DataFrame, named: DataFrame) -> DataFrame:
    """``rows(set_id, ...)`` with the head of their set, null without a set.

    ``named(set_id, n, head)``, a written table, counts the rows of every set.  The
    sets of very many rows are broadcast; their number is bounded by ``HOT_SHARE``.
    Only rows of other sets are shuffled.
    """
    least = max(HOT_PAIRS, int(HOT_SHARE * rows.count()))
    hot = named.filter(F.col("n") > least)
    dealt = rows.join(F.broadcast(hot), "set_id", "left")
    known = F.col("n").isNotNull() | F.col("set_id").isNull()
    rest = dealt.filter(~known).select(*rows.columns).join(named.drop("n"), "set_id", "left")
    columns = [*rows.columns, "head"]
    return dealt.filter(known).select(*columns).unionByName(rest.select(*columns))


def _text_name(text: Column | str) -> Column:
    """Tells the texts of a repeated id apart; never null."""
    return F.xxhash64(text)


def near_duplicates(docs: DataFrame, settings: JoinSettings = JoinSettings()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs(doc_id, text)``.

    Words are parted by ASCII white space and A-Z lower-cased.  Equal sets are one
    set throughout.  A null, empty or blank text has no shingles and is alone; a
    row with a null doc_id gets a null component and links nothing.  Rows that
    repeat an id are placed by their own text.  Sets are told apart by a 64-bit
    hash of their shingles.
    """
    return placed(docs, settings).drop("text_name")


def placed(docs: DataFrame, settings: JoinSettings) -> DataFrame:
    """As ``near_duplicates``, with text_name."""
    signed = materialize(signatures(docs, settings), "signatures")
    usable = signed.filter(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull())
    tiles = materialize(with_leaders(materialize(shared_tiles(usable), "tiles")), "led-tiles")
    star = tiles.filter(F.col("set_id") != F.col("leader")).select(*_ordered("set_id", "leader")).distinct()
    links = verified(star, usable, docs, settings)
    found = components(links)
    more = materialize(open_pairs(tiles, found, usable, settings), "open-pairs")
    if not more.isEmpty():
        links = links.unionByName(verified(more, usable, docs, settings))
        found = components(links)

    classes = signed.filter(F.col("set_id").isNotNull()).groupBy("set_id")
    classes = classes.agg(F.min("doc_id").alias("smallest"), F.count("*").alias("n"))
    linked = found.join(classes, F.col("node") == F.col("set_id"))
    heads = linked.groupBy("component").agg(F.min("smallest").alias("head"))
    linked = linked.join(heads, "component").select("set_id", "head")
    named = classes.join(linked, "set_id", "left")
    named = materialize(named.select("set_id", "n", F.coalesce("head", "smallest").alias("head")), "heads")
    rows = with_heads(signed.select("doc_id", "text_name", "size", "set_id"), named)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("head", "doc_id"))
    return rows.select("doc_id", "text_name", F.col("size").alias("n_shingles"), component.alias("component_id"))


def keep_first(docs: DataFrame, settings: JoinSettings = JoinSettings()) -> DataFrame:
    """The documents, all columns, but for those linked with a document of smaller id.

    Rows are dropped by id and text, so of an id that repeats with different texts
    only the linked ones go.  Linked rows that share the smallest id all stay, as do
    rows with a null id.
    """
    found = placed(docs, settings)
    later = found.filter(F.col("component_id") < F.col("doc_id"))
    later = later.select(F.col("doc_id").alias("later_id"), F.col("text_name").alias("later_name")).distinct()
    gone = (docs["doc_id"] == later["later_id"]) & (_text_name(docs["text"]) == later["later_name"])
    return docs.join(later, gone, "left_anti").select(*docs.columns)
