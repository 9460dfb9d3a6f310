"""WARC archives with a two-level capture index.

Tasks write gzip members, one per record, to archives in a shared folder.  The
index sorts captures by reversed-host URL key and capture id into compressed
blocks; a sparse directory keeps the first key of every block.  A lookup finds its
shard among the shards' first keys, binary-searches the directory of the shard and
then the block, and reads the byte range of its record.

Files are opened through the file systems that Arrow knows, so the folder may be
local, HDFS or an object store.  A lost task leaves a file that no row names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.plans.storage import fresh_path, lookup_join, materialize, measure_lookup

ARCHIVE_BYTES = 256 << 20
BLOCK_LINES = 1000
#: Captures of an index shard at least, and the most shards: their first keys go to
#: every task, so shards grow instead.
SHARD_ROWS = 50_000
MAX_SHARDS = 10_000
#: Gap between two records that is read over instead of opening a new range.
JOINED_GAP = 64 << 10
#: Longest range that is read at once.
JOINED_BYTES = 2 << 20

_RECORDED = "2024-01-01T00:00:00Z"
_END = b"\r\n\r\n"

CAPTURE = "key string, page_id string, archive string, start bigint, bytes bigint"
RECORD = (
    "page_id string, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to string, payload binary"
)


_IDS = ("page_id", "refers_to")


# Ids pass to and from Python as text: a column with nulls would become
# floating-point numbers.
def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _as_numbers(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def url_key(url: str | None) -> str:
    """Sort key: host labels reversed, then path and query, lower-case without scheme.

    Null and empty URLs have the empty key; text that is no URL is its own key.
    """
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return text.lower()
    if not host:
        return text.lower()
    turned = ",".join(reversed(host.split(".")))
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{turned}{f':{port}' if port else ''}){rest}".lower()


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def encode_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A gzip member: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    revisit = refers_to is not None
    block = http.encode() + (b"" if revisit else payload)
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": _RECORDED,
        "WARC-Page-ID": json.dumps(page_id),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if url and url.isascii() and url.isprintable() and " " not in url:
        head["WARC-Target-URI"] = url
    else:  # no text that a header line may hold
        head["WARC-Page-URL"] = json.dumps(url)
    if revisit:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = _record_id(refers_to)
        head["WARC-Refers-To-Page-ID"] = refers_to
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + _END) + press.flush()


def decode_record(member: bytes) -> dict:
    """What ``encode_record`` was given; digest and length of a response are taken anew."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(_END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(_END)
    out = {
        "page_id": json.loads(fields["WARC-Page-ID"]),
        "url": fields.get("WARC-Target-URI") or json.loads(fields["WARC-Page-URL"]),
        "record_type": fields["WARC-Type"],
        "refers_to": None,
    }
    if out["record_type"] == "revisit":
        length = next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length"))
        out |= {
            "payload": None,
            "payload_bytes": int(length.split(": ")[1]),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "refers_to": int(fields["WARC-Refers-To-Page-ID"]),
        }
    else:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if fields["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"damaged record of page {out['page_id']}")
        out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}
    return out


def with_originals(pages: DataFrame, payload: Column, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to: the largest page_id of an equal payload, for the others.

    Payloads of fewer than ``min_bytes`` refer to nothing.  Rows that repeat the
    largest id stay responses, as do rows with a null id; where all ids of a
    payload are null, none refers to another.  Only the digests are grouped, with
    one row per digest and task.  Those that occur more than once are written and
    measured: within the lookup bounds they are broadcast and no payload is moved;
    beyond, rows meet them over salts, so that a digest of very many pages (those
    without html, say) is spread over tasks.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    last = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("original").isNotNull())
        .select("digest", "original")
    )
    last = materialize(last, "originals")
    size = measure_lookup(last, "digest")
    refers = F.when(F.col("page_id") != F.col("original"), F.col("original"))
    marked = lookup_join(rows, last, "digest", size, "left", spread_by=("page_id", "url"))
    return marked.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row, a null payload as empty; the captures (key, page_id, archive, start, bytes), as a written table."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, name, at, seen = None, "", 0, 0
        captures: list[tuple] = []
        try:
            for batch in batches:
                numbers = [[None if x is None else int(x) for x in batch[c]] for c in ("page_id", "refers_to")]
                for page_id, url, payload, original in zip(
                    numbers[0], batch["url"], batch["payload"], numbers[1], strict=True
                ):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        filesystem, path = _filesystem(name)
                        filesystem.create_dir(path.rpartition("/")[0], recursive=True)
                        out = filesystem.open_output_stream(path, compression=None)
                    payload = b"" if payload is None else bytes(payload)
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    member = encode_record(page_id, url, payload, digest, original)
                    out.write(member)
                    captures.append((url_key(url), None if page_id is None else str(page_id), name, at, len(member)))
                    at += len(member)
                seen += len(batch)
                yield pd.DataFrame(captures, columns=["key", "page_id", "archive", "start", "bytes"])
                captures = []
        finally:
            if out is not None:
                out.close()

    captures = _as_text(rows, "page_id", "refers_to").mapInPandas(write, CAPTURE)
    return materialize(_as_numbers(captures, "page_id"), "captures")


@dataclass(frozen=True)
class CaptureIndex:
    """``directory``: shard, file, firsts (first line of every block), starts, lengths."""

    directory: DataFrame
    shard_keys: list[str]  # first line of every shard


def _line(key: str, page_id: int | None) -> str:
    """Sort form of a capture: ids are padded, so lines sort as (key, id)."""
    return f"{key}\x00{'' if page_id is None else f'{page_id + (1 << 63):020d}'}"


def build_index(
    captures: DataFrame, folder: str, shard_rows: int = SHARD_ROWS, block_lines: int = BLOCK_LINES
) -> CaptureIndex:
    """Sort the captures into shards of compressed blocks, with a directory per shard.

    Shards are ranges of (key, id): a URL or host with very many captures runs over
    several.
    """
    shards = min(MAX_SHARDS, max(1, -(-captures.count() // shard_rows)))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = f"{folder}/{uuid.uuid4().hex}.cdx.gz"
        filesystem, path = _filesystem(name)
        out, at = None, 0
        lines: list[tuple] = []
        firsts, starts, lengths = [], [], []

        def flush() -> None:
            nonlocal out, at, lines
            if out is None:
                filesystem.create_dir(path.rpartition("/")[0], recursive=True)
                out = filesystem.open_output_stream(path, compression=None)
            block = zlib.compress(json.dumps(lines).encode())
            out.write(block)
            firsts.append(lines[0][0])
            starts.append(at)
            lengths.append(len(block))
            at, lines = at + len(block), []

        try:
            for batch in batches:
                ids = [None if x is None else int(x) for x in batch["page_id"]]
                for key, page_id, *place in zip(
                    batch["key"], ids, batch["archive"], batch["start"].tolist(), batch["bytes"].tolist(), strict=True
                ):
                    lines.append((_line(key, page_id), *place))
                    if len(lines) == block_lines:
                        flush()
            if lines:
                flush()
        finally:
            if out is not None:
                out.close()
        if firsts:
            yield pd.DataFrame({"file": [name], "firsts": [firsts], "starts": [starts], "lengths": [lengths]})

    order = ["key", F.col("page_id").asc_nulls_first(), "archive", "start"]
    sorted_ = captures.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    schema = "file string, firsts array<string>, starts array<bigint>, lengths array<bigint>"
    written = materialize(_as_text(sorted_, "page_id").mapInPandas(write, schema), "directory")
    number = F.row_number().over(Window.orderBy(F.element_at("firsts", 1), "file")) - 1
    # One row per shard, not per block: short, and as many as there are shards.
    names = written.select("file", F.element_at("firsts", 1).alias("first"), "firsts").withColumn("shard", number)
    keys = [r["first"] for r in names.select("first", "shard").orderBy("shard").collect()]
    directory = written.join(names.select("file", "shard"), "file")
    return CaptureIndex(directory, keys)


def locate(index: CaptureIndex, queries: DataFrame, group_rows: int = SHARD_ROWS) -> DataFrame:
    """Rows ``queries(url, page_id)`` -> (archive, start, bytes) of the captures found.

    A null page_id asks for all captures of the URL, whatever their id.  A group is
    a shard with about ``group_rows`` of its queries.
    """
    shard_keys = index.shard_keys

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for url, page_id in zip(batch["url"], batch["page_id"], strict=True):
                key = url_key(url)
                if page_id is None:
                    low, high = _line(key, None), f"{key}\x01"
                else:
                    low = high = _line(key, int(page_id))
                first = max(0, bisect_left(shard_keys, low) - 1)
                out += [(shard, low, high) for shard in range(first, bisect_right(shard_keys, high))]
            yield pd.DataFrame(out, columns=["shard", "low", "high"])

    asked = queries.select("url", F.col("page_id").cast("bigint").alias("page_id"))
    asked = _as_text(asked, "page_id").mapInPandas(route, "shard int, low string, high string").distinct()
    asked = materialize(asked, "lookups")
    parts = max(1, -(-asked.count() // (group_rows * max(1, len(shard_keys)))))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("low", "high"), F.lit(parts)).cast("int"))
    directory = index.directory.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def find(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for file, firsts, starts, lengths in zip(
            shard["file"], shard["firsts"], shard["starts"], shard["lengths"], strict=True
        ):
            firsts = list(firsts)
            filesystem, path = _filesystem(file)
            with closing(filesystem.open_input_file(path)) as source:
                number, lines, keys = -1, [], []
                for low, high in sorted(zip(asked["low"], asked["high"], strict=True)):
                    at = max(0, bisect_left(firsts, low) - 1)
                    while at < len(firsts) and firsts[at] <= high:
                        if number != at:
                            block = source.read_at(lengths[at], starts[at])
                            lines, number = json.loads(zlib.decompress(block)), at
                            keys = [x[0] for x in lines]
                        out += [x[1:] for x in lines[bisect_left(keys, low) : bisect_right(keys, high)]]
                        at += 1
        return pd.DataFrame(out, columns=["archive", "start", "bytes"])

    return (
        directory.groupBy("shard", "part")
        .cogroup(asked.groupBy("shard", "part"))
        .applyInPandas(find, "archive string, start bigint, bytes bigint")
        .distinct()
    )


def read_records(places: DataFrame, payloads: bool = True, partitions: int | None = None) -> DataFrame:
    """Read the byte ranges; records near each other in an archive share a range.

    Without ``payloads`` these are read and checked as well, but not returned.
    """
    spark = places.sparkSession
    schema = RECORD if payloads else RECORD.removesuffix(", payload binary")
    columns = [x.split()[0] for x in schema.split(", ")]
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, opened = None, None
        try:
            for batch in batches:
                ranges = list(zip(batch["archive"], batch["start"].tolist(), batch["bytes"].tolist(), strict=True))
                at = 0
                while at < len(ranges):
                    archive, first, size = ranges[at]
                    last, end = at + 1, first + size
                    while (
                        last < len(ranges)
                        and ranges[last][0] == archive
                        and ranges[last][1] - end <= JOINED_GAP
                        and ranges[last][1] + ranges[last][2] - first <= JOINED_BYTES
                    ):
                        end, last = ranges[last][1] + ranges[last][2], last + 1
                    if opened != archive:
                        if source is not None:
                            source.close()
                        filesystem, path = _filesystem(archive)
                        source, opened = filesystem.open_input_file(path), archive
                    data = source.read_at(end - first, first)
                    found = []
                    for _, start, size in ranges[at:last]:
                        record = decode_record(data[start - first : start - first + size])
                        found.append([record[c] for c in columns])
                    frame = pd.DataFrame(found, columns=columns, dtype=object)
                    yield frame.assign(**{c: [None if x is None else str(x) for x in frame[c]] for c in _IDS})
                    at = last
        finally:
            if source is not None:
                source.close()

    spread = places.repartitionByRange(partitions, "archive", "start").sortWithinPartitions("archive", "start")
    return _as_numbers(spread.mapInPandas(read, schema), *_IDS)


def archive_pages(pages: DataFrame, min_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """Write all pages (page_id, url, html), index them, and read every record back.

    Null html is an empty payload.  Columns of ``RECORD``, with the payload, null for
    a revisit, only if ``payloads``.
    """
    folder = fresh_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = with_originals(pages, payload, min_bytes)
    captures = write_archives(rows, f"{folder}/archives")
    index = build_index(captures, f"{folder}/index")
    return read_records(materialize(locate(index, pages), "places"), payloads)
