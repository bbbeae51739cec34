"""WARC archives with a two-level capture index.

Tasks write archives of single gzip members, one per record. The index has a line per record,
sorted by reversed-host url key; runs of lines are compressed into blocks in index files, and a
sparse directory keeps the first key, file, offset and length of each block. A lookup searches the
directory, then the one block, by binary search, and reads a single range of an archive.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import stage
from stratamart.session import shared_dir

# Payloads of fewer bytes are stored each time: a revisit record would hardly be shorter.
MIN_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
# Index lines per block at least; larger indexes get longer blocks, so that the directory keeps
# to MAX_BLOCKS entries, some 64 MB with keys of ordinary length.
BLOCK_LINES = 3000
MAX_BLOCKS = 500_000
# Bytes of an archive that one reading task gets.
READ_BYTES = 16 << 20
ZIP_LEVEL = 3

LINES = """line_key string, page_id long, url string, record_type string, payload_digest string,
refers_to long, file string, offset long, length long"""
BLOCKS = "first string, file string, offset long, length long, lines long"
RECORDS = """page_id long, payload_bytes long, payload_digest string, record_type string,
refers_to long, said_digest string"""
FOUND = "page_id long, file string, offset long, length long"


def opened(folder: str):
    """The file system of a folder's URI and the folder's path in it."""
    from pyarrow import fs

    if "://" not in folder:
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", folder)
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", folder))


def clean(value: str) -> str:
    """A header or key on one line: blanks and control characters as percent codes."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def url_key(url: str | None) -> str:
    """``org,example)/path?query``: hosts sort by their labels from the last, so that a site's
    pages lie together. Without ``://`` the key is the url itself, without url a bracket."""
    if not url:
        return ")"
    _, mark, rest = clean(url).partition("://")
    if not mark:
        return clean(url)
    host = re.match(r"[^/?#]*", rest).group()
    name, _, port = host.rpartition("@")[2].partition(":")
    return ",".join(reversed(name.lower().split("."))) + (f":{port}" if port else "") + ")" + rest[len(host) :]


def line_key(url: str | None, page_id: int | None, digest: str | None = None) -> str:
    """What index lines are sorted by: the url key, then the page's number, then the payload's digest. Keys hold no
    blanks, and a blank sorts before all that they hold; without a digest this is what all lines of a page begin with."""
    return f"{url_key(url)} {(page_id or 0) + (1 << 63):020d} {digest or ''}"


def record(page_id, url, kind: str, payload: bytes, digest: str, refers_to, refers_url) -> bytes:
    """One WARC record, uncompressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    body = http + b"Content-Length: %d\r\n\r\n" % len(payload)
    if kind == "response":
        body += payload
    name = lambda number: uuid.UUID(hashlib.md5(f"page {number}".encode()).hexdigest())
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {clean(url)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:uuid:{name(refers_to)}>")
        lines.append(f"X-Refers-To-Page-ID: {refers_to}")
        if refers_url is not None:
            lines.append(f"WARC-Refers-To-Target-URI: {clean(refers_url)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """What a record says; the lengths it states, not the blank lines, tell where it ends."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    _, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    number = lambda name: int(fields[name]) if name in fields else None
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": number("X-Page-ID"),
        "payload_bytes": None if revisit else len(payload),
        "payload_digest": None if revisit else hashlib.sha1(payload).hexdigest(),
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-ID"),
        "said_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": None if revisit else payload,
    }


def whole_numbers(values) -> list:
    return [None if v is None or v != v else int(v) for v in values]


def frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [c.split() for c in schema.replace("\n", " ").split(",")]
    out = pd.DataFrame(rows, columns=[n for n, _ in names])
    return out.astype({n: "Int64" for n, kind in names if kind == "long"})


@dataclass(frozen=True)
class Archive:
    """``lines``: a row per record; ``directory``: a row per block of the index."""

    lines: DataFrame
    directory: DataFrame


def with_types(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    """Every page with its digest and, if it repeats a payload, the page that keeps it: the one with
    the largest number among equal payloads of at least MIN_BYTES bytes. Pages without a number are
    never revisits. Only one row per repeated payload takes part in the join, however often it occurs."""
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        text.alias("payload"),
        F.sha1(text).alias("payload_digest"),
        F.octet_length(text).alias("bytes"),
    )
    kept = (
        rows.filter(f"bytes >= {MIN_BYTES} and page_id is not null")
        .groupBy("payload_digest", "bytes")
        .agg(F.max(F.struct("page_id", "url")).alias("kept"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("payload_digest", "bytes", "kept")
    )
    revisit = F.col("page_id") < F.col("kept.page_id")
    return rows.join(kept, ["payload_digest", "bytes"], "left").select(
        "page_id",
        "url",
        "payload",
        "payload_digest",
        F.when(revisit, F.col("kept.page_id")).alias("refers_to"),
        F.when(revisit, F.col("kept.url")).alias("refers_url"),
    )


def write_archives(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html"
) -> Archive:
    """Write a record per row into new archives in the shared folder, and their index.

    A null payload is empty, a null url or page number is left out of the record; repeated rows are
    records of their own; an empty table gives an archive without records. Other columns are ignored.

    A task writes a file of a name of its own and reports its records. The reports are committed by Spark
    with the index lines, so files of lost or repeated attempts are merely never referred to.
    """
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/warc/{uuid.uuid4().hex}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for rows in batches:
            lines = []
            out = out or system.open_output_stream(f"{path}/{name}", compression=None)
            for number, link, text, digest, refers, refers_url in zip(
                whole_numbers(rows["page_id"]), rows["url"], rows["payload"], rows["payload_digest"],
                whole_numbers(rows["refers_to"]), rows["refers_url"], strict=True,
            ):
                kind = "response" if refers is None else "revisit"
                packer = zlib.compressobj(ZIP_LEVEL, zlib.DEFLATED, 31)
                raw = record(number, link, kind, text.encode(), digest, refers, refers_url)
                data = packer.compress(raw) + packer.flush()
                out.write(data)
                lines.append((line_key(link, number, digest), number, link, kind, digest, refers, name, at, len(data)))
                at += len(data)
            yield frame(lines, LINES)
        if out:
            out.close()

    typed = with_types(pages, page_id, url, payload)
    lines = stage(typed.mapInPandas(write, LINES).withColumn("folder", F.lit(folder)), "warc-lines")
    return Archive(lines, write_index(lines, folder))


def write_index(lines: DataFrame, folder: str) -> DataFrame:
    """Sort the lines, pack them into compressed blocks, and return the directory."""
    count = lines.count()
    per_block = max(BLOCK_LINES, -(-count // MAX_BLOCKS))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = opened(folder)
        name, out, at, held = f"{uuid.uuid4().hex}.cdx.gz", None, 0, []

        def flush():
            nonlocal at, held, out
            out = out or system.open_output_stream(f"{path}/{name}", compression=None)
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = packer.compress("\n".join(held).encode()) + packer.flush()
            out.write(data)
            row = (held[0].partition("\t")[0], name, at, len(data), len(held))
            at, held = at + len(data), []
            return frame([row], BLOCKS)

        for rows in batches:
            for line in zip(rows["line_key"], rows["file"], rows["offset"], rows["length"], strict=True):
                held.append("\t".join(map(str, line)))
                if len(held) >= per_block:
                    yield flush()
        if held:
            yield flush()
        if out:
            out.close()

    parts = max(1, -(-count // (64 * per_block)))
    order = ["line_key", "file", "offset"]
    blocks = (
        lines.select("line_key", "file", "offset", "length")
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInPandas(pack, BLOCKS)
    )
    return stage(blocks.withColumn("folder", F.lit(folder)), "warc-directory")


def find(archive: Archive, wanted: DataFrame) -> DataFrame:
    """Where the records of pages (``url``, ``page_id`` and, if wanted, ``payload_digest``) lie: ``page_id``, ``file``,
    ``offset``, ``length``. Pages that are not there give no row; of repeated records, or without a digest of all
    records of a page, the first is given."""
    spark = wanted.sparkSession
    entries = archive.directory.select("first", "file", "offset", "length", "folder").orderBy("first").collect()
    if not entries:
        return spark.createDataFrame([], FOUND)
    folder = entries[0]["folder"]
    sent = spark.sparkContext.broadcast([tuple(e)[:4] for e in entries])

    def to_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        firsts = [e[0] for e in sent.value]
        for rows in batches:
            numbers = whole_numbers(rows["page_id"])
            keys = [line_key(u, n, d) for u, n, d in zip(rows["url"], numbers, rows["payload_digest"], strict=True)]
            # A key equal to the first of some blocks may begin at the end of the block before.
            blocks = [max(0, bisect.bisect_left(firsts, k) - 1) for k in keys]
            yield frame(list(zip(blocks, keys, numbers, strict=True)), "block long, key string, page_id long")

    def in_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = opened(folder)
        at, lines, keys = None, [], []

        def fetch(block):
            _, name, offset, length = sent.value[block]
            with system.open_input_file(f"{path}/{name}") as file:
                return zlib.decompress(file.read_at(length, offset), 31).decode().split("\n")

        for rows in batches:
            found = []
            for block, key, number in zip(rows["block"], rows["key"], whole_numbers(rows["page_id"]), strict=True):
                for here in (block, block + 1):
                    if here != at and here < len(sent.value):
                        at, lines = here, fetch(here)
                        keys = [line.partition("\t")[0] for line in lines]
                    place = bisect.bisect_left(keys, key)
                    if at == here and place < len(keys):
                        if keys[place].startswith(key):
                            _, name, offset, length = lines[place].split("\t")
                            found.append((number, name, int(offset), int(length)))
                        break
            yield frame(found, FOUND)

    return (
        wanted.select("url", "page_id", "payload_digest" if "payload_digest" in wanted.columns else F.lit("").alias("payload_digest"))
        .mapInPandas(to_blocks, "block long, key string, page_id long")
        .repartition("block")
        .sortWithinPartitions("block", "key")
        .mapInPandas(in_blocks, FOUND)
        .withColumn("folder", F.lit(folder))
    )


def read_ranges(found: DataFrame) -> DataFrame:
    """The records at some places of archives, by one range read each, with their payloads."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out, system, file, name = [], None, None, None
            for folder, own, offset, length in zip(
                rows["folder"], rows["file"], rows["offset"], rows["length"], strict=True
            ):
                if (folder, own) != name:
                    if file:
                        file.close()
                    system, path = opened(folder)
                    file, name = system.open_input_file(f"{path}/{own}"), (folder, own)
                out.append(tuple(parse(zlib.decompress(file.read_at(length, offset), 31)).values()))
            if file:
                file.close()
            yield frame(out, f"{RECORDS}, payload binary")

    return found.mapInPandas(read, f"{RECORDS}, payload binary")


def read_archives(archive: Archive) -> DataFrame:
    """All records, from the archives alone: RECORDS. An archive is cut into runs of whole records of some
    READ_BYTES; each is one range read and is unpacked record by record."""
    runs = (
        archive.lines.groupBy("folder", "file", F.expr(f"offset div {READ_BYTES}").alias("run"))
        .agg(F.min("offset").alias("low"), F.max(F.expr("offset + length")).alias("high"))
    )
    runs = runs.repartition(max(1, runs.count()))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for folder, name, low, high in zip(rows["folder"], rows["file"], rows["low"], rows["high"], strict=True):
                system, path = opened(folder)
                with system.open_input_file(f"{path}/{name}") as file:
                    data = file.read_at(high - low, low)
                out = []
                while data:
                    unpacker = zlib.decompressobj(31)
                    out.append(tuple(parse(unpacker.decompress(data)).values())[:-1])
                    data = unpacker.unused_data
                yield frame(out, RECORDS)

    return runs.mapInPandas(read, RECORDS)


def resolved(archive: Archive) -> DataFrame:
    """All records, revisits with the size and digest of the payload that they refer to: the index
    leads to the record they name, once for each, however many refer to it. Of several records of one page the
    one with the digest that the revisit states is meant. Null pages and payloads stay null and empty, repeated
    rows are there as often as they were written, an empty archive gives none."""
    records = stage(read_archives(archive), "warc-records")
    named = records.filter("refers_to is not null").select(F.col("refers_to").alias("page_id"), F.col("said_digest").alias("payload_digest")).distinct()
    kept = archive.lines.filter("record_type = 'response'").select("page_id", "url", "payload_digest")
    wanted = kept.join(named, ["page_id", "payload_digest"], "left_semi").distinct()
    originals = read_ranges(find(archive, wanted)).select(
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("own_bytes"),
        F.col("payload_digest").alias("said_digest"),
        F.lit(True).alias("read"),
    ).distinct()
    return records.join(originals, ["refers_to", "said_digest"], "left").select(
        "page_id",
        F.coalesce("payload_bytes", "own_bytes").alias("payload_bytes"),
        # A revisit has the digest of what was read for it, not the one that it states.
        F.coalesce("payload_digest", F.when(F.col("read"), F.col("said_digest"))).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
