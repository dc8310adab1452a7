"""WARC archives through a table of record chunks.

A payload is a series of rows (record, chunk number), none larger than a set
size. Each chunk is written as a WARC record of its own: the first as the
response, later ones as its continuations, by the segmentation of the WARC
standard. Each carries the digest of the payload up to its own end, so writer
and reader go through a payload once and never hold a whole archive record.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.chunks import sliced

CHUNK_BYTES = 1 << 20
OUT_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"  # the tables have no time of capture
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK = b"\r\n\r\n"  # ends a block of headers, and a record


def sha1_base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def marked(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """Pages with the digest of their payload and the page that holds the payload."""
    pages = pages.select(
        F.col(page_id).alias("page"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    size = F.octet_length("payload").cast("long")
    first = pages.groupBy("digest").agg(F.max("page").alias("holder"))
    both = pages.join(first, "digest")
    original = F.col("page").eqNullSafe(F.col("holder")) | F.col("holder").isNull() | (size < least)
    return both.select("page", "url", "digest", "payload", size.alias("bytes"), F.when(~original, F.col("holder")).alias("refers_to"))


def header(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + BREAK + block


def chunks(payload: bytes, size: int) -> Iterator[tuple[int, bytes, bool, str]]:
    """Number, bytes, whether it is the last, and the digest up to its end."""
    running, view = hashlib.sha1(), memoryview(payload)
    count = max(1, -(-len(payload) // size))
    for number in range(count):
        part = bytes(view[number * size : (number + 1) * size])
        running.update(part)
        yield number + 1, part, number + 1 == count, sha1_base32(running.digest())


def records(page: object, url: str | None, digest: str, payload: bytes, refers_to: object, size: int) -> Iterator[bytes]:
    """The WARC records of one page, without the line ends behind them."""
    name = f"<urn:page:{page}>"
    full = "sha1:" + sha1_base32(bytes.fromhex(digest))
    target = None if url is None else "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    common = [("WARC-Target-URI", target), ("WARC-Date", DATE), ("WARC-Payload-Digest", full), ("Payload-Length", len(payload))]
    if refers_to is not None:
        told = [("WARC-Type", "revisit"), ("WARC-Record-ID", name), ("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        yield header(told + common, b"")
        return
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + BREAK
    for number, part, last, running in chunks(payload, size):
        if number == 1:
            told = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common, ("Content-Type", "application/http;msgtype=response")]
            block = http + part
        else:
            told = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{page}:{number}>"), ("WARC-Segment-Origin-ID", name), ("WARC-Date", DATE)]
            block = part
        if number > 1 or not last:
            told += [("WARC-Segment-Number", number), ("Running-Digest", "sha1:" + running)]
            if last:
                told.append(("WARC-Segment-Total-Length", len(http) + len(payload)))
        yield header(told, block)


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 0,
    chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Writes the pages as compressed WARC files, one per task.

    Of equal payloads of at least ``least`` bytes the page with the largest id
    is the response, and the others revisit it. A null payload is empty. A null
    id names no response unless all ids of a payload are null, when each page
    is one. Rows repeated with the largest id are responses all. Pages move
    once, to the task of their digest; a hot one is split. Other columns are
    ignored; an empty table gives no records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            columns = [batch.column(names.index(c)) for c in ("page", "url", "digest", "payload", "refers_to")]
            rows = (r for row in zip(*columns, strict=True) for r in records(*(v.as_py() for v in row), chunk_bytes))
            for part in sliced(rows, len, OUT_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary())], names=["value"])

    lines = marked(pages, page_id, url, html, least).mapInArrow(run, "value binary")
    lines.select(F.col("value").cast("string")).write.text(path, compression="gzip", lineSep=BREAK.decode())


class Feed:
    """The bytes of archives, read in order."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.buffer = iter(pieces), b""

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is not None:
            self.buffer += piece
        return piece is not None

    def headers(self) -> dict[str, str] | None:
        """The headers of the next record; None at the end."""
        while not self.buffer.strip(b"\r\n"):
            self.buffer = b""
            if not self.more():
                return None
        self.buffer = self.buffer.lstrip(b"\r\n")
        while (end := self.buffer.find(BREAK)) < 0:
            if not self.more():
                raise ValueError("an archive ends within a header")
        lines = self.buffer[:end].decode().split("\r\n")
        self.buffer = self.buffer[end + len(BREAK) :]
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record does not begin where the one before ended")
        return dict(line.split(": ", 1) for line in lines[1:])

    def block(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.buffer and not self.more():
                raise ValueError("an archive ends within a record")
            part, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(part)
            if part:
                yield part


def payload_of(block: Iterator[bytes]) -> Iterator[bytes]:
    """The block without its HTTP head."""
    head = b""
    for part in block:
        head += part
        if (end := head.find(BREAK)) >= 0:
            yield head[end + len(BREAK) :]
            yield from block
            return


def parsed(pieces: Iterable[bytes]) -> Iterator[dict]:
    """One row per page; payloads are counted and digested as they pass."""
    feed, row, digest = Feed(pieces), None, None
    while (told := feed.headers()) is not None:
        kind, block = told["WARC-Type"], feed.block(int(told["Content-Length"]))
        if kind == "continuation":
            if row is None or row["id"] != told["WARC-Segment-Origin-ID"]:
                raise ValueError("a continuation stands without its beginning")
        else:
            if row is not None:
                yield finished(row, digest)
            row = {"id": told["WARC-Record-ID"], "type": kind, "digest": told["WARC-Payload-Digest"], "length": int(told["Payload-Length"])}
            row |= {"url": told.get("WARC-Target-URI"), "refers_to": told.get("WARC-Refers-To"), "bytes": 0, "chunks": 0}
            digest = hashlib.sha1()
            block = payload_of(block) if kind == "response" else block
        for part in block:
            digest.update(part)
            row["bytes"] += len(part)
        row["chunks"] += 1
        if "Running-Digest" in told and told["Running-Digest"] != "sha1:" + sha1_base32(digest.digest()):
            raise ValueError(f"{row['id']}: chunk {row['chunks']} has another digest than written")
    if row is not None:
        yield finished(row, digest)


def finished(row: dict, digest) -> dict:
    if row["type"] == "response":
        found = "sha1:" + sha1_base32(digest.digest())
        if (found, row["bytes"]) != (row["digest"], row["length"]):
            raise ValueError(f"{row['id']}: the payload is not the one written")
    return row


def read_archives(spark: SparkSession, path: str, page_id: str = "page_id", kind: T.DataType | None = None) -> DataFrame:
    """One row per page of the archives, with digests checked against the bytes read.

    Columns: the page's id, ``url``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to`` and ``chunks``. Files are read in rows that
    end where a header could end, so the longest row is one chunk.
    """
    schema = "page string, url string, bytes long, digest string, type string, refers_to string, chunks long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (value.as_py() + BREAK for batch in batches for value in batch.column(0))
        for part in sliced(parsed(pieces), lambda r: 1, 5000):
            names = [n.split()[0] for n in schema.split(", ")]
            rows = [{**r, "page": r["id"], "bytes": r["length"], "digest": r["digest"].removeprefix("sha1:")} for r in part]
            types = {"bytes": pa.int64(), "chunks": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names], names=names)

    lines = spark.read.text(path, lineSep=BREAK.decode()).select(F.col("value").cast("binary"))
    kind = kind or T.LongType()
    number = lambda c: F.nullif(F.regexp_extract(c, r"(?s)^<urn:page:(.*)>$", 1), F.lit("None")).cast(kind)
    return lines.mapInArrow(run, schema).select(
        number("page").alias(page_id),
        "url",
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
        "chunks",
    )
