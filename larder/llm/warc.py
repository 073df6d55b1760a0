"""WARC archives: a writer of deduplicated records and a sequential reader.

The writer gives every record a gzip member of its own. Pages with equal payloads of at least
`least` bytes share one response record, that of the smallest page_id; the others are revisit
records that name it. Archives are files of about `archive_bytes` payload bytes, each with a warcinfo record first,
written by Spark's text writer (one row holds one archive), so they land wherever Spark can write and a lost
task is written again. The writer ends each file with an empty gzip member, in place of a line end.

Which payloads repeat is found by their digests. Where these are few enough they are broadcast, and no page moves;
else pages are joined by digest.

The reader takes a stream of bytes and inflates it member by member, never more than `CHUNK` bytes at once; it frames
the block by Content-Length and checks the digests as the bytes pass, so that a payload needn't be held. It needs no
index and no look-ahead. Spark hands it a file's bytes in one row, so files must be under 2 GB.

Defined results. A null html has an empty payload. A row with a null page_id revisits the response
of its payload, or is a response where no row of that payload has a page_id. Repeated rows of the
response's page_id are responses too. Other columns are ignored; no pages make no records. Records that are neither
response nor revisit are read, checked and passed over. What a revisit states of its payload can be held to the
response by broken_revisits.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import scratch, settled
from larder.llm.memory import lean

LEAST = 100
#: Up to so many digests of repeated payloads (some 100 bytes each) are broadcast.
BROADCAST_DIGESTS = 500_000
#: Rows that the reader gives at once, and bytes that a record's head may have.
ROWS, HEAD = 1000, 1 << 16
ARCHIVE_BYTES = 4 << 20
CHUNK = 1 << 16
#: An empty gzip member.
_EMPTY = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 0xFF, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])
_HEAD = "WARC/1.1\r\n"
_DATE = "2000-01-01T00:00:00Z"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_COLUMNS = ["page_id", "url", "html", "digest", "n", "record_type", "refers_to"]
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class WarcError(ValueError):
    """A record that breaks the framing or whose digest is wrong."""


def record_id(page_id: int | None) -> str:
    return f"<urn:larder:page:{'' if page_id is None else page_id}>"


def _page_of(identifier: str | None) -> int | None:
    digits = (identifier or "").rpartition(":")[2].rstrip(">")
    return int(digits) if digits else None


def write_record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, digest: str, length: int) -> bytes:
    """One record as one gzip member. A revisit keeps the payload's digest and length, not the payload."""
    block = payload if kind == "response" else b""
    head = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", _DATE), ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("X-Payload-Length", str(length)),
        ("Content-Type", "text/html;charset=utf-8"), ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        head[3:3] = [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", _REVISIT_PROFILE)]
    raw = (_HEAD + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def write_info(software: str = "larder") -> bytes:
    """The record that an archive begins with, as one gzip member."""
    block = f"software: {software}\r\nformat: WARC File Format 1.1\r\n".encode()
    head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:larder:info>"), ("WARC-Date", _DATE), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress((_HEAD + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n") + z.flush()


@dataclass
class Record:
    """A record's headers, its block (empty where it wasn't kept) and the block's length and digest, and the place of its member."""

    headers: dict[str, str]
    block: bytes
    length: int
    digest: str
    offset: int

    @property
    def page_id(self) -> int | None:
        return _page_of(self.headers.get("warc-record-id"))

    @property
    def refers_to(self) -> int | None:
        return _page_of(self.headers.get("warc-refers-to"))


class _Source:
    """A stream that bytes can be given back to, and how far it has been read."""

    def __init__(self, stream: io.BufferedIOBase):
        self.stream, self.rest, self.offset = stream, b"", 0

    def take(self) -> bytes:
        data, self.rest = self.rest or self.stream.read(CHUNK), b""
        self.offset += len(data)
        return data

    def give_back(self, data: bytes) -> None:
        self.rest = data
        self.offset -= len(data)


class _Member:
    """The inflated bytes of one gzip member."""

    def __init__(self, source: _Source):
        self.source, self.offset = source, source.offset
        self.inflater, self.held = zlib.decompressobj(31), b""

    def _more(self, most: int) -> bytes:
        z = self.inflater
        while not z.eof:
            data = z.unconsumed_tail or self.source.take()
            if not data:
                raise WarcError(f"the gzip member at byte {self.offset} is cut off")
            out = z.decompress(data, most)
            if z.eof:
                self.source.give_back(z.unused_data)
            if out:
                return out
        return b""

    def read(self, most: int) -> bytes:
        """Up to so many bytes; none at the end."""
        out = self.held[:most] or self._more(most)
        self.held = self.held[most:] if self.held else b""
        return out

    def head(self) -> bytes | None:
        """What stands before the first empty line; None for an empty member."""
        found = b""
        while b"\r\n\r\n" not in found:
            more = self._more(CHUNK)
            if not more and not found:
                return None
            if not more or len(found) > HEAD:
                raise WarcError(f"no WARC record at byte {self.offset}")
            found += more
        head, _, self.held = found.partition(b"\r\n\r\n")
        return head


def read_records(stream: io.BufferedIOBase, keep: bool = True) -> Iterator[Record]:
    """The records of an archive, in order, each with verified digests; with their blocks, if these are to be kept."""
    source = _Source(stream)
    while True:
        if not source.rest:
            source.give_back(source.take())
        if not source.rest:
            return
        member = _Member(source)
        head = member.head()
        if head is None:
            continue
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise WarcError(f"no WARC record at byte {member.offset}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        length = int(headers.get("content-length", "-1"))
        parts, left, sha = [], length, hashlib.sha256()
        while left > 0 and (piece := member.read(min(left, CHUNK))):
            sha.update(piece)
            left -= len(piece)
            if keep:
                parts.append(piece)
        end = b""
        while len(end) <= 4 and (piece := member.read(5)):
            end += piece
        if length < 0 or left or end != b"\r\n\r\n":
            raise WarcError(f"the record at byte {member.offset} doesn't hold the {length} bytes that it states")
        wanted = {headers.get("warc-block-digest")}
        if headers.get("warc-type") == "response":
            wanted.add(headers.get("warc-payload-digest"))
        if wanted - {None, f"sha256:{sha.hexdigest()}"}:
            raise WarcError(f"the record at byte {member.offset} has another digest than it states")
        yield Record(headers, b"".join(parts), length, sha.hexdigest(), member.offset)


def _packed(target: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for page_id, url, html, digest, n, kind, refers_to in zip(*(batch.column(c) for c in _COLUMNS)):
                payload = (html.as_py() or "").encode()
                if not out:
                    out.append(write_info())
                out.append(write_record(page_id.as_py(), url.as_py(), payload, kind.as_py(), refers_to.as_py(), digest.as_py(), n.as_py()))
                size += len(payload)
                if size >= target:
                    yield pa.record_batch({"archive": pa.array([b"".join(out)], pa.binary())})
                    out, size = [], 0
        if out:
            yield pa.record_batch({"archive": pa.array([b"".join(out)], pa.binary())})

    return run


def with_record_types(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html, digest, n, record_type, refers_to: which page of each payload keeps it.

    The smallest page_id of each repeated payload comes from an aggregation that combines before it moves digests.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    p = p.withColumn("payload", F.coalesce("html", F.lit("")))
    p = p.select("page_id", "url", "html", F.sha2(F.col("payload").cast("binary"), 256).alias("digest"), F.octet_length("payload").cast("long").alias("n"))
    firsts = p.filter(F.col("n") >= least).groupBy("digest").agg(F.count("*").alias("copies"), F.min("page_id").alias("first"))
    firsts = settled(firsts.filter("copies > 1").select(F.col("digest").alias("copied"), "first"), "payloads")
    joined = p.join(F.broadcast(firsts) if firsts.count() <= BROADCAST_DIGESTS else firsts, p["digest"] == F.col("copied"), "left")
    revisit = F.col("copied").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", "digest", "n", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes the pages as archives below a path that Spark can write."""
    records = with_record_types(pages, least)
    archives = records.mapInArrow(lean(_packed(archive_bytes)), "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", _EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for content in batch.column(0):
            rows: list[tuple] = []
            for r in read_records(io.BytesIO(content.as_buffer()), keep=False):
                kind = r.headers.get("warc-type")
                if kind in ("response", "revisit"):
                    n = r.length if kind == "response" else int(r.headers["x-payload-length"])
                    digest = r.digest if kind == "response" else r.headers["warc-payload-digest"].removeprefix("sha256:")
                    rows.append((r.page_id, n, digest, kind, r.refers_to))
                if len(rows) == ROWS:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below a path; see RECORD."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(lean(_unpacked), RECORD)


def broken_revisits(records: DataFrame) -> DataFrame:
    """refers_to, payload_bytes, payload_digest: what revisits state of responses that aren't there or differ."""
    at = ["page_id", "payload_bytes", "payload_digest"]
    stated = records.filter("record_type = 'revisit'").select(F.col("refers_to").alias("page_id"), *at[1:]).distinct()
    return stated.join(records.filter("record_type = 'response'").select(*at), at, "left_anti").withColumnRenamed("page_id", "refers_to")


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Writes the pages as archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(pages, path, least)
    return read_archives(spark, path)
