"""Web archives (.warc.zst): writing with a shared dictionary, reading record by record.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the Zstandard
dictionary; then comes one frame for each WARC record, so a record can be read alone.
Equal payloads are stored once: the record with the largest page id is the response,
the others are revisit records that name it and keep the HTTP header block.

The groups of equal payloads are found by a partial aggregation over SHA-1 digests and
joined back by digest (adaptive execution splits a digest that very many pages share).
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, new_folder, saved, steps
from .files import make_folder, put

#: Payloads of fewer bytes are always stored.
REVISIT_BYTES = 1000
#: Record bytes after which an archive is closed.
ARCHIVE_BYTES = 16 << 20
#: Of the dictionary: its size, and the bytes of records it is trained on.
DICTIONARY_BYTES, SAMPLE_BYTES = 16 << 10, 1 << 20
DICTIONARY_MAGIC = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Upper half of the UUIDs that carry a page id in their lower half, and of those without one.
_PAGE, _NO_PAGE = 0x70616765_0000_4000, 0x6E6F7061_0000_4000


def record_id(page_id: int | None, digest: bytes = b"") -> str:
    """A record's URN; the page id can be read from it."""
    low = int.from_bytes(digest[:8].ljust(8, b"\0"), "big") if page_id is None else page_id & (1 << 64) - 1
    return f"<urn:uuid:{uuid.UUID(int=((_NO_PAGE if page_id is None else _PAGE) << 64) | low)}>"


def page_of(record: str) -> int | None:
    n = uuid.UUID(record.removeprefix("<urn:uuid:").removesuffix(">")).int
    if n >> 64 != _PAGE:
        return None
    low = n & (1 << 64) - 1
    return low - (1 << 64) if low >> 63 else low


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """A WARC/1.1 record; digest: hex SHA-1 of the payload."""
    raw = bytes.fromhex(digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, raw)}",
        f"WARC-Date: {date}", f"WARC-Target-URI: {quote(url or 'urn:unknown', safe=_URI)}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{base64.b32encode(raw).decode()}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, raw)}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


_URI = ":/?#[]@!$&'()*+,;=-._~%"


@dataclass
class Record:
    headers: dict[str, str]
    http: bytes
    payload: bytes


def parse_record(data: bytes) -> Record:
    """Check the version line, the mandatory headers, both lengths and the end of a record."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a WARC record")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line: {line[:60]}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"no {name}")
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("block length differs from Content-Length")
    http, found, payload = rest[:size].partition(b"\r\n\r\n")
    return Record(headers, http, payload if found else b"")


def http_length(record: Record) -> int:
    for line in record.http.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    raise ValueError("no HTTP Content-Length")


def train_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """From the first records of an archive; None if they are too few."""
    sample, size = [], 0
    for r in records:
        sample.append(r[:65536])
        size += len(sample[-1])
        if size >= SAMPLE_BYTES:
            break
    if len(sample) < 16 or size < 8 * DICTIONARY_BYTES:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample)
    except zstandard.ZstdError:  # samples that share nothing
        return None


def make_archive(records: list[bytes]) -> bytes:
    dictionary = train_dictionary(records)
    out = []
    if dictionary:
        stored = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
        out += [struct.pack("<II", DICTIONARY_MAGIC, len(stored)), stored]
    packer = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True)
    return b"".join(out + [packer.compress(r) for r in records])


def read_archive(data: bytes | memoryview, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The records of an archive, one frame each."""
    data = memoryview(data)
    at, dictionary = 0, None
    while at + 8 <= len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 != 0x184D2A50:
            break
        if magic == DICTIONARY_MAGIC and at == 0:
            stored = bytes(data[8 : 8 + size])
            if stored[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary may be compressed itself
                stored = zstandard.ZstdDecompressor().decompress(stored)
            dictionary = zstandard.ZstdCompressionDict(stored)
        at += 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("archive ends inside a frame")
            piece = data[at : at + chunk]
            parts.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def verdicts(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """pages (page_id, url, html) with digest, and revisit / refers_to of equal payloads."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.withColumn("digest", F.sha1(payload)).withColumn("large", F.octet_length(F.coalesce("html", F.lit(""))) >= least)
    groups = rows.where("large").groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("copies")).where("copies > 1 and response is not null").select("digest", "response")
    other = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(groups, "digest", "left").select("page_id", "url", "html", "digest", other.alias("revisit"), F.when(other, F.col("response")).alias("refers_to"))


def write_archives(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = ARCHIVE_BYTES, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write a record for every page; gives the folder and a table of its archives.

    A null html is an empty payload, a null url `urn:unknown`.  Pages of one payload that
    share the largest id are responses all; a page without id gets a record without one,
    and is a revisit where its payload has a response.  Partitions are sorted before
    writing, so a task that runs again writes the same archives.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")
    make_folder(folder)
    rows = pages.select(pages[f"`{page_id}`"].cast("long").alias("page_id"), pages[f"`{url}`"].alias("url"), pages[f"`{html}`"].alias("html"))
    rows = verdicts(rows).sortWithinPartitions("page_id", "digest", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, open_, size = TaskContext.get().partitionId(), [], [], 0

        def close() -> None:
            name = f"part-{part:06d}-{len(done):05d}.warc.zst"
            put(f"{folder}/{name}", make_archive(open_))
            done.append((name, len(open_)))

        for batch in batches:
            for step in steps(batch, 2):
                columns = [step.column(i).to_pylist() for i in (0, 1, 3, 4, 5)]
                for page, where, digest, revisit, to, payload in zip(*columns, as_bytes(step.column(2)), strict=True):
                    open_.append(make_record(page, where, payload, digest, to, revisit))
                    size += len(open_[-1])
                    if size >= archive_bytes:
                        close()
                        open_, size = [], 0
        if open_:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], names=["name", "records"])

    return folder, saved(rows.mapInArrow(write, "name string, records long"), "warc-files")


def read_archives(folder: str, spark: SparkSession) -> DataFrame:
    """One row for each record of the archives in a folder; every record is validated.

    payload_bytes and payload_digest (hex SHA-1) are those of the full payload: a
    response's are computed from its payload and must equal its headers, a revisit's
    are those its headers keep of the payload it refers to.
    """
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                rows = []
                for data in read_archive(blob.as_buffer()):
                    r = parse_record(data)
                    kind, size = r.headers["warc-type"], http_length(r)
                    digest = base64.b32decode(r.headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if kind == "response" and (len(r.payload) != size or hashlib.sha1(r.payload).hexdigest() != digest):
                        raise ValueError(f"payload of {r.headers['warc-record-id']} differs from its headers")
                    if kind == "revisit" and r.payload:
                        raise ValueError(f"revisit {r.headers['warc-record-id']} has a payload")
                    to = r.headers.get("warc-refers-to")
                    rows.append((page_of(r.headers["warc-record-id"]), size, digest, kind, page_of(to) if to else None, r.headers.get("warc-target-uri")))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], k) for i, k in enumerate(kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"])

    return stored.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string")


def archive_table(pages: DataFrame, **options) -> DataFrame:
    """Write all pages, then read the archives back."""
    folder, _ = write_archives(pages, **options)
    return read_archives(folder, pages.sparkSession)
