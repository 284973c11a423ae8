"""WARC archives: one gzip member per record, written by Spark and read back in sequence."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaint.llm.batches import column, small_batches
from plaint.session import scratch_dir

# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

RECORDS_PER_FILE = 1_000
# Pages below 256 KB go so many to a file. Longer ones, below so many bytes: a file is of at most
# 256 MB before compression, or one page.
LONGER = ((1 << 22, 64), (1 << 26, 4), (1 << 62, 1))
SHORT_PAGE = 1 << 18
READ_BYTES = 1 << 16
# The last byte of a gzip member is the top byte of its content length: zero below 16 MiB. Spark's
# text writer puts a separator after each value, so that byte is left to it.
SEPARATOR = "\u0000"
SHORT = 1 << 24

PARSED = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
PARSED_DDL = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri)
    return int(found[1]) if found else None


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as one gzip member."""
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in headers)]
    lines.append(b"Content-Length: %d" % len(block))
    return gzip.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n", mtime=0)


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit that names the response and has no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_uri(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~%")))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    if revisit:
        headers.append(("WARC-Profile", REVISIT_PROFILE))
        headers.append(("WARC-Refers-To", record_uri(first)))
    headers.append(("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"))
    return record(headers, block)


def closing_record() -> bytes:
    """A short record after a very long one, so that the file still ends in a zero byte."""
    return record([("WARC-Type", "metadata"), ("WARC-Record-ID", "<urn:page:end>"), ("WARC-Date", DATE)], b"")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            payload = (row["html"] or "").encode()
            revisit = row["page_id"] != row["first"]
            member = page_record(row["page_id"], row["url"], payload, row["first"], revisit)
            if len(payload) + (1 << 16) + 8 * len(row["url"] or "") >= SHORT:
                member += closing_record()
            out.append(member[:-1])
        yield pa.RecordBatch.from_pydict({"member": pa.array(out, pa.binary())})


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record per page. Of pages with equal payloads the smallest page_id is the response
    and the others are revisits of it.

    Null html is an empty payload. A page without an id is a response when no page with an id has
    its payload. Rows with the same smallest id are all responses. Other columns are ignored.

    The reader holds a file at a time, so files are closed by bytes: pages of like sizes are written
    together, fewer of the longer ones to a file. An empty table gives an empty folder.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(html).alias("html"),
        F.sha1(F.coalesce(F.col(html), F.lit("")).cast("binary")).alias("digest"),
    )
    # Counted per task first, so a payload that a third of the pages share is one row per task.
    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first"))
    joined = rows.join(firsts, "digest").select("page_id", "url", "html", "first")
    small_batches(spark)
    size = F.coalesce(F.octet_length("html"), F.lit(0)) + 3 * F.coalesce(F.octet_length("url"), F.lit(0))
    kinds, low = [], 0
    for most, records in ((SHORT_PAGE, RECORDS_PER_FILE), *LONGER):
        kinds.append(((size >= low) & (size < most), records))
        low = most
    found = rows.agg(*[F.count_if(inside).alias(str(k)) for k, (inside, _) in enumerate(kinds)]).first()
    for k, (inside, records) in enumerate(kinds):
        # The first write makes the folder, also for no page at all.
        if found[k] or k == 0:
            members = joined.filter(inside).mapInArrow(_members, "member binary")
            writer = members.select(F.col("member").cast("string").alias("value")).write.mode("append" if k else "error")
            writer.option("lineSep", SEPARATOR).option("maxRecordsPerFile", records).text(path)


def decompressed(content: bytes) -> Iterator[bytes]:
    """The content of each gzip member in turn, decompressed piece by piece."""
    view, at = memoryview(content), 0
    while at < len(view):
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if at >= len(view):
                raise ValueError("the archive ends within a record")
            piece = view[at : at + READ_BYTES]
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        yield b"".join(parts)


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; its length and block digest must hold."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ValueError("not a WARC record")
    headers = dict(line.decode().split(": ", 1) for line in lines[1:])
    length = int(headers["Content-Length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"{headers['WARC-Record-ID']}: the content length does not hold")
    digest = headers.get("WARC-Block-Digest")
    if digest and digest != f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}":
        raise ValueError(f"{headers['WARC-Record-ID']}: the block digest does not hold")
    return headers, block


def page_row(headers: dict[str, str], block: bytes) -> dict:
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
    if headers["WARC-Type"] == "response":
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"{headers['WARC-Record-ID']}: the payload does not match its digest")
    refers = headers.get("WARC-Refers-To")
    return {
        "page_id": page_of(headers["WARC-Record-ID"]),
        "url": headers.get("WARC-Target-URI"),
        "record_type": headers["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": page_of(refers) if refers else None,
        "payload": payload if headers["WARC-Type"] == "response" else None,
    }


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in column(batch, "content"):
            rows, size = [], 0
            for member in decompressed(content.as_py()):
                headers, block = parse(member)
                if headers["WARC-Type"] == "metadata":
                    continue
                rows.append(page_row(headers, block))
                size += len(block)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(rows, schema=PARSED)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=PARSED)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record of all archives in a folder. A damaged record fails the read."""
    small_batches(spark, 4)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_parsed, PARSED_DDL)


def archived(pages: DataFrame) -> DataFrame:
    """Write archives of all pages to the shared folder and read them back."""
    path = scratch_dir(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
