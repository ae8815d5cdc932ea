"""WARC archives of pages: written with a gzip member per record, read back by byte ranges.

Writing: pages with equal payloads of at least ``DEDUP_BYTES`` share a SHA-256 digest; the one with the
smallest ``page_id`` is a response, the others are revisits that name it and keep only its HTTP header.
The first page of a digest is an aggregate with partial sums, joined back to the pages by digest, where
adaptive execution splits a digest that many pages have. Each task writes files of about ``FILE_BYTES``.

Reading: an archive needs no index to be split. Files are cut into byte ranges; a task scans its range
for the magic number of gzip, and takes a place for a record if inflating from there gives a WARC version
line. It owns the records that start inside its range, and reads on past the end to finish the last.
Places inside a record are passed over, as a record's end is known once it is inflated.

Defined cases: a null html is an empty payload; payloads under ``DEDUP_BYTES`` are all responses. Pages
that share the smallest id of a digest are each a response, so repeated rows come back each; a null
``page_id`` is read back as null and is a response unless another page of its digest has an id. A null
url is an empty one. Line breaks in urls are percent-encoded. An empty table writes nothing and has no
rows. Other columns are left aside.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailtide.llm.components import written
from retailtide.llm.files import new_file, opened, tasks_for
from retailtide.session import shared_folder

DEDUP_BYTES = 100
FILE_BYTES = 256 * 1024 * 1024
RANGE_BYTES = 4 * 1024 * 1024
_READ = 1024 * 1024
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1."
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _id_of(name: str) -> int | None:
    digits = name.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record as a gzip member: a response, or a revisit of the page ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if first is not None:
        fields += [("WARC-Refers-To", _name(first)), ("WARC-Profile", _PROFILE)]
    block = http.encode() + (payload if first is None else b"")
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def write(pages: DataFrame) -> DataFrame:
    """Write archives; one row per file: ``file``, ``records`` and ``bytes``."""
    folder = shared_folder(pages.sparkSession, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.sha2(html, 256).alias("digest"),
    )
    firsts = (
        rows.filter(F.octet_length("html") >= DEDUP_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = stream = None
        records = size = 0

        def done() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_pydict({"file": [uri], "records": [records], "bytes": [size]})

        for batch in batches:
            for row in zip(*(batch.column(n) for n in ("page_id", "url", "html", "digest", "first"))):
                page_id, url, text, digest, first = (v.as_py() for v in row)
                if stream is None:
                    uri, stream = new_file(folder, ".warc.gz")
                    records = size = 0
                made = record(page_id, url, text.encode(), digest, None if first == page_id else first)
                stream.write(made)
                records, size = records + 1, size + len(made)
                if size >= FILE_BYTES:
                    yield done()
                    stream = None
        if stream is not None:
            yield done()

    joined = rows.join(firsts, "digest", "left").select("page_id", "url", "html", "digest", "first")
    return written(joined.mapInArrow(archive, "file string, records long, bytes long"), "warc-manifest")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines if line)}


class _Window:
    """A stretch of a file that is read on as it is needed."""

    def __init__(self, file, start: int, size: int):
        self.file, self.start, self.size, self.data = file, start, size, bytearray()

    def until(self, end: int) -> bool:
        """Hold the bytes up to ``end``, or to the end of the file; whether there are more."""
        while self.start + len(self.data) < min(end, self.size):
            more = self.file.read_at(_READ, self.start + len(self.data))
            if not more:
                self.size = self.start + len(self.data)
            self.data += more
        return end <= self.size

    def forget(self, before: int) -> None:
        if before - self.start > _READ:
            del self.data[: before - self.start]
            self.start = before


def _inflate(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The content of the gzip member at ``at`` and its end, if it is a WARC record."""
    unpacker, out, place = zlib.decompressobj(31), io.BytesIO(), at
    while not unpacker.eof:
        window.until(place + 65536)
        chunk = window.data[place - window.start : place - window.start + 65536]
        if not chunk:
            return None
        try:
            out.write(unpacker.decompress(chunk))
        except zlib.error:
            return None
        place += len(chunk)
        if out.tell() >= len(_VERSION) and not out.getbuffer()[: len(_VERSION)] == _VERSION:
            return None
    return (out.getvalue(), place - len(unpacker.unused_data)) if out.getvalue().startswith(_VERSION) else None


def records_in(file, start: int, end: int, size: int) -> Iterator[bytes]:
    """The records that start in ``[start, end)`` of a file, inflated."""
    window, at = _Window(file, start, size), start
    while at < end:
        window.until(at + _READ)
        found = window.data.find(_MAGIC, at - window.start)
        if found < 0:
            held = window.start + len(window.data)
            if held >= window.size:
                return
            at = max(at, held - len(_MAGIC) + 1)
            continue
        at = window.start + found
        if at >= end:
            return
        content = _inflate(window, at)
        if content is None:
            at += 1
            continue
        yield content[0]
        at = content[1]
        window.forget(at)


def parse(content: bytes) -> dict:
    """A record's page, payload and type; a revisit has the digest and length of the full payload."""
    head, _, body = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = body[: int(fields["content-length"])].partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    return {
        "page_id": _id_of(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "record_type": fields["warc-type"],
        "refers_to": _id_of(fields["warc-refers-to"]) if revisit else None,
        "payload": None if revisit else payload,
        "payload_bytes": int(_fields(http)["content-length"]) if revisit else len(payload),
        "payload_digest": fields["warc-payload-digest"].partition(":")[2]
        if revisit
        else hashlib.sha256(payload).hexdigest(),
    }


SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)


def read(files: DataFrame, payloads: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of archives, a row each; ``files`` has ``file`` and its length in ``bytes``."""
    step = F.lit(range_bytes).cast("long")
    ranges = files.filter("bytes > 0").select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, step)).alias("start")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = opened(row["file"])
                end = min(row["bytes"], row["start"] + range_bytes)
                with system.open_input_file(path) as file:
                    held, size = [], 0
                    for content in records_in(file, row["start"], end, row["bytes"]):
                        parsed = parse(content)
                        if not payloads:
                            parsed["payload"] = None
                        held.append(parsed)
                        size += len(parsed["payload"] or b"") + 200
                        if size >= 8_000_000:
                            yield pa.RecordBatch.from_pylist(held, SCHEMA)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, SCHEMA)

    spark_schema = (
        "page_id long, url string, record_type string, refers_to long, payload binary, "
        "payload_bytes long, payload_digest string"
    )
    # Rows of ranges are a few bytes each and would all be read by one task; a number that is given stays.
    n_ranges, size = files.filter("bytes > 0").agg(F.sum(F.ceil(F.col("bytes") / range_bytes)), F.sum("bytes")).first()
    dealt = ranges.repartition(tasks_for(files.sparkSession, n_ranges or 0, size or 0))
    return dealt.mapInArrow(scan, spark_schema)


def listed(spark, pattern: str) -> DataFrame:
    """Archives under a path that Spark can list, ready to ``read``; no content is read here."""
    found = spark.read.format("binaryFile").load(pattern)
    return found.select(F.col("path").alias("file"), F.col("length").alias("bytes"))
