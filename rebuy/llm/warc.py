"""Legacy ARC archives and their conversion to WARC.

Archives are written and read through Spark's own sinks and sources (text with
a record separator, binaryFile), so they can lie in any store Spark reaches.
ARC files open with a version block; version 1 header lines have five fields,
version 2 lines ten, and both end with the length of the document that
follows, which alone says where the next record starts. The converter gives
each document a WARC record: an id made from its place in the archive, the
date in ISO form, a type from its scheme, and SHA-1 digests of payload and
block. Of equal payloads one record stays a response; the others become
revisits that refer to it and hold the HTTP header only.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, shared, written

#: Field names of the two versions' header lines (fixed values).
V1 = "URL IP-address Archive-date Content-type Archive-length"
V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive is kept near this size, as a task reads it whole.
ARCHIVE_BYTES = 64 << 20
PAGE_HEADER = "X-Page-Id"


def digest(data: bytes) -> str:
    """Base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def http_block(payload: bytes, page_id: int | None) -> bytes:
    """The HTTP response that an archive keeps of a page."""
    own = f"{PAGE_HEADER}: {page_id}\r\n" if page_id is not None else ""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "20000101000000") -> None:
    """Write one ARC record a row, gzipped, in versions 1 and 2 by turns of
    the files. A null page is an empty payload, a null URL ``unknown:``;
    characters that would break a header line are percent-encoded."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    total = rows.agg(F.sum(F.octet_length("html")).alias("n")).first()["n"] or 0
    if total > ARCHIVE_BYTES * max(1, rows.rdd.getNumPartitions()):
        rows = rows.repartition(-(-total // ARCHIVE_BYTES))
    rows = rows.withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            for piece in pieces(batch, "html"):
                out = []
                for page_id, url, html, part in zip(*(piece.column(i).to_pylist() for i in range(4))):
                    v2, name = part % 2 == 1, f"pages-{part:05d}.arc.gz"
                    if at is None:
                        version = f"{2 if v2 else 1} 0 rebuy\n{V2 if v2 else V1}\n".encode()
                        more = f"200 - - 0 {name} " if v2 else ""
                        out.append(f"filedesc://{name} 0.0.0.0 {date} text/plain {more}{len(version)}\n".encode() + version)
                        at = len(out[0]) + 1
                    block = http_block((html or "").encode(), page_id)
                    more = f"200 - - {at} {name} " if v2 else ""
                    uri = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "unknown:"
                    out.append(f"{uri} 0.0.0.0 {date} text/html {more}{len(block)}\n".encode() + block)
                    at += len(out[-1]) + 1
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def unpacked(data: bytes) -> bytes:
    """Bytes of a plain file or of all members of a gzip file."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        z = zlib.decompressobj(31)
        out.append(z.decompress(data))
        data = z.unused_data
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[tuple[int, dict, bytes]]:
    """Offset, header fields and document of each record after the version
    block. A line that is no header of the file's version is skipped, so
    damaged records cost no others; a document cut off by the end of the file
    is left out."""
    fields, at = V1.split(" "), 0
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].rstrip(b"\r")
        if line.startswith(b"filedesc://"):
            length, start = int(line.rsplit(b" ", 1)[-1]), end + 1
            block = data[start:start + length]
            fields = (V2 if block[:2] == b"2 " else V1).split(" ")
            at = start + length
            continue
        own = line.decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
        if len(own) != len(fields) or not own[-1].isdigit() or not re.fullmatch(r"\d{12}(\d\d)?", own[2]):
            at = end + 1
            continue
        start, length = end + 1, int(own[-1])
        if start + length > len(data):
            return
        yield at, dict(zip(fields, own)), data[start:start + length]
        at = start + length


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its blank line) and payload of a block; a block
    that is no HTTP message is all payload."""
    end = block.find(b"\r\n\r\n")
    return (block[:end + 4], block[end + 4:]) if block[:5] == b"HTTP/" and end >= 0 else (b"", block)


def _page_id(header: bytes) -> int | None:
    m = re.search(rf"\r\n{PAGE_HEADER}: (-?\d+)\r\n".encode(), header)
    return int(m[1]) if m else None


RECORD = "record_id string, page_id long, uri string, date string, ip string, digest string, bytes long"


def convert(spark, path: str, payload: bool = True) -> DataFrame:
    """WARC fields of each ARC document under ``path`` (``RECORD``) and, with
    ``payload``, its ``header`` and ``payload``."""
    files = spark.read.format("binaryFile").load(path).where(F.col("path").rlike(r"part-[^/]*$")).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    schema = T._parse_datatype_string(RECORD + (", header binary, payload binary" if payload else ""))

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                out, size = [], 0
                for at, h, block in parse_arc(unpacked(content.as_py())):
                    header, body = split_http(block)
                    d = h["Archive-date"].ljust(14, "0")
                    iso = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"
                    # The file name without the part of it that a retried write changes.
                    place = f"{re.match(r'part-\d+', name)[0]} {at} {h['URL']}"
                    row = [f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}", _page_id(header), h["URL"], iso, h["IP-address"], digest(body), len(body)]
                    out.append(row + ([header, body] if payload else []))
                    size += len(block) * payload + 100
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema.names)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema.names)

    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
    return files.mapInArrow(run, schema)


def arc_to_warc(spark, arc_path: str, warc_path: str, min_bytes: int = 0) -> None:
    """Convert the ARC files of a folder to gzipped WARC files. Of records
    with equal payloads of at least ``min_bytes`` bytes that with the largest
    page id (then record id; null ids are smallest) is the response, the
    others are revisits of it."""
    order = F.struct("page_id", "record_id")
    best = (convert(spark, arc_path, payload=False).where(F.col("bytes") >= min_bytes)
            .groupBy("digest").agg(F.max(order).alias("best")).select(F.col("digest").alias("_d"), F.col("best.record_id").alias("best")))
    rows = convert(spark, arc_path).join(best, F.col("digest") == F.col("_d"), "left").select(
        *[x.split(" ")[0] for x in RECORD.split(", ")], "header", "payload",
        F.when(F.col("best") != F.col("record_id"), F.col("best")).alias("refers_to"))

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "payload"):
                out = []
                for record_id, _, uri, date, ip, sha, _, header, body, refers_to in zip(*(c.to_pylist() for c in piece.columns)):
                    block = header if refers_to else header + body
                    http = header[:5] == b"HTTP/"
                    head = [f"WARC/1.1\r\nWARC-Type: {('revisit' if refers_to else 'response') if http else 'resource'}",
                            f"WARC-Record-ID: <{record_id}>", f"WARC-Target-URI: {uri}", f"WARC-Date: {date}", f"WARC-IP-Address: {ip}",
                            f"WARC-Payload-Digest: sha1:{sha}", f"WARC-Block-Digest: sha1:{digest(block)}",
                            "Content-Type: " + ("application/http; msgtype=response" if http else "application/octet-stream"),
                            f"Content-Length: {len(block)}"]
                    if refers_to:
                        head[5:5] = [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
                    out.append("\r\n".join(head).encode() + b"\r\n\r\n" + block)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(warc_path))


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields (lower case) and block of each record."""
    at = 0
    while data[at:at + 5] == b"WARC/":
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        h = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start, length = end + 4, int(h["content-length"])
        yield h, data[start:start + length]
        at = start + length + 4


def read_warc(spark, path: str) -> DataFrame:
    """Per record: ``record_id``, ``page_id``, ``uri``, ``date``,
    ``payload_bytes``, ``payload_digest``, ``record_type`` and the
    ``refers_to_id`` of revisits. Responses are measured from their bytes and
    must agree with their header; revisits tell their payload by it."""
    files = spark.read.format("binaryFile").load(path).where(F.col("path").rlike(r"part-[^/]*$")).select("content")
    schema = "record_id string, page_id long, uri string, date string, payload_bytes long, payload_digest string, record_type string, refers_to_id string"

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                out = []
                for h, block in parse_warc(unpacked(content.as_py())):
                    header, body = split_http(block)
                    sha, n = h["warc-payload-digest"].removeprefix("sha1:"), len(body)
                    if h["warc-type"] == "revisit":
                        n = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", header)[1])
                    elif sha != digest(body):
                        raise ValueError(f"payload digest of {h['warc-record-id']} does not match its header")
                    out.append((h["warc-record-id"].strip("<>"), _page_id(header), h["warc-target-uri"], h["warc-date"], n, sha,
                                h["warc-type"], h.get("warc-refers-to", "").strip("<>") or None))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                     ["record_id", "page_id", "uri", "date", "payload_bytes", "payload_digest", "record_type", "refers_to_id"])

    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return files.mapInArrow(run, schema)


def round_trip(pages: DataFrame, min_bytes: int = 0, **cols) -> DataFrame:
    """Write ``pages`` as ARC, convert to WARC and read the records back:
    ``read_warc`` with ``refers_to``, the page id of the record a revisit
    refers to. Every row gives one record, also one with nulls in all columns
    or equal to another; no rows give an empty result."""
    spark = pages.sparkSession
    arc, warc = shared(spark, "arc"), shared(spark, "warc")
    write_arc(pages, arc, **cols)
    arc_to_warc(spark, arc, warc, min_bytes)
    rows = written(read_warc(spark, warc), "records")
    named = rows.where("record_type = 'response'").select(F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to"))
    return rows.join(named, F.col("refers_to_id") == F.col("_id"), "left").drop("_id")
