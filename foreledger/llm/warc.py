"""WARC archives with revisit records.

Headers (page, digest, length) are shuffled by payload digest; of equal payloads
of `MIN_REVISIT` bytes or more the one with the smallest page id stays a
response, the others become revisit records that point to it. Each task then
writes one archive, a gzip member per record, with headers made anew.

Null html is an empty payload. A page without an id cannot be pointed to: it is
written as a response and never referred to. Rows that repeat a page id are
written each; one of equal payload refers to the id they share only if a smaller
id does not hold the payload, and stays a response then. Only the columns
page_id, url and html are read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foreledger.llm.common import stored, write_file

MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
# fixed value: the profile of a revisit that has its payload elsewhere
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n"
_RECORDS = "page_id long, record_type string, digest string, payload_bytes long, refers_to long"


def decided(pages: DataFrame) -> DataFrame:
    """page_id, digest, payload_bytes and refers_to of every page, without payloads."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    headers = pages.select(
        F.col("page_id").cast("long"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    # combined in each task before the shuffle, so a digest on many pages is few rows
    first = (
        headers.where(F.col("payload_bytes") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("held"))
        .where("held > 1 AND first_id IS NOT NULL")
        .select("digest", "first_id")
    )
    later = (F.col("page_id") > F.col("first_id")) & F.col("first_id").isNotNull()
    return headers.join(first, "digest", "left").select(
        "page_id",
        "digest",
        "payload_bytes",
        F.when(later, F.col("first_id")).alias("refers_to"),
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def target_uri(url: str | None, page_id: int | None) -> str:
    """The url on one line; a page without one gets a name of its own."""
    return re.sub(r"[\s\x00-\x1f\x7f]", "%20", url) if url else f"urn:page:{page_id}"


def record(page_id, url, html, length: int, digest: str, refers_to) -> bytes:
    """One WARC record, not compressed. A revisit states the payload's length only in its HTTP head."""
    http = _HTTP % length
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target_uri(url, page_id)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if refers_to is None:
        block = http + html.encode()
    else:
        block = http
        head += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    head += [
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def info_record() -> bytes:
    """What the archives of a folder are, as a record of its own."""
    block = b"format: WARC File Format 1.1\r\n"
    head = (
        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id(None, 'info')}\r\n"
        f"WARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\n"
        f"Content-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, per_archive: int = 64 << 20) -> DataFrame:
    """Write the archives of `pages` and return one row per archive: path, records, bytes."""
    # the folder is there and readable without any page, too
    write_file(f"{folder}/info.warc.gz", gzip.compress(info_record(), 3, mtime=0))
    decisions = decided(pages)
    texts = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    ).withColumn("own", F.sha2(F.col("html").cast("binary"), 256))
    # a page id that repeats has one decision for each of its payloads
    each = decisions.select("page_id", "digest", "refers_to").distinct().alias("d")
    joined = texts.alias("t").join(
        each,
        F.col("t.page_id").eqNullSafe(F.col("d.page_id")) & (F.col("t.own") == F.col("d.digest")),
    )
    # a revisit needs no payload: it is not carried further
    slim = joined.select(
        "t.page_id",
        "t.url",
        F.when(F.col("d.refers_to").isNull(), F.col("t.html")).alias("html"),
        F.octet_length("t.html").alias("length"),
        "d.digest",
        "d.refers_to",
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        out, n, part = io.BytesIO(), 0, 0

        def close() -> pa.RecordBatch:
            path = f"{folder}/part-{task:06d}-{part:04d}.warc.gz"
            write_file(path, out.getvalue())
            return pa.RecordBatch.from_pydict(
                {"path": [path], "records": [n], "bytes": [out.tell()]}
            )

        for batch in batches:
            for row in batch.to_pylist():
                out.write(gzip.compress(record(**row), 3, mtime=0))
                n += 1
                if out.tell() >= per_archive:
                    yield close()
                    out, n, part = io.BytesIO(), 0, part + 1
        if n:
            yield close()

    # in order, so that a repeated task makes the very same files
    return slim.sortWithinPartitions("page_id", "digest").mapInArrow(
        write, "path string, records long, bytes long"
    )


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a compressed archive."""
    with gzip.open(io.BytesIO(data)) as stream:
        while line := stream.readline():
            if line.strip() != b"WARC/1.1":
                raise ValueError("not at the start of a record")
            headers = {}
            while (line := stream.readline()).strip():
                name, _, value = line.decode().partition(":")
                headers[name] = value.strip()
            block = stream.read(int(headers["Content-Length"]))
            if stream.read(4) != b"\r\n\r\n":
                raise ValueError("record without its end")
            yield headers, block


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("page_id", "record_type", "digest", "payload_bytes", "refers_to")
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
    for batch in batches:
        for data in batch.column("content"):
            rows = []
            for headers, block in parse(data.as_buffer().to_pybytes()):
                kind = headers["WARC-Type"]
                if kind == "warcinfo":
                    continue
                page = headers["X-Page-ID"]
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                size = None
                if kind == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    size = len(payload)
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of page {page} does not match its digest")
                target = headers.get("X-Refers-To-Page-ID")
                rows.append(
                    (int(page) if page else None, kind, digest, size, int(target) if target else None)
                )
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.record_batch(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=list(names)
            )


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives, revisits resolved to their originals.

    A revisit record has no payload, so its length comes from the response of
    the same digest, which is there once for each digest that is revisited.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.warc.gz")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .load(folder)
    )
    records = files.select("content").mapInArrow(_read, _RECORDS)
    # written, so that the archives are read and unpacked once
    return resolved(stored(records, "warc-records"))


def resolved(records: DataFrame) -> DataFrame:
    lengths = (
        records.where("record_type = 'response'")
        .groupBy("digest")
        .agg(F.max("payload_bytes").alias("original_bytes"))
    )
    return records.join(lengths, "digest", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
