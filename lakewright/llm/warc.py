"""Web archives as Zstandard files: one frame a record, the dictionary in a leading skippable frame.

Pages become WARC/1.1 records.  Of pages with equal payloads of at least 100
bytes the one with the smallest page_id is a response record; the others are
revisit records that name it and carry no payload.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NewFile, open_file, shared_folder, stored

SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
LEAST_BYTES = 100
#: The dictionary is fitted on at most so many pages and bytes of each; every page is archived whole.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 8192, 65536
FILE_SCHEMA = "path string, bytes long, records long"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
CRLF = b"\r\n"


def fit_dictionary(html: Column, pages: DataFrame) -> bytes:
    """A shared dictionary from a bounded sample of payloads; empty if there are none."""
    rows = pages.select(F.substring(F.encode(html, "UTF-8"), 1, SAMPLE_BYTES).alias("x")).filter(F.octet_length("x") > 0).limit(SAMPLE_PAGES).collect()
    samples = [bytes(r["x"]) for r in rows]
    if len(samples) >= 16:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            pass  # samples that have too little in common; taken as they are
    return b"".join(samples)[:DICTIONARY_BYTES]


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """A response record, or a revisit record if ``first`` names the page with the same payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first, digest)}", f"X-Refers-To-Page-Id: {first}"]
    return "\r\n".join(head).encode() + CRLF + CRLF + block + CRLF + CRLF


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = 64 << 20) -> DataFrame:
    """Archive every page; returns (path, bytes, records) of the files, each of about ``file_bytes`` at most.

    A null html is an empty payload.  A null page_id never refers or is
    referred to.  Repeated rows of the referred page are responses too.  Files
    are named by task attempt and only those of finished tasks are listed.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    dictionary = fit_dictionary(html, pages)
    digest = F.sha2(F.encode(html, "UTF-8"), 256)
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), digest.alias("digest"), F.octet_length(html).alias("size"))
    heads = slim.filter((F.col("size") >= LEAST_BYTES) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    whole = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), digest.alias("digest"))
    marked = whole.join(stored(heads, f"{folder}/heads"), "digest", "left").select("page_id", "url", "html", "digest", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, out, done = TaskContext.get(), 0, None, []
        kind = zstandard.DICT_TYPE_AUTO
        shared = zstandard.ZstdCompressionDict(dictionary, dict_type=kind) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True, write_checksum=True)

        def close() -> None:
            if out:
                out.close()
                done.append((path, size, records))

        for batch in batches:
            for page_id, url, page, sha, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or size >= file_bytes:
                    close()
                    path, size, records, number = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{number}.warc.zst", 0, 0, number + 1
                    out = NewFile(path)
                    if dictionary:
                        body = zstandard.ZstdCompressor(level=19).compress(dictionary)
                        out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
                frame = compressor.compress(record(page_id, url, page.encode("utf-8", "replace"), sha, first, date))
                out.write(frame)
                size, records = size + len(frame), records + 1
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["path", "bytes", "records"])

    return stored(marked.mapInArrow(run, FILE_SCHEMA), f"{folder}/files")


def frames(source) -> Iterator[bytes]:
    """The decompressed frames of an archive, read block by block with its own dictionary."""
    head = source.read(8)
    shared = None
    held = head
    if len(head) == 8 and struct.unpack("<II", head)[0] == SKIPPABLE:
        size = struct.unpack("<II", head)[1]
        body = source.read(size)
        if len(body) != size:
            raise ValueError("the dictionary frame is cut short")
        if body[:4] == b"\x28\xb5\x2f\xfd":
            body = zstandard.ZstdDecompressor().decompress(body)
        shared, held = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_AUTO), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=shared)
    while True:
        held = held or source.read(1 << 20)
        if not held:
            return
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            parts.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else source.read(1 << 20)
            if not frame.eof and not held:
                raise ValueError("the last frame is cut short")
        yield b"".join(parts)


def parse(frame: bytes) -> dict:
    """One record, with its headers, lengths and digest checked."""
    head, gap, rest = frame.partition(CRLF + CRLF)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if not gap or not version.startswith("WARC/1.") or not {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= fields.keys():
        raise ValueError("no WARC header")
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != CRLF * 2:
        raise ValueError(f"{fields['WARC-Record-ID']}: the block has not {length} bytes")
    http, gap, payload = rest[:length].partition(CRLF + CRLF)
    sizes = [line[16:] for line in http.decode().split("\r\n") if line.startswith("Content-Length: ")]
    if not gap or len(sizes) != 1:
        raise ValueError(f"{fields['WARC-Record-ID']}: no HTTP header")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != int(sizes[0]) or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not the one that was archived")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-Id"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(sizes[0]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("X-Refers-To-Page-Id"),
        "payload": payload if kind == "response" else None,
    }


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the listed files (path, bytes, records); a file with another number of records fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds, strict=True)], names=names)

        for files in batches:
            for path, expected in zip(files.column(0).to_pylist(), files.column(1).to_pylist(), strict=True):
                rows, seen, held = [], 0, 0
                with open_file(path) as source:
                    for frame in frames(source):
                        row = parse(frame)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        seen, held = seen + 1, held + len(row["payload"] or b"")
                        if len(rows) == 1000 or held > 8 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if seen != expected:
                    raise ValueError(f"{path} has {seen} records, not {expected}")
                if rows:
                    yield batch(rows)

    tasks = max(1, files.count())
    return files.select("path", "records").repartition(tasks, "path").mapInArrow(run, RECORD_SCHEMA)


def archived(pages: DataFrame) -> DataFrame:
    """Archive all pages and read the records back, without their payloads.  No pages: no rows."""
    return read_archives(write_archives(pages, shared_folder(pages.sparkSession, "warc")), payloads=False).drop("payload")


SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
h AS (SELECT payload_digest, min(page_id) AS head FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN head <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN head <> page_id THEN head END AS refers_to
FROM p LEFT JOIN h USING (payload_digest)
"""
