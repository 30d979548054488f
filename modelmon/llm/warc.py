"""WARC archives with a dictionary: records compressed one by one, the dictionary in a skippable frame in front.

An archive file is: a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary built from the archive's own
records, then one Zstandard frame per record that needs it. Spark's text sink writes the bytes; its line separator is an
empty skippable frame, so a file is nothing but frames and any reader of this layout skips the separators.

Records with equal payloads: the one with the smallest page_id is a response, the others are revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from modelmon.llm.common import arrow_rows, fixed, folder

# Payloads of fewer bytes are always responses.
LEAST_BYTES = 0
DICTIONARY_MAGIC = 0x184D2A5D
# An empty skippable frame: magic 0x184D2A50, length 0.
SEPARATOR = "P*M\x18\0\0\0\0"
DICTIONARY_BYTES = 16_384
# Bytes of an archive's first records the dictionary is built from: a hundred times its size.
SAMPLE_BYTES = 100 * DICTIONARY_BYTES
LEVEL = 3
DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_CHUNK = 16_384


def base32_digest(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record of an HTTP response; a revisit keeps the HTTP header and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of at most DICTIONARY_BYTES from some records; too few of them give their own bytes as raw content."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=200, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The dictionary frame and then a frame per record. Records are held back only until the dictionary is built."""
    held, size, compress = [], 0, None

    def begin() -> tuple[bytes, zstandard.ZstdCompressor]:
        content = _dictionary(held)
        data = zstandard.ZstdCompressionDict(content)
        data.precompute_compress(level=LEVEL)
        return struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content, zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True)

    for r in records:
        if compress is not None:
            yield compress.compress(r)
            continue
        held.append(r)
        size += len(r)
        if size >= SAMPLE_BYTES:
            head, compress = begin()
            yield head
            yield from map(compress.compress, held)
            held = []
    if compress is None and held:
        head, compress = begin()
        yield head
        yield from map(compress.compress, held)


def records(archive: memoryview) -> Iterator[bytes]:
    """The records of an archive file, decompressed one by one."""
    at, decompress = 0, zstandard.ZstdDecompressor()
    while at < len(archive):
        magic, size = struct.unpack_from("<II", archive, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if magic == DICTIONARY_MAGIC:
                content = bytes(archive[at + 8 : at + 8 + size])
                decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            at += 8 + size
            continue
        stream, out = decompress.decompressobj(), []
        while not stream.eof:
            piece = archive[at : at + READ_CHUNK]
            if not len(piece):
                raise ValueError("the archive is cut off")
            out.append(stream.decompress(piece))
            at += len(piece)
        at -= len(stream.unused_data)
        yield b"".join(out)


def fields(content: bytes) -> dict[str, str | bytes]:
    """The header fields of a record, with its HTTP length as "bytes" and its block after the HTTP header as "payload"."""
    head, _, block = content.partition(b"\r\n\r\n")
    out: dict[str, str | bytes] = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(out["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(line for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    return out | {"bytes": length.split(b":")[1].decode().strip(), "payload": payload}


def _page_number(field: str | bytes | None) -> int | None:
    digits = str(field or "")[len("<urn:page:") : -1]
    return int(digits) if digits else None


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write (page_id, url, html) as archives under ``path``: one file per partition of the table, no shuffle of pages."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    source = source.withColumn("sha1", F.sha1("payload"))
    # Only digests that stand twice or more go back to the pages; sums are combined before the shuffle.
    counted = source.select("page_id", "sha1", F.octet_length("payload").alias("size")).where(F.col("size") >= least_bytes)
    first = fixed(counted.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n"), "copied")
    joined = source.join(first, "sha1", "left").select(
        "page_id", "url", "payload", "sha1",
        F.when((F.octet_length("payload") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[bytes]:
            for batch in batches:
                for page_id, url, payload, sha1, refers_to in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                    yield record(page_id, url, payload, base32_digest(sha1), refers_to)

        some, size = [], 0
        for f in frames(each()):
            some.append(f)
            size += len(f)
            if size >= SAMPLE_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["frame"])
                some, size = [], 0
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["frame"])

    out = joined.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    with arrow_rows(spark):
        out.write.option("lineSep", SEPARATOR).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record of the archives under ``path``.

    A response's digest and length are those of the payload as read, and a record that disagrees with them fails the job;
    a revisit's come from its headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for r in records(memoryview(content.as_buffer())):
                    f = fields(r)
                    kind, digest, size = f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha1:"), int(f["bytes"])
                    if kind == "response":
                        found = base32_digest(hashlib.sha1(f["payload"]).hexdigest())
                        if (found, len(f["payload"])) != (digest, size):
                            raise ValueError(f"record {f['WARC-Record-ID']} does not hold its payload")
                    rows.append((_page_number(f["WARC-Record-ID"]), size, digest, kind, _page_number(f.get("WARC-Refers-To"))))
                if rows:
                    columns = list(zip(*rows))
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)],
                        names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                    )

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return fixed(spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema), "records", rows=1)


def archive(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in the shared folder and read them back, one row per page.

    Null and empty pages have an empty payload, equal to any other. Rows that repeat a response's page_id and payload are
    responses too. A null page_id is never the smallest; equal payloads without any page_id are all responses. An empty
    table gives an empty one; further columns are ignored.
    """
    path = folder(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes)
    return read_archives(pages.sparkSession, path)
