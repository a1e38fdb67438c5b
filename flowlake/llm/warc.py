"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames. After the frames of a bundle come an
index in a skippable frame, which maps record ids to frames and offsets inside them, and the
seek table of the seekable format in another. Any Zstandard tool reads a bundle as one WARC
file; with the two tables a record costs the decompression of one frame.

Of records with equal payloads the one with the smallest id is written as a response, the
others as revisits that refer to it. Bundles are written by Spark's text writer, one row a file,
so that its commit protocol covers lost tasks; the magic number that ends a bundle is the line
separator. They go to any store Spark writes to and are read back as binary files.

Defined results: null and empty payloads have no bytes; payloads under ``least`` bytes are
always responses; so are rows with a null id, whose record id is ``urn:page:none``, and all rows
that share the smallest id; a null URL leaves its header out; line breaks in a URL are escaped.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.config import shared_folder
from flowlake.llm.common import text_bytes

# Fixed values of the seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
MAGIC_TEXT = struct.pack("<I", SEEKABLE_MAGIC).decode("iso-8859-1")

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = np.dtype([("id", "<i8"), ("frame", "<u4"), ("offset", "<u8"), ("length", "<u8")])
NO_ID = -(1 << 63)


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, digest: str, payload: bytes, length: int,
           refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP head but no payload."""
    head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {length}\r\n\r\n").encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        escaped = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") \
            if "\r" in url or "\n" in url else url
        lines.append(f"WARC-Target-URI: {escaped}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {urn(refers_to)}"]
    lines += ["Content-Type: application/http;msgtype=response",
              f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "replace") + block + b"\r\n\r\n"


class Bundle:
    """Collects records into frames; ``finish`` gives the file without its last four bytes."""

    def __init__(self, level: int = 3):
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.entries: list[tuple[int, int, int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes, self.bytes = 0, 0

    def add(self, page_id: int | None, data: bytes) -> None:
        self.entries.append((NO_ID if page_id is None else page_id, len(self.frames),
                             self.open_bytes, len(data)))
        self.open.append(data)
        self.open_bytes += len(data)
        self.bytes += len(data)
        if self.open_bytes >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            frame = self.compressor.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.open_bytes))
            self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        self.close_frame()
        entries = np.array(self.entries, INDEX).tobytes()
        index = struct.pack("<II", SKIPPABLE_INDEX, len(entries)) + entries
        table = b"".join(struct.pack("<II", *s) for s in [*self.sizes, (len(index), 0)])
        footer = struct.pack("<IB", len(self.sizes) + 1, 0)
        seek = struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(footer) + 4)
        return b"".join([*self.frames, index, seek, table, footer])


class SeekableReader:
    """Reads single records of a bundle through its seek table and index."""

    def __init__(self, data: bytes):
        frames, descriptor, magic = struct.unpack("<IBI", data[-9:])
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a seekable bundle")
        width = 12 if descriptor & 0x80 else 8
        at = len(data) - 9 - frames * width
        sizes = [struct.unpack_from("<II", data, at + i * width) for i in range(frames)]
        self.data = memoryview(data)
        self.starts = np.cumsum([0, *(c for c, _ in sizes)]).tolist()
        start, end = self.starts[-2:]
        self.entries = np.frombuffer(self.data[start + 8:end], INDEX)
        self.decompressor = zstandard.ZstdDecompressor()
        self.held: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        if self.held[0] != number:
            part = self.data[self.starts[number]:self.starts[number + 1]]
            self.held = (number, self.decompressor.decompress(part))
        return self.held[1]

    def records(self) -> Iterator[bytes]:
        for _, number, offset, length in self.entries.tolist():
            yield self.frame(number)[offset:offset + length]

    def find(self, page_id: int | None) -> list[bytes]:
        """The records of one id, from the frames that hold them alone."""
        wanted = NO_ID if page_id is None else page_id
        return [self.frame(n)[o:o + size] for i, n, o, size in self.entries.tolist()
                if i == wanted]


def headers(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header lines and what follows them."""
    head, _, rest = block.partition(b"\r\n\r\n")
    pairs = (line.partition(": ") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k: v for k, _, v in pairs}, rest


def parsed(data: bytes) -> dict:
    """Type, ids, payload length and digest of a record; a response's are recomputed."""
    fields, rest = headers(data)
    block = rest[:int(fields["Content-Length"])]
    http, payload = headers(block)
    length, digest = int(http["Content-Length"]), fields["WARC-Payload-Digest"].partition(":")[2]
    if fields["WARC-Type"] == "response":
        if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    number = fields["WARC-Record-ID"][len("<urn:page:"):-1]
    refers = fields.get("WARC-Refers-To")
    return {"page_id": number, "payload_bytes": length, "payload_digest": digest,
            "record_type": fields["WARC-Type"],
            "refers_to": refers and refers[len("<urn:page:"):-1]}


def deduplicated(pages: DataFrame, least: int) -> DataFrame:
    """``page_id, url, payload, bytes, digest, refers_to`` of each page."""
    rows = (pages.select("page_id", "url", text_bytes("html").alias("payload"))
            .withColumns({"digest": F.sha2("payload", 256),
                          "bytes": F.octet_length("payload").cast("long")}))
    firsts = (rows.where(F.col("bytes") >= least).groupBy("digest")
              .agg(F.min("page_id").alias("first")))
    refers = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    return (rows.join(firsts, "digest", "left").withColumn("refers_to", refers)
            .select("page_id", "url", "bytes", "digest", "refers_to",
                    F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload")))


def write_bundles(pages: DataFrame, path: str, least: int = 100,
                  bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Writes a record per page to bundles of about ``bundle_bytes`` below ``path``."""

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = Bundle()
        for batch in batches:
            for no_id, key, url, size, digest, revisit, first, payload in batch.itertuples(
                    index=False):
                page_id = None if no_id else int(key)
                current.add(page_id, record(page_id, url, digest, payload, size,
                                            int(first) if revisit else None))
                if current.bytes >= bundle_bytes:
                    yield pd.DataFrame({"bundle": [current.finish()]})
                    current = Bundle()
        if current.entries:
            yield pd.DataFrame({"bundle": [current.finish()]})

    rows = deduplicated(pages, least).select(
        F.col("page_id").isNull().alias("no_id"),
        F.coalesce("page_id", F.lit(0)).cast("long").alias("key"), "url", "bytes", "digest",
        F.col("refers_to").isNotNull().alias("revisit"),
        F.coalesce("refers_to", F.lit(0)).cast("long").alias("first"),
        F.coalesce("payload", F.lit(b"")).alias("payload"))
    (rows.mapInPandas(bundle, "bundle binary")
     .select(F.col("bundle").cast("string").alias("value"))
     .write.option("lineSep", MAGIC_TEXT).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", 1).text(path))


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of all records."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                if len(data):
                    yield pd.DataFrame([parsed(r) for r in SeekableReader(bytes(data)).records()])

    found = files.mapInPandas(read, "page_id string, payload_bytes long, payload_digest string, "
                                    "record_type string, refers_to string")
    number = F.when(F.col("page_id") != "none", F.col("page_id")).cast("long")
    return found.withColumns({"page_id": number, "refers_to": F.col("refers_to").cast("long")})


def archived(pages: DataFrame, least: int = 100) -> DataFrame:
    """Pages written to bundles in the shared folder and read back."""
    path = shared_folder(pages.sparkSession, "llm-warc")
    write_bundles(pages, path, least)
    return read_bundles(pages.sparkSession, path)
