"""WARC archives compressed with Zstandard and a dictionary: writing and reading.

An archive begins with a skippable frame that holds the dictionary, then has one frame per record.
Records with a payload that an earlier one has are revisit records: the first is the one with the
smallest page_id. Archives are the ``archive`` cells of a table, as Spark has no other sink for
bytes that executors can write; ``read_archives`` takes such cells, or files that
``spark.read.format("binaryFile")`` has read, also those of others: HTTP messages with the digest of
their body, digests of any common kind, headers in any case. It is linear in the archive's size, and
every fault is a ``BadArchive``. Of a revisit that gives no payload length, that is NULL.

The dictionary is trained on at most ``SAMPLE_PAGES`` whole payloads of at most ``SAMPLE_BYTES``
each, those with the smallest hash of their page_id; it only affects sizes.

Edge cases: a NULL html is an empty payload; a NULL url gives no target URI; rows without a
page_id are records too, never the first of their payload if another is; rows that share one
compare equal, and only one of them is the response. An empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from datetime import datetime, timezone
from uuid import UUID

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.sizes import fits_broadcast
from martloom.llm.common import salted_join
from martloom.sinks.scratch import staged

ARCHIVE_BYTES = 8 << 20
SAMPLE_PAGES = 512
SAMPLE_BYTES = 16 << 10
DICTIONARY_BYTES = 32 << 10
# Bytes of an archive that a frame is first offered, and at most at once.
FIRST_STEP, LAST_STEP = 4 << 10, 256 << 10

# Magic numbers of a dictionary's skippable frame and of a Zstandard frame, the
# profile of revisit records, and the digests that records may have.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGESTS = ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")
WRITTEN = datetime(2024, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


class BadArchive(ValueError):
    """An archive that breaks the format."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: dict) -> bytes:
    """One WARC record. ``page``: page_id, row, url, payload, first (the response's page_id) and
    response (whether it is one)."""
    payload = page["payload"]
    digest = payload_digest(payload)
    block = payload if page["response"] else b""
    headers = {
        "WARC-Type": "response" if page["response"] else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{UUID(int=page['row'])}>",
        "WARC-Date": WRITTEN,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{payload_digest(block)}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "text/html",
        "Content-Length": str(len(block)),
    }
    if page["page_id"] is not None:
        headers["X-Page-ID"] = str(page["page_id"])
    if page["url"]:
        headers["WARC-Target-URI"] = "".join(page["url"].splitlines())
    if not page["response"]:
        headers["WARC-Profile"] = REVISIT
        if page["first"] is not None:
            headers["X-Refers-To-Page-ID"] = str(page["first"])
    head = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and block of one record; ``BadArchive`` if any of it is not as
    it says. Names are compared without case, the space after a colon may lack."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode(errors="replace").split("\r\n")
    if not found or first not in ("WARC/1.0", "WARC/1.1"):
        raise BadArchive("no WARC record")
    headers = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise BadArchive(f"a line that is no header: {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    for name in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"):
        if name.lower() not in headers:
            raise BadArchive(f"a record without {name}")
    length = number(headers, "Content-Length")
    block = rest[:length]
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadArchive("a record whose length is not its Content-Length")
    if not has_digest(block, headers.get("warc-block-digest", "")):
        raise BadArchive("a block that does not have its digest")
    if headers["warc-type"] == "response":
        if not has_digest(payload_of(headers, block), headers.get("warc-payload-digest", "")):
            raise BadArchive("a payload that does not have its digest")
    return headers, block


def number(headers: dict[str, str], name: str) -> int | None:
    """A header's whole number; None without the header."""
    text = headers.get(name.lower())
    if text is None:
        return None
    if not text.removeprefix("-").isascii() or not text.removeprefix("-").isdigit():
        raise BadArchive(f"{name} is no number: {text[:80]!r}")
    return int(text)


def has_digest(data: bytes, said: str) -> bool:
    """Whether data has the digest that a header says, as base 32 or hexadecimal; a digest that is
    not given, or of a kind that is not known here, cannot be wrong."""
    kind, _, value = said.partition(":")
    if not value or kind.lower() not in DIGESTS:
        return True
    digest = hashlib.new(kind.lower(), data).digest()
    value = value.lower().rstrip("=")
    return value in (digest.hex(), base64.b32encode(digest).decode().lower().rstrip("="))


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block, or of an HTTP message its body."""
    kind = headers.get("content-type", "").partition(";")[0].strip().lower()
    if kind != "application/http":
        return block
    _, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise BadArchive("an HTTP message without an end of its head")
    return body


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def split_archive(archive: bytes) -> tuple[zstandard.ZstdDecompressor, memoryview]:
    """A decompressor with the leading dictionary, and the frames after it."""
    view = memoryview(archive)
    if len(view) < 8 or struct.unpack_from("<I", view)[0] != DICTIONARY_FRAME:
        return zstandard.ZstdDecompressor(), view
    length = struct.unpack_from("<I", view, 4)[0]
    if len(view) < 8 + length:
        raise BadArchive("a dictionary frame that is cut off")
    held = bytes(view[8 : 8 + length])
    try:
        if held[:4] == struct.pack("<I", ZSTD_FRAME):
            held = zstandard.ZstdDecompressor().decompress(held)
        if not held:
            return zstandard.ZstdDecompressor(), view[8:]
        reader = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(held))
    except zstandard.ZstdError as error:
        raise BadArchive(f"a dictionary that cannot be read: {error}") from error
    return reader, view[8 + length :]


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Each record of an archive, one frame at a time."""
    reader, rest = split_archive(archive)
    at = 0
    while at < len(rest):
        if len(rest) < at + 4 or struct.unpack_from("<I", rest, at)[0] != ZSTD_FRAME:
            raise BadArchive("something that is no Zstandard frame")
        frame = reader.decompressobj()
        parts, step = [], FIRST_STEP
        while not frame.eof:  # in growing steps, as what a step reads too much is copied
            if at >= len(rest):
                raise BadArchive("a frame that is cut off")
            taken = rest[at : at + step]
            try:
                parts.append(frame.decompress(taken))
            except zstandard.ZstdError as error:
                raise BadArchive(f"a frame that cannot be read: {error}") from error
            at += len(taken)
            step = min(2 * step, LAST_STEP)
        at -= len(frame.unused_data)
        yield parsed(b"".join(parts))


def trained(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample; empty if there is too little to train on.

    The sample is chosen by numbers alone, so tasks send no page that is not used.
    """
    size = F.octet_length("html")
    rows = pages.where((size > 0) & (size <= SAMPLE_BYTES)).select(
        "html", F.xxhash64("page_id", "html").alias("drawn")
    )
    last = rows.select("drawn").orderBy("drawn").limit(SAMPLE_PAGES).agg(F.max("drawn")).first()[0]
    if last is None:
        return b""
    chosen = rows.where(F.col("drawn") <= last).groupBy("drawn").agg(F.min("html").alias("html"))
    texts = [row.html.encode() for row in sorted(chosen.collect())]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def marked(pages: DataFrame) -> DataFrame:
    """``page_id, row, url, html, first, response``: which records are responses.

    Rows are numbered once and written with their texts, as a second read may number them anew.
    Payloads are compared by SHA-256 and length. Copies are counted where they are read, and only
    payloads that occur more than once are joined back, each dealt over several keys.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.monotonically_increasing_id().alias("row"),
        "url",
        "html",
        F.sha2(payload, 256).alias("same"),
        F.octet_length(payload).alias("length"),
    )
    rows = staged(rows, "warc-pages")
    keyed = rows.select("page_id", "row", "same", "length")
    order = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("row"))
    firsts = (
        keyed.groupBy("same", "length")
        .agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("same", "length", F.col("least.page_id").alias("first"), "least.row")
        .withColumnRenamed("row", "at")
    )
    found = salted_join(keyed, firsts, ["same", "length"], "inner")
    later = found.where(F.col("row") != F.col("at")).select(F.col("row").alias("revisit"), "first")
    later = staged(later, "warc-revisits")
    later = F.broadcast(later) if fits_broadcast(later) else later
    joined = rows.join(later, F.col("row") == F.col("revisit"), "left")
    return joined.select(
        "page_id", "row", "url", "html", "first", F.col("revisit").isNull().alias("response")
    )


def archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``archive``: each task's records, in archives of about ``archive_bytes``."""
    dictionary = trained(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        frames = zstandard.ZstdCompressor(level=3, dict_data=held)
        start = dictionary_frame(dictionary)
        parts, size = [start], 0
        for batch in batches:
            for page in batch.to_pylist():
                page["payload"] = (page["html"] or "").encode()
                parts.append(frames.compress(record(page)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield _archive(parts)
                    parts, size = [start], 0
        if len(parts) > 1:
            yield _archive(parts)

    return marked(pages).mapInArrow(write, "archive binary")


def _archive(parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["archive"])


def read_archives(files: DataFrame, column: str = "archive") -> DataFrame:
    """A row per record: its headers' values and its payload (NULL for a revisit)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(column):
                rows, size = [], 0
                for headers, block in records(archive.as_py()):
                    rows.append(_row(headers, block))
                    size += len(block)
                    if size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )
    out = (
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long, payload binary"
    )
    return files.select(column).mapInArrow(read, out)


def _row(headers: dict[str, str], block: bytes) -> dict:
    revisit = headers["warc-type"] == "revisit"
    payload = None if revisit else payload_of(headers, block)
    said = headers.get("warc-payload-digest", "")
    return {
        "page_id": number(headers, "X-Page-ID"),
        "url": headers.get("warc-target-uri"),
        "payload_bytes": number(headers, "X-Payload-Length") if revisit else len(payload),
        "payload_digest": said.removeprefix("sha1:") if revisit else payload_digest(payload),
        "record_type": headers["warc-type"],
        "refers_to": number(headers, "X-Refers-To-Page-ID"),
        "payload": payload,
    }


def written(pages: DataFrame) -> DataFrame:
    """Write the archives below the shared folder and read them back as files."""
    return staged(archives(pages), "warc")
