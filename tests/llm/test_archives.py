"""Archives: round trips, revisits, and refusal of what is not as it says."""

from __future__ import annotations

import base64
import hashlib

import pytest
import zstandard

from martloom.llm import archives

ODD = [
    (1, "http://a.example/1", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (3, "http://a.example/3\r\nWARC-Type: other", "é😀\r\n\r\nWARC/1.1\r\n"),
    (4, "http://a.example/4", None),
    (5, "http://a.example/5", ""),
    (None, "http://a.example/none", "<p>same</p>"),
    (None, "http://a.example/none", "<p>alone</p>"),
    (7, "http://a.example/7", "x" * 400_000),
    (8, "http://a.example/8", "<p>twice</p>"),
    (8, "http://a.example/8", "<p>twice</p>"),
]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pages") / "pages.parquet")
    rows = [(*row, "x") for row in ODD]
    spark.createDataFrame(rows, "page_id long, url string, html string, first string").write.parquet(
        folder
    )
    return spark.read.parquet(folder)


@pytest.mark.parametrize("archive_bytes", [1, archives.ARCHIVE_BYTES])
def test_round_trip(pages, archive_bytes):
    found = archives.read_archives(archives.archives(pages, archive_bytes)).collect()
    assert len(found) == len(ODD)
    said = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest) for r in found)
    digest = lambda html: base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    assert said == sorted((n or 0, len((h or "").encode()), digest(h)) for n, _, h in ODD)
    by = {}
    for row in found:
        by.setdefault((row.page_id, row.payload_bytes), []).append((row.record_type, row.refers_to))
    assert by[1, 11] == [("response", None)] and by[2, 11] == [("revisit", 1)]
    assert by[4, 0] == [("response", None)] and by[5, 0] == [("revisit", 4)]
    assert by[None, 11] == [("revisit", 1)] and by[None, 12] == [("response", None)]
    assert sorted(by[8, 12], key=str) == [("response", None), ("revisit", 8)]
    payloads = {r.page_id: r.payload for r in found if r.record_type == "response"}
    assert payloads[3].decode() == ODD[2][2] and payloads[4] == b""
    assert {r.url for r in found if r.page_id == 3} == {"http://a.example/3WARC-Type: other"}


def test_archive_files_are_read_like_cells(spark, pages, tmp_path):
    cells = archives.archives(pages).collect()
    for at, row in enumerate(cells):
        (tmp_path / f"{at}.warc.zst").write_bytes(row.archive)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert archives.read_archives(files, "content").count() == len(ODD)


def test_dictionary_frame_leads_and_is_needed(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    dictionary = archives.trained(pages)
    assert dictionary and dictionary == archives.trained(pages.repartition(3))
    (archive,) = [row.archive for row in archives.archives(pages.coalesce(1)).collect()]
    assert archive[:4] == bytes.fromhex("5d2a4d18")
    assert len(list(archives.records(archive))) == pages.count()
    with pytest.raises(archives.BadArchive):
        list(archives.records(archive[8 + len(dictionary) :]))
    packed = zstandard.ZstdCompressor().compress(dictionary)
    repacked = archives.dictionary_frame(packed) + archive[8 + len(dictionary) :]
    assert list(archives.records(repacked)) == list(archives.records(archive))


def good(**changes):
    page = {"page_id": 1, "row": 1, "url": "u", "payload": b"abc", "first": None, "response": True}
    return archives.record(page | changes)


def test_records_that_are_not_as_they_say():
    headers, block = archives.parsed(good())
    assert block == b"abc" and headers["content-length"] == "3"
    for bad in (
        good()[:-1],
        good() + b"x",
        good().replace(b"WARC/1.1", b"HTTP/1.1"),
        good().replace(b"Content-Length: 3", b"Content-Length: 2"),
        good().replace(b"\r\n\r\nabc", b"\r\n\r\nabd"),
        good().replace(b"WARC-Date", b"WARC-Data"),
        b"",
    ):
        with pytest.raises(archives.BadArchive):
            archives.parsed(bad)
    frame = zstandard.ZstdCompressor().compress(good())
    assert len(list(archives.records(frame + frame))) == 2
    for bad in (frame[:-3], frame + b"no frame", archives.dictionary_frame(b"x" * 9)[:-2]):
        with pytest.raises(archives.BadArchive):
            list(archives.records(bad))


def foreign(headers: dict, block: bytes) -> bytes:
    """A record as others write it."""
    base = {"warc-type": "response", "WARC-Record-ID": "<urn:x>", "WARC-Date": "2020-01-01T00:00:00Z"}
    lines = {**base, "Content-Length": str(len(block)), **headers}
    head = "".join(f"{name}:{value}\r\n" for name, value in lines.items())
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>body</p>"


def test_records_of_others(spark):
    body = HTTP.partition(b"\r\n\r\n")[2]
    good = [
        {"Content-Type": "application/http; msgtype=response",
         "WARC-Payload-Digest": f" sha1:{archives.payload_digest(body)}"},
        {"WARC-Block-Digest": f"sha256:{hashlib.sha256(HTTP).hexdigest().upper()}"},
        {"WARC-Block-Digest": f"MD5:{base64.b32encode(hashlib.md5(HTTP).digest()).decode()}"},
        {"WARC-Block-Digest": "blake9:whatever", "X-Note": "x:y"},
    ]
    for headers in good:
        assert archives.parsed(foreign(headers, HTTP))[1] == HTTP
    bad = [
        {**good[0], "WARC-Payload-Digest": f"sha1:{archives.payload_digest(HTTP)}"},
        {"WARC-Block-Digest": f"sha256:{hashlib.sha256(body).hexdigest()}"},
        {"Content-Length": "many"},
        {"Content-Length": "-1"},
        {"no header\r\nX": "y"},
        {": nameless": ""},
    ]
    for headers in bad:
        with pytest.raises(archives.BadArchive):
            archives.parsed(foreign(headers, HTTP))
    with pytest.raises(archives.BadArchive):
        archives.parsed(foreign(good[0], b"no end of the head"))
    pack = zstandard.ZstdCompressor().compress
    revisit = foreign({"warc-type": "revisit", "warc-payload-digest": "sha1:ABC"}, b"")
    file = b"".join(pack(one) for one in (foreign(good[0], HTTP), foreign(good[1], HTTP), revisit))
    rows = archives.read_archives(spark.createDataFrame([(file,)], "archive binary")).collect()
    assert [(r.record_type, r.payload) for r in rows] == [
        ("response", body), ("response", HTTP), ("revisit", None),
    ]
    assert rows[2].payload_digest == "ABC" and rows[2].payload_bytes is None


def test_reading_is_linear_in_the_archive():
    import time

    frame = zstandard.ZstdCompressor().compress(good(payload=bytes(range(250)) * 12))

    def seconds(count):
        archive = frame * count
        begin = time.perf_counter()
        assert sum(1 for _ in archives.records(archive)) == count
        return time.perf_counter() - begin

    seconds(1000)
    assert seconds(40_000) <= 20 * seconds(4_000)
    large = zstandard.ZstdCompressor().compress(good(payload=b"y" * 5_000_000))
    assert [len(block) for _, block in archives.records(frame + large + frame)] == [
        3000, 5_000_000, 3000,
    ]

def test_no_pages(pages):
    assert archives.trained(pages.limit(0)) == b""
    assert archives.read_archives(archives.archives(pages.limit(0))).count() == 0
