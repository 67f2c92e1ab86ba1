from __future__ import annotations

import hashlib
import struct

import pytest
import zstandard

from feira.llm import warc

DATE = "2020-01-01T00:00:00Z"
FIELDS = "page_id long, url string, html string, path string, content string"


@pytest.fixture
def pages(spark):
    def make(*rows):
        return spark.createDataFrame([(*row, "p", "c") for row in rows], FIELDS)

    return make


def test_round_trip(pages, tmp_path):
    big, small = "é<p>" * 500, "tiny"
    rows = [
        (1, "http://a/ü x\r\ny", big), (5, None, big), (3, "http://c", big), (2, "http://d", small),
        (4, "http://e", small), (6, "http://f", None), (7, "http://g", ""), (None, "http://h", big),
        (8, "http://i", "x" * 3_000_000), (9, "u", "only once" * 200), (9, "u", "only once" * 200),
    ]
    found = warc.round_trip(pages(*rows), str(tmp_path / "t")).collect()
    assert len(found) == len(rows)
    got = sorted(
        [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], key=repr
    )
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        head = {big: 5, "only once" * 200: 9}.get(html, page)
        kind = "response" if head == page else "revisit"
        refers = None if head == page else head
        expected.append((page, len(data), hashlib.sha1(data).hexdigest(), kind, refers))
    assert got == sorted(expected, key=repr)
    texts = {r.page_id: r.payload for r in found if r.record_type == "response"}
    assert bytes(texts[5]).decode() == big and bytes(texts[8]) == b"x" * 3_000_000
    assert {r.payload for r in found if r.record_type == "revisit"} == {None}


def test_hot_payload_and_empty_table(pages, tmp_path):
    rows = [(i, "u", "same page " * 150 if i % 3 else f"page {i} " * 150) for i in range(300)]
    found = warc.round_trip(pages(*rows), str(tmp_path / "t")).collect()
    assert {r.refers_to for r in found if r.record_type == "revisit"} == {299}
    assert sum(r.record_type == "response" for r in found) == 101
    assert warc.round_trip(pages((1, "u", "x")).filter("false"), str(tmp_path / "e")).count() == 0


RECORDS = [warc.record(i, f"http://a/{i}", f"<p>page {i} of many</p>".encode() * 40, None, DATE) for i in range(200)]


def test_dictionary_leads_and_each_record_is_a_frame():
    archive = warc.pack(RECORDS)
    magic, size = struct.unpack_from("<II", archive)
    assert magic == warc.DICTIONARY_MAGIC
    # The dictionary is compressed itself; without it the frames cannot be read.
    learned = zstandard.ZstdDecompressor().decompress(archive[8 : 8 + size])
    frame = archive[8 + size :]
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompressobj().decompress(frame)
    coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(learned))
    assert coder.decompressobj().decompress(frame) == RECORDS[0]
    assert [data for _, data in warc.unpack(archive)] == RECORDS
    plain = struct.pack("<II", warc.DICTIONARY_MAGIC, len(learned)) + learned + frame
    assert [data for _, data in warc.unpack(plain)] == RECORDS
    few = warc.pack(RECORDS[:2])
    assert [data for _, data in warc.unpack(few)] == RECORDS[:2]
    assert list(warc.unpack(b"")) == []


@pytest.mark.parametrize(
    "broken",
    [
        lambda a: a[:-3],
        lambda a: a + b"abc",
        lambda a: a + b"not a frame at all",
        lambda a: a[:20],
        lambda a: a[: len(a) // 2] + bytes([a[len(a) // 2] ^ 0xFF]) + a[len(a) // 2 + 1 :],
    ],
)
def test_broken_archives(broken):
    with pytest.raises(warc.BrokenArchive):
        for _, data in warc.unpack(broken(warc.pack(RECORDS))):
            warc.parse(data)


RECORD = warc.record(1, "http://a", b"payload", None, DATE)


@pytest.mark.parametrize(
    ("old", "new"),
    [
        (b"WARC/1.1", b"WARC/3.0"), (b"WARC-Type: response\r\n", b""), (b"payload", b"payl0ad"),
        (b"WARC-Type: response", b"WARC-Type: request"), (b"\r\n\r\npayload", b"\r\n\r\npayloads"),
        (b"WARC-Date:", b"WARC-Date"), (b"<urn:page:1>", b"<urn:page:one>"), (b"payload\r\n\r\n", b"payload\r\n"),
        (b"Content-Length: 7", b"Content-Length: 9"), (b"HTTP/1.1 200", b"GTTP/1.1 200"),
        (b"WARC-Date", b"WARC-Type"),
    ],
)
def test_broken_records(old, new):
    assert warc.parse(RECORD).payload == b"payload"
    assert old in RECORD
    with pytest.raises(warc.BrokenArchive):
        warc.parse(RECORD.replace(old, new, 1))


def test_files(spark, pages, tmp_path):
    """Archives as files, read with Spark's own reader of whole files."""
    (tmp_path / "a.warc.zst").write_bytes(warc.pack(RECORDS))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert {r.page_id for r in warc.read_archives(files).collect()} == set(range(200))
    (tmp_path / "b.warc.zst").write_bytes(warc.pack(RECORDS)[:-9])
    with pytest.raises(Exception, match="b.warc.zst"):
        warc.read_archives(spark.read.format("binaryFile").load(str(tmp_path))).count()


def foreign(kind, block, content_type="application/http; msgtype=response", more=()):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:9d2a>", f"WARC-Date: {DATE}",
             f"Content-Type: {content_type}", f"Content-Length: {len(block)}", *more]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


CHUNKED = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nWiki\r\n6;x=1\r\npedia \r\n0\r\n\r\n"
COOKIES = b"HTTP/1.1 404 Not Found\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\nX-Long: one\r\n two\r\n\r\nbody"
SUM = hashlib.sha1(b"body").hexdigest()
OTHERS = {
    "warcinfo": foreign("warcinfo", b"software: crawler/1\r\nformat: WARC 1.0\r\n", "application/warc-fields"),
    "request": foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "application/http; msgtype=request"),
    "chunked": foreign("response", CHUNKED, more=["WARC-Payload-Digest: sha1:" + hashlib.sha1(b"Wikipedia ").hexdigest()]),
    "cookies": foreign("response", COOKIES, more=[f"WARC-Payload-Digest: sha1:{SUM}", "WARC-Concurrent-To: <a>", "WARC-Concurrent-To: <b>"]),
    "wrong": foreign("response", COOKIES, more=["WARC-Payload-Digest: sha1:" + "A" * 32]),
    "cut": foreign("response", b"HTTP/1.1 200 OK\r\nServer: x", more=["WARC-Truncated: length"]),
    "resource": foreign("resource", b"\x00\xff image", "image/png", ["WARC-Payload-Digest: md5:abc"]),
    "metadata": foreign("metadata", b"fetchTimeMs: 5\r\n", "application/warc-fields"),
    "revisit": foreign("revisit", b"HTTP/1.1 304 Not Modified\r\n\r\n", more=["WARC-Refers-To: <urn:uuid:1>"]),
    "broken chunks": foreign("response", CHUNKED.replace(b"\r\n0\r\n", b"\r\nzz\r\n")),
}


def test_records_of_others(spark, tmp_path):
    (tmp_path / "a.warc.zst").write_bytes(warc.pack(list(OTHERS.values()) + RECORDS))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    rows = warc.read_records(files).orderBy("position").collect()
    assert len(rows) == len(OTHERS) + 200
    found = dict(zip(OTHERS, rows))
    assert [r.record_type for r in rows[:3]] == ["warcinfo", "request", "response"]
    assert {r.record_id for r in rows[: len(OTHERS)]} == {"<urn:uuid:9d2a>"}
    assert bytes(found["chunked"].payload) == b"Wikipedia " and found["chunked"].digest_fits
    assert bytes(found["cookies"].payload) == b"body" and found["cookies"].status == 404 and found["cookies"].digest_fits
    assert [h.value for h in found["cookies"].http_headers] == ["a=1", "b=2", "one two"]
    assert [h.value for h in found["cookies"].headers if h.name == "warc-concurrent-to"] == ["<a>", "<b>"]
    assert found["wrong"].digest_fits is False and found["resource"].digest_fits is None
    assert found["cut"].status is None and bytes(found["cut"].payload) == b"HTTP/1.1 200 OK\r\nServer: x"
    assert bytes(found["resource"].payload) == b"\x00\xff image" and found["resource"].payload_bytes == 8
    assert found["revisit"].payload is None and found["revisit"].refers_to == "<urn:uuid:1>" and found["revisit"].status == 304
    assert b"zz" in bytes(found["broken chunks"].payload)
    own = rows[-1]
    assert (own.status, own.digest_fits) == (200, True) and own.target_uri == "http://a/199"
    assert warc.read_records(files, ("warcinfo", "metadata")).count() == 2


@pytest.mark.parametrize("old, new", [(b"WARC/1.0", b"WARC/9"), (b"WARC-Date: ", b"X: "), (b"Content-Length: ", b"Content-Length: 9")])
def test_broken_records_of_others(old, new):
    with pytest.raises(warc.BrokenArchive):
        warc.parse_any(OTHERS["cookies"].replace(old, new, 1))


def test_a_frame_that_grows_too_much_is_refused(monkeypatch):
    monkeypatch.setattr(warc, "RECORD_BYTES", 1 << 16)
    archive = warc.pack([foreign("resource", bytes(1 << 20), "x/y")])
    assert len(archive) < 1000
    with pytest.raises(warc.BrokenArchive, match="more than 65536 bytes"):
        list(warc.unpack(archive))
