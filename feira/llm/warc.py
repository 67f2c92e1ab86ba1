"""WARC archives in Zstandard: one frame per record, a dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from feira.llm.tables import stored

# Magic numbers and header names of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# A payload this long is stored once; shorter ones are stored each time.
REVISIT_BYTES = 1000
# An archive is closed once it holds so much, before compression.
ARCHIVE_BYTES = 8 << 20
# The dictionary of an archive: its size, and how much of the archive's first records it learns from.
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 512 << 10
LEVEL = 3
READ_BYTES = 64 << 10
# A frame that grows beyond this is refused.
RECORD_BYTES = 1 << 28

RECORDS = StructType(
    [
        StructField("archive", StringType()),
        StructField("position", LongType()),
        StructField("page_id", LongType()),
        StructField("record_type", StringType()),
        StructField("refers_to", LongType()),
        StructField("target_uri", StringType()),
        StructField("payload_bytes", LongType()),
        StructField("payload_digest", StringType()),
        StructField("payload", BinaryType()),
    ]
)
ARCHIVES = StructType(
    [
        StructField("path", StringType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
    ]
)


class BrokenArchive(ValueError):
    """An archive whose frames, headers or lengths are wrong."""


# --- one record


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d*)>", name)
    if found is None:
        raise BrokenArchive(f"record id {name!r}")
    return int(found[1]) if found[1] else None


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _headers(lines: dict[str, str | None]) -> bytes:
    return "".join([f"{k}: {v}\r\n" for k, v in lines.items() if v is not None]).encode()


def record(
    page_id: int | None, url: str | None, payload: bytes, head: int | None, date: str
) -> bytes:
    """One record: a response, or a revisit of the page `head`, which has the same payload."""
    http = b"HTTP/1.1 200 OK\r\n" + _headers(
        {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))}
    )
    block = http + b"\r\n" + (payload if head is None else b"")
    fields = {
        "WARC-Type": "response" if head is None else "revisit",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": date,
        # Characters that would end the line or are not allowed in a URI are percent-encoded.
        "WARC-Target-URI": None if url is None else quote(url, safe="%:/?#[]@!$&'()*+,;=~-._"),
        "WARC-Profile": None if head is None else IDENTICAL,
        "WARC-Refers-To": None if head is None else _name(head),
        "WARC-Payload-Digest": _sha1(payload),
        "WARC-Block-Digest": _sha1(block),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    return VERSIONS[1] + b"\r\n" + _headers(fields) + b"\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    fields = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        if not colon or not name or name != name.strip():
            raise BrokenArchive(f"header line {line[:60]!r}")
        if name.lower() in fields:
            raise BrokenArchive(f"header {name} twice")
        fields[name.lower()] = value.strip()
    return fields


def _split(data: bytes, what: str) -> tuple[list[bytes], bytes]:
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        raise BrokenArchive(f"{what} headers do not end")
    return head.split(b"\r\n"), rest


def _length(fields: dict[str, str], what: str) -> int:
    text = fields.get("content-length", "")
    if not text.isascii() or not text.isdigit():
        raise BrokenArchive(f"{what} length {text!r}")
    return int(text)


@dataclass(frozen=True)
class Page:
    page_id: int | None
    record_type: str
    refers_to: int | None
    target_uri: str | None
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


def parse(data: bytes) -> Page:
    """The page of one decoded frame, after all checks."""
    (version, *lines), rest = _split(data, "record")
    if version not in VERSIONS:
        raise BrokenArchive(f"version {version[:20]!r}")
    fields = _fields(lines)
    for name in REQUIRED:
        if name not in fields:
            raise BrokenArchive(f"no header {name}")
    size = _length(fields, "block")
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise BrokenArchive(f"block of {len(rest) - 4} bytes, {size} stated")
    if fields.get("warc-block-digest", _sha1(block)) != _sha1(block):
        raise BrokenArchive("block digest")
    (status, *http_lines), payload = _split(block, "HTTP")
    if not status.startswith(b"HTTP/"):
        raise BrokenArchive(f"status line {status[:20]!r}")
    full = _length(_fields(http_lines), "payload")
    stated = fields.get("warc-payload-digest", "")
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != full:
            raise BrokenArchive(f"payload of {len(payload)} bytes, {full} stated")
        if stated != _sha1(payload):
            raise BrokenArchive("payload digest")
    elif kind == "revisit":
        if payload:
            raise BrokenArchive("revisit with a payload")
    else:
        raise BrokenArchive(f"record type {kind!r}")
    return Page(
        page_id=_page_id(fields["warc-record-id"]),
        record_type=kind,
        refers_to=_page_id(fields["warc-refers-to"]) if kind == "revisit" else None,
        target_uri=fields.get("warc-target-uri"),
        payload_bytes=full,
        payload_digest=base64.b32decode(stated.removeprefix("sha1:")).hex(),
        payload=payload if kind == "response" else None,
    )


# --- records of others

_HEADER = StructType([StructField("name", StringType()), StructField("value", StringType())])
FOREIGN = StructType(
    [
        StructField("archive", StringType()),
        StructField("position", LongType()),
        StructField("record_id", StringType()),
        StructField("record_type", StringType()),
        StructField("date", StringType()),
        StructField("target_uri", StringType()),
        StructField("refers_to", StringType()),
        StructField("headers", ArrayType(_HEADER)),
        StructField("status", LongType()),
        StructField("http_headers", ArrayType(_HEADER)),
        StructField("payload", BinaryType()),
        StructField("payload_bytes", LongType()),
        StructField("digest_fits", BooleanType()),
    ]
)


def _listed(lines: list[bytes]) -> list[tuple[str, str]]:
    """Header fields in their order, names in lower case; a line that begins with white space goes on."""
    found: list[tuple[str, str]] = []
    for line in lines:
        text = line.decode("utf-8", "replace")
        name, colon, value = text.partition(":")
        if text[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {text.strip()}")
        elif colon and name.strip():
            found.append((name.strip().lower(), value.strip()))
        else:
            raise BrokenArchive(f"header line {line[:60]!r}")
    return found


def unchunked(body: bytes) -> bytes | None:
    """The content of a body in HTTP chunks; None if it is not in chunks or they do not end."""
    parts, at = [], 0
    while True:
        line, found, _ = body[at : at + 1024].partition(b"\r\n")
        size = line.split(b";")[0].strip()
        if not found or not re.fullmatch(rb"[0-9a-fA-F]{1,12}", size):
            return None
        at += len(line) + 2
        length = int(size, 16)
        if not length:
            return b"".join(parts)
        if body[at + length : at + length + 2] != b"\r\n":
            return None
        parts.append(body[at : at + length])
        at += length + 2


def _digest_fits(stated: str | None, candidates: list[bytes]) -> bool | None:
    """Whether a SHA-1 digest, in base 32 or hexadecimal, is that of one of some contents; None for others."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower() != "sha1":
        return None
    sums = [hashlib.sha1(data).digest() for data in candidates]
    return value.lower() in [x.hex() for x in sums] or value.upper() in [base64.b32encode(x).decode() for x in sums]


def parse_any(data: bytes) -> dict:
    """A record of any type and origin, as a row of FOREIGN without archive and position.

    Version, the required headers and the block length are checked. HTTP messages are split into head
    and payload; chunks are joined. Fields may repeat, and a payload length need not be stated. What is no HTTP message
    is all payload. A digest that does not fit is told, not refused: crawlers differ in what they sum up.
    """
    (version, *lines), rest = _split(data, "record")
    if version not in VERSIONS:
        raise BrokenArchive(f"version {version[:20]!r}")
    headers = _listed(lines)
    fields = dict(reversed(headers))
    for name in REQUIRED:
        if name not in fields:
            raise BrokenArchive(f"no header {name}")
    size = _length(fields, "block")
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise BrokenArchive(f"block of {len(rest) - 4} bytes, {size} stated")
    kind = fields["warc-type"].lower()
    status, http, payload, bodies = None, None, block, [block]
    head, found, body = block.partition(b"\r\n\r\n")
    first, *more = head.split(b"\r\n")
    if fields.get("content-type", "").lower().startswith("application/http") and (found or kind == "revisit"):
        answered = re.match(rb"HTTP/\S+ +(\d{3})", first)
        status = int(answered[1]) if answered else None
        http, payload, bodies = _listed(more), body, [body]
        coding = ",".join(value for name, value in http if name == "transfer-encoding").lower()
        joined = unchunked(body) if "chunked" in coding else None
        if joined is not None:
            payload, bodies = joined, [joined, body]
    if kind == "revisit":
        payload = None
    return {
        "record_id": fields["warc-record-id"],
        "record_type": kind,
        "date": fields["warc-date"],
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "headers": [{"name": n, "value": v} for n, v in headers],
        "status": status,
        "http_headers": None if http is None else [{"name": n, "value": v} for n, v in http],
        "payload": payload,
        "payload_bytes": None if payload is None else len(payload),
        "digest_fits": None if payload is None else _digest_fits(fields.get("warc-payload-digest"), bodies),
    }


# --- one archive


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Learned from the first records; None where they are too few or too short to learn from."""
    sample, size = [], 0
    for data in records:
        sample.append(data[: SAMPLE_BYTES // 8])
        size += len(sample[-1])
        if size >= SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=256, d=8)
    except zstandard.ZstdError:
        return None


def pack(records: list[bytes]) -> bytes:
    """The archive of these records."""
    learned = _dictionary(records)
    parts = []
    if learned is not None:
        content = zstandard.ZstdCompressor(level=LEVEL).compress(learned.as_bytes())
        parts.append(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
        coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=learned, write_checksum=True)
    else:
        coder = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    parts += [coder.compress(data) for data in records]
    return b"".join(parts)


def _frame(view: memoryview, begin: int, coder: zstandard.ZstdDecompressor) -> tuple[bytes, int]:
    """The content of the frame at `begin`, and where the next one begins."""
    reader = coder.decompressobj()
    parts, at, size = [], begin, 0
    while not reader.eof:
        piece = view[at : at + READ_BYTES]
        if not piece:
            raise BrokenArchive("the last frame is cut off")
        parts.append(reader.decompress(piece))
        size += len(parts[-1])
        if size > RECORD_BYTES:
            raise BrokenArchive(f"a record of more than {RECORD_BYTES} bytes")
        at += len(piece)
    return b"".join(parts), at - len(reader.unused_data)


def unpack(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(position, record) of every frame."""
    view, at = memoryview(content), 0
    coder = zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 8:
            raise BrokenArchive("bytes after the last frame")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(view):
                raise BrokenArchive("the skippable frame is cut off")
            if magic == DICTIONARY_MAGIC:
                if at:
                    raise BrokenArchive("the dictionary does not lead")
                held = bytes(view[8 : 8 + size])
                if held[:4] == struct.pack("<I", FRAME_MAGIC):
                    held = zstandard.ZstdDecompressor().decompress(held)
                coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise BrokenArchive(f"magic number {magic:#x}")
        try:
            data, after = _frame(view, at, coder)
        except zstandard.ZstdError as broken:
            raise BrokenArchive(str(broken)) from broken
        yield at, data
        at = after


# --- tables of archives


def with_heads(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """(page_id, url, payload, head): `head` is the page that stores the payload, NULL for itself.

    Copies are counted per digest before the join, so a payload that most pages have is one row in
    it; Spark can broadcast the few digests that occur twice, else AQE splits the hot one.
    """
    payload = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8")
    read = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.when(F.length("payload") >= REVISIT_BYTES, F.sha1("payload")))
    heads = (
        read.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.max("page_id").alias("head"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("digest", "head")
    )
    found = read.join(stored(heads, "payload-heads"), "digest", "left")
    other = ~F.col("page_id").eqNullSafe(F.col("head"))
    return found.select("page_id", "url", "payload", F.when(other, F.col("head")).alias("head"))


def archives(
    pages: DataFrame,
    key: str = "page_id",
    html: str = "html",
    url: str = "url",
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """(path, length, content): the pages as archives of about `ARCHIVE_BYTES`, one per row.

    Of equal payloads of at least `REVISIT_BYTES`, the page with the largest id is a response and the
    others revisit it; shorter ones are responses. A NULL page is an empty payload; a NULL id is the
    smallest; a NULL address is left out. Rows that are repeated with the largest id are all
    responses. Other columns are left out; a table without rows gives no archive.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            content = pack(held)
            row = {"path": f"pages-{part:06d}-{number:06d}.warc.zst", "length": len(content), "content": content}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for page, address, payload, head in zip(*batch.columns):
                data = record(page.as_py(), address.as_py(), payload.as_py(), head.as_py(), date)
                held.append(data)
                size += len(data)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    number, held, size = number + 1, [], 0
        if held:
            yield close()

    schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("content", pa.binary())])
    return with_heads(pages, key, html, url).mapInArrow(write, ARCHIVES)


def read_archives(table: DataFrame) -> DataFrame:
    """The records of archives, from a table with `path` and `content` as `spark.read.format("binaryFile")`
    gives for files.

    Stops with `BrokenArchive`, which names archive and position, when a frame, a header or a length
    is wrong. NULL content and empty archives have no records.
    """

    return _records(table, lambda data: parse(data).__dict__, RECORDS)


def read_records(table: DataFrame, types: tuple[str, ...] | None = None) -> DataFrame:
    """All records of archives of any origin, or those of some types, as FOREIGN; else as `read_archives`.

    `types` are lower-case names such as response, request, resource, metadata or warcinfo.
    """
    found = _records(table, parse_any, FOREIGN)
    return found if types is None else found.filter(F.col("record_type").isin(*types))


def _records(table: DataFrame, parsed: Callable[[bytes], dict], shape: StructType) -> DataFrame:
    """A row per frame."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*batch.columns):
                rows, size, at = [], 0, 0
                name = path.as_py()
                try:
                    for at, data in unpack(content.as_py() or b""):
                        rows.append({"archive": name, "position": at, **parsed(data)})
                        size += len(data)
                        if size >= ARCHIVE_BYTES // 4:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                except BrokenArchive as broken:
                    raise BrokenArchive(f"{name}, after position {at}: {broken}") from broken
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = to_arrow_schema(shape)
    return table.select("path", "content").mapInArrow(read, shape)


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write the pages as archives to a table at `path`, and read all records back."""
    archives(pages).write.parquet(path)
    stored = pages.sparkSession.read.schema(ARCHIVES).parquet(path)
    return read_archives(stored)
