"""WARC records packaged in ZIP archives, read again by range.

An archive is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``, whose
records are gzip members of their own, and ``indexes/index.cdx`` with a line per record: key,
offset and length. The reader finds the end record at the file's end, follows the ZIP64 locator
where sizes or counts do not fit, parses the central directory and the members' local headers,
reads the index, and then fetches single records by their byte range; nothing is unpacked.

Of rows with equal payloads of at least ``least_bytes`` bytes the one with the smallest key is
the response; the others are written as revisits without a payload, and the reader takes
length and digest from their headers. Rows below that size are responses all. Payloads count as
equal if SHA-256 and length are. NULL payloads count as empty, NULL URLs as empty. Each row is
judged by its own payload: rows that share the smallest key are responses all. A NULL key is
written as ``NO_KEY`` and read as NULL; it is never the smallest, so its row is a revisit of a row
with a key, and a response if no row of that payload has one, since a revisit needs a name.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.session import pin

from . import files
from .common import pieces, spread_join

ARCHIVE_BYTES = 16 << 20
NO_KEY = "-"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"

# Fixed values of the ZIP format: signatures, and the marks of values kept in ZIP64 fields.
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
LOCAL_HEAD = struct.Struct("<4s5H3I2H")
CENTRAL_HEAD = struct.Struct("<4s6H3I5H2I")
END_HEAD = struct.Struct("<4s4H2IH")
END64_HEAD = struct.Struct("<4sQ2H2I4Q")
LOCATOR_HEAD = struct.Struct("<4sIQI")
YEAR_1980 = 33


@dataclass(frozen=True)
class Member:
    name: str
    offset: int
    size: int


def pack(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP file of stored members; ZIP64 fields where asked for or needed."""
    out, central = bytearray(), bytearray()
    for name, data in members:
        raw, at, crc, size = name.encode(), len(out), zlib.crc32(data), len(data)
        wide = zip64 or size >= FULL32 or at >= FULL32
        extra = struct.pack("<2H3Q", 1, 24, size, size, at) if wide else b""
        local_extra = struct.pack("<2H2Q", 1, 16, size, size) if wide else b""
        shown, shown_at = (FULL32, FULL32) if wide else (size, at)
        version = 45 if wide else 20
        out += LOCAL_HEAD.pack(LOCAL, version, 0x800, 0, 0, YEAR_1980, crc, shown, shown, len(raw), len(local_extra))
        out += raw + local_extra + data
        central += CENTRAL_HEAD.pack(
            CENTRAL, version, version, 0x800, 0, 0, YEAR_1980, crc, shown, shown, len(raw), len(extra), 0, 0, 0, 0, shown_at
        )
        central += raw + extra
    start, count = len(out), len(members)
    out += central
    if zip64 or start >= FULL32 or count >= FULL16:
        end64 = len(out)
        out += END64_HEAD.pack(END64, END64_HEAD.size - 12, 45, 45, 0, 0, count, count, len(central), start)
        out += LOCATOR_HEAD.pack(LOCATOR64, 0, end64, 1)
        count, shown_size, start = FULL16, FULL32, FULL32
    else:
        shown_size = len(central)
    out += END_HEAD.pack(END, 0, 0, count, count, shown_size, start, 0)
    return bytes(out)


class Archive:
    """The members of a ZIP file that is open for reading at any place."""

    def __init__(self, source):
        self.source = source
        self.length = source.size()
        self.members = {m.name: m for m in self._directory()}

    def read(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        data = self.source.read(size)
        if len(data) != size:
            raise ValueError("the archive ends early")
        return data

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.length - END_HEAD.size - FULL16)
        tail = self.read(tail_at, self.length - tail_at)
        at = tail.rfind(END)
        if at < 0:
            raise ValueError("not a ZIP file: no end record")
        _, _, _, _, count, size, start, _ = END_HEAD.unpack_from(tail, at)
        if FULL16 == count or FULL32 in (size, start):
            place = tail_at + at - LOCATOR_HEAD.size
            mark, _, end64, _ = LOCATOR_HEAD.unpack(self.read(place, LOCATOR_HEAD.size)) if place >= 0 else (b"", 0, 0, 0)
            if mark == LOCATOR64:
                head = END64_HEAD.unpack(self.read(end64, END64_HEAD.size))
                if head[0] != END64:
                    raise ValueError("the ZIP64 end record is not where the locator says")
                count, size, start = head[7], head[8], head[9]
        block, at = self.read(start, size), 0
        for _ in range(count):
            head = CENTRAL_HEAD.unpack_from(block, at)
            if head[0] != CENTRAL:
                raise ValueError("the central directory is damaged")
            method, stored, length, offset = head[4], head[8], head[9], head[16]
            at += CENTRAL_HEAD.size
            name = block[at : at + head[10]].decode()
            extra = block[at + head[10] : at + head[10] + head[11]]
            length, stored, offset = _wide(extra, length, stored, offset)
            at += head[10] + head[11] + head[12]
            if method == 0:
                yield Member(name, self._data(offset), stored)

    def _data(self, offset: int) -> int:
        """Where a member's bytes begin; its local header may be longer than the central one."""
        head = LOCAL_HEAD.unpack(self.read(offset, LOCAL_HEAD.size))
        if head[0] != LOCAL:
            raise ValueError("a local header is not where the directory says")
        return offset + LOCAL_HEAD.size + head[9] + head[10]

    def part(self, name: str, offset: int = 0, size: int | None = None) -> bytes:
        member = self.members[name]
        size = member.size - offset if size is None else size
        if offset < 0 or offset + size > member.size:
            raise ValueError(f"the range is outside {name}")
        return self.read(member.offset + offset, size)

    def records(self) -> Iterator[tuple[str, dict[str, str], bytes]]:
        """(key, headers, payload) of the records in the order of the index."""
        for line in self.part(INDEX).decode().splitlines():
            key, offset, size = line.split(" ")
            headers, payload = parse(zlib.decompress(self.part(DATA, int(offset), int(size)), 31))
            yield key, headers, payload


def _wide(extra: bytes, length: int, stored: int, offset: int) -> tuple[int, int, int]:
    """Values that are marked as full come from the ZIP64 field, in this order."""
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<2H", extra, at)
        if tag == 1:
            values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return tuple(next(values) if v == FULL32 else v for v in (length, stored, offset))
        at += 4 + size
    return length, stored, offset


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: str, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record; a revisit names the response and holds no payload."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{key}>",
        f"WARC-Target-URI: {' '.join(url.split())}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload if refers_to is None else b"")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """The headers and the payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, uri: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, zip64: bool = True) -> DataFrame:
    """Write archives below ``uri``; returns their manifest (``uri``, ``records``).

    The payloads travel once, to the archives: who is a revisit is settled on digests alone.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    same = [F.sha2(body, 256).alias("same"), F.octet_length(body).alias("n")]
    digests = pages.select(F.col(key).alias("k"), *same).filter(F.col("n") >= least_bytes)
    classes = digests.groupBy("same", "n").agg(F.min("k").alias("first"), F.count("*").alias("rows"))
    # Only digests with copies matter; the rows of a hot payload stay where they are.
    shared = pin(classes.filter("rows > 1 AND first IS NOT NULL"), "digests")
    given = pages.select(F.col(key).alias("k"), F.coalesce(F.col(url), F.lit("")).alias("u"), body.alias("p"), *same)
    rows = spread_join(given, shared, ["same", "n"], "rows", "left")
    refers_to = F.when(F.col("k").isNull() | (F.col("k") != F.col("first")), F.col("first"))
    rows = rows.select("k", "u", "p", refers_to.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, index = bytearray(), []
        for piece in pieces(batches, "p", archive_bytes):
            columns = (piece.column(c).to_pylist() for c in ("k", "u", "p", "refers_to"))
            for k, u, p, to in zip(*columns):
                k = NO_KEY if k is None else str(k)
                packed = _gzip(record(k, u, p, None if to is None else str(to)))
                index.append(f"{k} {len(data)} {len(packed)}\n")
                data += packed
                if len(data) >= archive_bytes:
                    yield _stored(uri, data, index, zip64)
                    data, index = bytearray(), []
        if index:
            yield _stored(uri, data, index, zip64)

    return pin(rows.mapInArrow(run, "uri string, records long"), "manifest")


def _gzip(data: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _stored(uri: str, data: bytearray, index: list[str], zip64: bool) -> pa.RecordBatch:
    members = [(DATA, bytes(data)), (INDEX, "".join(index).encode())]
    at = files.write(uri, pack(members, zip64), ".wacz")
    return pa.RecordBatch.from_pydict({"uri": [at], "records": pa.array([len(index)], pa.int64())})


def read_archives(manifest: DataFrame, key: str = "page_id") -> DataFrame:
    """Every record of the archives, with its headers and its payload (NULL for revisits)."""
    tasks = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                with files.open_at(uri) as source:
                    rows = []
                    for k, headers, payload in Archive(source).records():
                        rows.append(_row(None if k == NO_KEY else int(k), headers, payload))
                        if len(rows) >= 256:
                            yield _batch(rows, key)
                            rows = []
                    if rows:
                        yield _batch(rows, key)

    schema = f"{key} long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    return manifest.select("uri").repartition(tasks).mapInArrow(run, schema)


def _row(key: int | None, headers: dict[str, str], payload: bytes) -> tuple:
    kind, to = headers["WARC-Type"], headers.get("WARC-Refers-To")
    length, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or sha1_base32(payload) != digest):
        raise ValueError(f"the payload of record {key} does not match its digest")
    to = int(to.removeprefix("<urn:page:").removesuffix(">")) if to else None
    return key, length, digest, kind, to, headers["WARC-Target-URI"], payload if kind == "response" else None


def _batch(rows: list[tuple], key: str) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [key, "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
