"""WARC records in ZIP packages, written and read back by byte range.

A package is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``
with the records, each compressed for itself, and ``indexes/index.cdx`` with one line
per record: offset and length in the archive, and key. ZIP64 fields are written where sizes need them
and read wherever they are. A reader parses the central directory, finds where a
stored member's bytes begin, and reads records by range; nothing is extracted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.llm.common import Table, bounded, materialise, new_folder, open_input, open_output

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
# A package is closed once its records exceed this.
PACKAGE_BYTES = 64 << 20
# Records are read in ranges of about this many bytes.
READ_BYTES = 4 << 20

# Fixed values of the ZIP format: signatures, and layouts after them.
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_LOCAL_FIELDS = struct.Struct("<HHHHHIIIHH")
_CENTRAL_FIELDS = struct.Struct("<HHHHHHIIIHHHHHII")
_END_FIELDS = struct.Struct("<HHHHIIH")
_END64_FIELDS = struct.Struct("<QHHIIQQQQ")
_LOCATOR_FIELDS = struct.Struct("<IQI")
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- packages ----------------------------------------------------------------


class Package:
    """Writes the two members of a package one after the other."""

    def __init__(self, uri: str, zip64: bool = False):
        self.out = open_output(uri)
        self.zip64 = zip64  # write ZIP64 fields even where they are not needed
        self.lines: list[bytes] = []
        self.at = self._start(ARCHIVE.encode())
        self.crc = self.size = 0

    def _start(self, name: bytes, at: int = 0) -> int:
        # Sizes follow the data (flag bit 3) and are in the central directory.
        head = _LOCAL + _LOCAL_FIELDS.pack(45, 8, 0, 0, 0x21, 0, 0, 0, len(name), 0) + name
        self.out.write(head)
        return at + len(head)

    def add(self, key: str, record: bytes) -> None:
        self.lines.append(b"%d %d %s\n" % (self.size, len(record), key.encode()))
        self.out.write(record)
        self.crc = zlib.crc32(record, self.crc)
        self.size += len(record)

    def _after(self, crc: int, size: int) -> bytes:
        wide = self.zip64 or size >= _FULL32
        return b"PK\x07\x08" + struct.pack("<IQQ" if wide else "<III", crc, size, size)

    def close(self) -> None:
        index = b"".join(self.lines)
        tail = self._after(self.crc, self.size)
        self.out.write(tail)
        second = self.at + self.size + len(tail)
        begin = self._start(INDEX.encode(), second)
        self.out.write(index)
        tail = self._after(zlib.crc32(index), len(index))
        self.out.write(tail)
        directory = begin + len(index) + len(tail)
        members = [
            (ARCHIVE.encode(), self.crc, self.size, 0),
            (INDEX.encode(), zlib.crc32(index), len(index), second),
        ]
        central = b"".join(self._entry(*m) for m in members)
        self.out.write(central)
        if self.zip64 or max(directory, len(central)) >= _FULL32:
            self.out.write(
                _END64 + _END64_FIELDS.pack(44, 45, 45, 0, 0, 2, 2, len(central), directory)
                + _LOCATOR + _LOCATOR_FIELDS.pack(0, directory + len(central), 1)
                + _END + _END_FIELDS.pack(0, 0, _FULL16, _FULL16, _FULL32, _FULL32, 0)
            )
        else:
            self.out.write(_END + _END_FIELDS.pack(0, 0, 2, 2, len(central), directory, 0))
        self.out.close()

    def _entry(self, name: bytes, crc: int, size: int, start: int) -> bytes:
        wide = self.zip64 or max(size, start) >= _FULL32
        extra = struct.pack("<HHQQQ", 1, 24, size, size, start) if wide else b""
        shown, begin = (_FULL32, _FULL32) if wide else (size, start)
        return _CENTRAL + _CENTRAL_FIELDS.pack(45, 45, 8, 0, 0, 0x21, crc, shown, shown, len(name), len(extra), 0, 0, 0, 0, begin) + name + extra


@dataclass(frozen=True)
class Member:
    name: str
    stored: bool
    size: int  # as it lies in the file
    header: int  # offset of its local header
    crc: int


def _range(f, start: int, size: int) -> bytes:
    f.seek(start)
    return f.read(size)


def directory(f) -> dict[str, Member]:
    """Members by name, from the central directory at the end of an opened file."""
    total = f.size()
    back = min(total, 22 + _FULL16)
    tail = _range(f, total - back, back)
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("not a ZIP file")
    _, _, _, count, size, start, _ = _END_FIELDS.unpack_from(tail, at + 4)
    if _FULL16 in (count,) or _FULL32 in (size, start):
        where = at - 4 - _LOCATOR_FIELDS.size
        if where >= 0 and tail[where : where + 4] == _LOCATOR:
            _, end64, _ = _LOCATOR_FIELDS.unpack_from(tail, where + 4)
            raw = _range(f, end64, 4 + _END64_FIELDS.size)
            if raw[:4] != _END64:
                raise ValueError("ZIP64 directory is not where its locator says")
            _, _, _, _, _, _, count, size, start = _END64_FIELDS.unpack_from(raw, 4)
    raw, at, found = _range(f, start, size), 0, {}
    for _ in range(count):
        if raw[at : at + 4] != _CENTRAL:
            raise ValueError("central directory is damaged")
        _, _, flags, method, _, _, crc, packed, plain, n, extra, comment, _, _, _, header = _CENTRAL_FIELDS.unpack_from(raw, at + 4)
        at += 4 + _CENTRAL_FIELDS.size
        name = raw[at : at + n].decode("utf-8" if flags & 0x800 else "cp437")
        more = raw[at + n : at + n + extra]
        while len(more) >= 4:
            kind, length = struct.unpack_from("<HH", more)
            if kind == 1:
                wide = [x for (x,) in struct.iter_unpack("<Q", more[4 : 4 + length // 8 * 8])]
                if plain == _FULL32:
                    plain = wide.pop(0)
                if packed == _FULL32:
                    packed = wide.pop(0)
                if header == _FULL32:
                    header = wide.pop(0)
            more = more[4 + length :]
        at += n + extra + comment
        found[name] = Member(name, method == 0, packed, header, crc)
    return found


def begins(f, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if not member.stored:
        raise ValueError(f"{member.name} is compressed and can't be read by range")
    raw = _range(f, member.header, 4 + _LOCAL_FIELDS.size)
    if raw[:4] != _LOCAL:
        raise ValueError(f"{member.name} has no local header")
    name, extra = _LOCAL_FIELDS.unpack_from(raw, 4)[-2:]
    return member.header + 4 + _LOCAL_FIELDS.size + name + extra


# --- records -----------------------------------------------------------------


def record(fields: list[tuple[str, str]], payload: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-cased name, and the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record begins here")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    size = int(fields["content-length"])
    if len(rest) < size:
        raise ValueError("record is cut off")
    return fields, rest[:size]


def _line(text: str | None) -> str:
    """A header's value: no line breaks."""
    return " ".join((text or "").split())


def write_packages(
    pages: DataFrame,
    least: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    package_bytes: int = PACKAGE_BYTES,
) -> Table:
    """One WARC record per row, in packages; returns one row per package (path, records).

    Payload is the text in UTF-8, null as empty. Of rows with equal payloads of at
    least ``least`` bytes, those with the largest id are responses and the others
    revisit it; rows that repeat an id and its payload are alike. A null id is
    smaller than any other and written as an empty key. An empty table makes no
    package. A task's packages have names of its own, and only those of tasks that
    ended well are listed, so a repeated task leaves unlisted files at most.
    """
    folder = new_folder(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("exact"),
    )
    order = F.struct(F.col("id").isNotNull().alias("k"), F.col("id").alias("i"))
    repeated = materialise(
        rows.where(F.octet_length("payload") >= least).groupBy("exact")
        .agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("exact", F.col("best.i").alias("best")),
        "repeated-payloads",
        F.lit(64),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, path, package = TaskContext.get().partitionId(), "", None

        def closed():
            package.close()
            return pa.RecordBatch.from_pydict(
                {"path": [path], "records": [len(package.lines)], "bytes": [package.size]}
            )

        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    path = f"{folder}/{part:05d}-{uuid.uuid4().hex}.zip"
                    package = Package(path)
                package.add(*_page_record(row))
                if package.size >= package_bytes:
                    yield closed()
                    package = None
        if package is not None:
            yield closed()

    judged = rows.join(bounded(repeated), "exact", "left").select(
        "id", "url", "payload", "best",
        (F.col("best").isNotNull() & ~F.col("id").eqNullSafe(F.col("best"))).alias("again"),
    )
    return materialise(judged.mapInArrow(write, "path string, records long, bytes long"), "packages")


def _page_record(row: dict) -> tuple[str, bytes]:
    payload, key = row["payload"], "" if row["id"] is None else str(row["id"])
    fields = [
        ("WARC-Type", "revisit" if row["again"] else "response"),
        ("WARC-Record-ID", f"<urn:page:{key}>"),
        ("WARC-Target-URI", _line(row["url"])),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html"),
    ]
    if row["again"]:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{row['best']}>"),
        ]
    return key, gzip.compress(record(fields, b"" if row["again"] else payload), 3, mtime=0)


def read_records(path: str, read_bytes: int = READ_BYTES) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of a package in the order of its index, read in ranges of its archive."""
    with open_input(path) as f:
        members = directory(f)
        index, archive = members[INDEX], members[ARCHIVE]
        lines = _range(f, begins(f, index), index.size)
        if zlib.crc32(lines) != index.crc:
            raise ValueError(f"{path}: index is damaged")
        start = begins(f, archive)
        spans = [tuple(map(int, x.split(b" ", 2)[:2])) for x in lines.splitlines()]
        at = 0
        while at < len(spans):
            first, to = spans[at][0], at
            while to < len(spans) and (to == at or sum(spans[to]) - first <= read_bytes):
                to += 1
            raw = _range(f, start + first, sum(spans[to - 1]) - first)
            for begin, size in spans[at:to]:
                yield parse(gzip.decompress(raw[begin - first : begin - first + size]))
            at = to


def _urn(value: str | None) -> int | None:
    key = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(key) if key else None


def read_packages(spark: SparkSession, packages: Table) -> DataFrame:
    """A row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    A response's payload has to have the length and digest its header states.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names)
            )

        rows: list[tuple] = []
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for fields, payload in read_records(path):
                    size, said = int(fields["x-payload-length"]), fields["warc-payload-digest"]
                    kind, sha1 = fields["warc-type"], said.removeprefix("sha1:")
                    if kind == "response" and (len(payload), base32_sha1(payload)) != (size, sha1):
                        raise ValueError(f"{path}: a payload differs from its digest")
                    rows.append(
                        (
                            _urn(fields["warc-record-id"]), fields["warc-target-uri"], size, sha1,
                            kind, _urn(fields.get("warc-refers-to")),
                        )
                    )
                    if len(rows) >= 4096:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    return packages.df.repartition(max(packages.rows, 1), "path").mapInArrow(
        read,
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long",
    )
