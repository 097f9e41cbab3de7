"""Web archives packed in ZIP files, read by ranges without unpacking.

An archive is a ZIP file whose members are stored, not compressed: a WARC file of one gzip
member per record, and an index with the place of each. A reader needs the end of the ZIP file,
its central directory (also in the ZIP64 form), the index, and then only the ranges of the
records it wants.

Each task writes archives of its own under names no other attempt uses, and the
archives that count are those in the written list; what a lost attempt left
behind is never read. Blocks of neighbouring records are read by one request each
and are spread over all tasks.

Defined cases. A NULL payload is empty. Among equal payloads of at least ``min_revisit_bytes``
the row with the largest key is the response, and so is every repeated row of that key; the
others revisit it. NULL keys are the smallest; where only NULL keys
share a payload, all are responses. Line breaks in a URL are percent-encoded; a NULL URL is left
out. An empty table gives no archives and an empty result. Only the named columns
are read, so other columns cannot clash.
"""

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolens.llm.tables import bound_batches
from ludolens.scratch import broadcast_small, scratch_path, write_scratch

MIN_REVISIT_BYTES = 0
ARCHIVE_BYTES = 256 << 20
BLOCK_BYTES = 4 << 20
MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

# Fixed values of the ZIP and WARC formats.
_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
_END_SIZE, _LONGEST_COMMENT, _STORED = 22, 0xFFFF, 0
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_KEY_URN = "urn:key:"

RECORD = (
    "record_id string, record_type string, url string, date string, payload_digest string,"
    " payload_bytes bigint, refers_to string, payload binary"
)


def _open(path: str) -> BinaryIO:
    system, inside = fs.FileSystem.from_uri(path)
    return system.open_input_file(inside)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(
    record_id: str, url: str | None, date: str, payload: bytes, digest: str, refers_to: str | None
) -> bytes:
    """One record: a response with its payload, or a revisit with the response's header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": url and quote(url, safe="".join(map(chr, range(33, 127)))),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Refers-To": refers_to and f"<{refers_to}>",
        "WARC-Profile": refers_to and _REVISIT,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = [f"{name}: {value}" for name, value in head.items() if value is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def parse_record(record: bytes) -> tuple:
    """The columns of ``RECORD``; a response whose payload is not what its digest says is an error."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http_head, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and digest_of(payload) != digest:
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    refers_to = fields.get("warc-refers-to")
    return (
        fields["warc-record-id"].strip("<>"),
        fields["warc-type"],
        fields.get("warc-target-uri"),
        fields.get("warc-date"),
        digest,
        int(_fields(http_head)["content-length"]),
        refers_to and refers_to.strip("<>"),
        payload if fields["warc-type"] == "response" else None,
    )


class Member(NamedTuple):
    name: str
    method: int
    size: int
    header: int  # where its local header starts


def members(file: BinaryIO, size: int) -> list[Member]:
    """The central directory of a ZIP file of ``size`` bytes, in either form."""

    def read(at: int, length: int) -> bytes:
        file.seek(at)
        return file.read(length)

    tail_at = max(0, size - _END_SIZE - _LONGEST_COMMENT)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(_END)
    if end < 0:
        raise ValueError("no ZIP directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = tail_at + end - 20
    if locator >= 0 and (found := read(locator, 20))[:4] == _LOCATOR64:
        end64 = read(struct.unpack_from("<Q", found, 8)[0], 56)
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 directory")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, at, out = read(start, length), 0, []
    for _ in range(count):
        if directory[at : at + 4] != _ENTRY:
            raise ValueError("damaged ZIP directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, full = struct.unpack_from("<II", directory, at + 20)
        name_len, extra_len, comment_len = struct.unpack_from("<HHH", directory, at + 28)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + name_len].decode()
        extra = directory[at + 46 + name_len : at + 46 + name_len + extra_len]
        packed, header = _long_values(extra, full, packed, header)
        out.append(Member(name, method, packed, header))
        at += 46 + name_len + extra_len + comment_len
    return out


def _long_values(extra: bytes, full: int, packed: int, header: int) -> tuple[int, int]:
    """Packed size and header place; those that fill 32 bits stand in the ZIP64 field, in this order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            longs = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            if full == 0xFFFFFFFF:
                next(longs)
            packed = next(longs) if packed == 0xFFFFFFFF else packed
            header = next(longs) if header == 0xFFFFFFFF else header
        at += 4 + length
    return packed, header


def member_range(file: BinaryIO, member: Member) -> tuple[int, int]:
    """Where the bytes of a stored member lie in the ZIP file."""
    if member.method != _STORED:
        raise ValueError(f"{member.name} is compressed and has no ranges")
    file.seek(member.header)
    local = file.read(30)
    if local[:4] != _LOCAL:
        raise ValueError("damaged ZIP member")
    name_len, extra_len = struct.unpack_from("<HH", local, 26)
    return member.header + 30 + name_len + extra_len, member.size


def record_ranges(file: BinaryIO, size: int) -> list[tuple[int, int]]:
    """Offset and length of each record in the ZIP file, by its indexes, in order of place."""
    found = {m.name: m for m in members(file, size)}
    ranges = []
    for name, member in found.items():
        if name.startswith("indexes/"):
            start, length = member_range(file, member)
            file.seek(start)
            for line in file.read(length).splitlines():
                entry = json.loads(line[line.index(b"{") :])
                archive, _ = member_range(file, found[f"archive/{entry['filename']}"])
                ranges.append((archive + int(entry["offset"]), int(entry["length"])))
    return sorted(ranges)


class _Writer:
    """One archive: records are appended, the index is written on closing."""

    def __init__(self, folder: str) -> None:
        self.path = f"{folder}/{uuid.uuid4().hex}.zip"
        system, inside = fs.FileSystem.from_uri(self.path)
        system.create_dir(inside.rpartition("/")[0], recursive=True)
        self.file = system.open_output_stream(inside)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(MEMBER, "w", force_zip64=True)
        self.index, self.size = [], 0

    def add(self, url: str | None, date: str, digest: str, record: bytes) -> None:
        packed = gzip.compress(record, 6, mtime=0)
        place = {"offset": str(self.size), "length": str(len(packed)), "digest": f"sha1:{digest}"}
        stamp = "".join(c for c in date if c.isdigit())
        where = quote(url or "-", safe="".join(map(chr, range(33, 127))))
        self.index.append(f"{where} {stamp} " + json.dumps(place | {"filename": MEMBER.rpartition("/")[2]}))
        self.member.write(packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(INDEX, "\n".join(sorted(self.index)) + "\n")
        self.zip.close()
        self.file.close()
        return self.path, len(self.index)


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "2000-01-01T00:00:00Z",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row into archives under ``folder``; returns their paths and record counts."""
    bound_batches(pages.sparkSession)
    content = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), content.alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    # Tasks reduce their own rows first, so a payload shared by a third of all rows is one row each.
    shared = write_scratch(
        rows.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("sha1")
        .agg(F.max("key").alias("largest"), F.count("*").alias("n"))
        .where("n > 1 and largest is not null")
        .select(F.col("sha1").alias("same"), "largest")
    )
    revisits = ~F.col("key").eqNullSafe(F.col("largest")) & F.col("largest").isNotNull()
    records = rows.join(broadcast_small(shared), F.col("sha1") == F.col("same"), "left").select(
        F.col("key").cast("string"),
        "url",
        "payload",
        F.when(revisits, F.col("largest")).cast("string").alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for name, where, body, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                writer = writer or _Writer(folder)
                digest = digest_of(body)
                record_id = f"{_KEY_URN}{name}" if name is not None else uuid.uuid4().urn
                target = refers_to and f"{_KEY_URN}{refers_to}"
                writer.add(where, date, digest, record_bytes(record_id, where, date, body, digest, target))
                if writer.size >= archive_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())],
            ["path", "records"],
        )

    return write_scratch(records.mapInArrow(write, "path string, records bigint"))


def read_archives(archives: DataFrame, path: str = "path", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The records of the archives at ``path``, with the columns of ``RECORD``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                with _open(place) as file:
                    ranges = record_ranges(file, file.size())
                out: list[list[tuple[int, int]]] = []
                for start, length in ranges:
                    block = out[-1] if out else None
                    joins = block and sum(block[-1]) == start
                    if not joins or start + length - block[0][0] > block_bytes:
                        out.append([])
                    out[-1].append((start, length))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([place] * len(out), pa.string()),
                        pa.array([b[0][0] for b in out], pa.int64()),
                        pa.array([[n for _, n in b] for b in out], pa.list_(pa.int64())),
                    ],
                    ["path", "start", "lengths"],
                )

    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = [pa.binary() if n == "payload" else pa.int64() if n == "payload_bytes" else pa.string() for n in names]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with _open(place) as file:
                    file.seek(start)
                    block = io.BytesIO(file.read(sum(lengths)))
                found = [parse_record(gzip.decompress(block.read(n))) for n in lengths]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*found), kinds)], names
                )

    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = archives.select(path).repartition(parts).mapInArrow(
        blocks, "path string, start bigint, lengths array<bigint>"
    )
    return listed.repartition(parts).mapInArrow(records, RECORD)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared scratch folder."""
    return scratch_path(spark)


def key_of(record_id: str, kind: str):
    """The key in a record id column as ``kind``; NULL for records of rows without a key."""
    return F.when(
        F.col(record_id).startswith(_KEY_URN), F.substring(F.col(record_id), len(_KEY_URN) + 1, 1 << 20)
    ).cast(kind)
