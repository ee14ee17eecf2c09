"""WARC records in ZIP packages: writing them, and reading them back by ranges.

A package is a ZIP file whose members are stored, not compressed: archive/data.warc.gz holds the records, each one a
gzip member of its own, and indexes/index.cdxj one line per record with its offset and length in that member. A reader
needs only the end of the package, its directory (ZIP64 if the package or a member is large) and the index; it then
reads single records by range and never unpacks a member.

Paths are read and written by pyarrow's file systems, so a shared folder may be in any store they know.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costalloc.llm.common import materialize
from costalloc.session import run_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Fixed values of the ZIP format: signatures of its structures, and the marks that a ZIP64 field stands elsewhere.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
MARK16, MARK32 = 0xFFFF, 0xFFFFFFFF
ZIP64_FIELD = 1
DATE = "2024-01-01T00:00:00Z"  # records of the same pages are the same bytes in every run


# ZIP ----------------------------------------------------------------------


class Member(NamedTuple):
    name: str
    method: int
    offset: int  # of its local header
    packed: int
    size: int


def local_header(name: bytes, size: int, crc: int, zip64: bool) -> bytes:
    extra = struct.pack("<HHQQ", ZIP64_FIELD, 16, size, size) if zip64 else b""
    shown = MARK32 if zip64 else size
    return struct.pack("<4s5H3L2H", LOCAL, 45 if zip64 else 20, 0, 0, 0, 33, crc, shown, shown, len(name), len(extra)) + name + extra


def directory(members: list[tuple[bytes, int, int, int]], at: int, zip64: bool) -> bytes:
    """Central directory and end records for (name, offset, size, crc), beginning at `at`."""
    out = b""
    for name, offset, size, crc in members:
        extra = struct.pack("<HHQQQ", ZIP64_FIELD, 24, size, size, offset) if zip64 else b""
        shown, where = (MARK32, MARK32) if zip64 else (size, offset)
        version = 45 if zip64 else 20
        out += struct.pack(
            "<4s6H3L5H2L", CENTRAL, version, version, 0, 0, 0, 33, crc, shown, shown, len(name), len(extra), 0, 0, 0, 0, where
        )
        out += name + extra
    n, size = len(members), len(out)
    if zip64:
        out += struct.pack("<4sQ2H2L4Q", END64, 44, 45, 45, 0, 0, n, n, size, at)
        out += struct.pack("<4sLQL", LOCATOR64, 0, at + size, 1)
        return out + struct.pack("<4s4H2LH", END, 0, 0, MARK16, MARK16, MARK32, MARK32, 0)
    return out + struct.pack("<4s4H2LH", END, 0, 0, n, n, size, at, 0)


def read_directory(file) -> dict[str, Member]:
    """The members of a ZIP file, from its end; file: read_at(nbytes, offset), size()."""
    length = file.size()
    tail_at = max(0, length - 22 - MARK16)
    tail = file.read_at(length - tail_at, tail_at)
    end = tail.rfind(END)
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(END, 0, end)  # the signature may also stand in the comment
    if end < 0:
        raise ValueError("not a ZIP file: it has no end record")
    count, size, at = struct.unpack("<HLL", tail[end + 10 : end + 20])
    locator = file.read_at(20, tail_at + end - 20) if tail_at + end >= 20 else b""
    if locator[:4] == LOCATOR64:
        where = struct.unpack("<Q", locator[8:16])[0]
        record = file.read_at(56, where)
        if record[:4] != END64:
            raise ValueError("the ZIP64 end record is not where its locator says")
        count, size, at = struct.unpack("<QQQ", record[32:56])
    rows, found, p = file.read_at(size, at), {}, 0
    for _ in range(count):
        if rows[p : p + 4] != CENTRAL:
            raise ValueError("the central directory is damaged")
        method = int.from_bytes(rows[p + 10 : p + 12], "little")
        packed, full, n, m, k = struct.unpack("<LLHHH", rows[p + 20 : p + 34])
        offset = int.from_bytes(rows[p + 42 : p + 46], "little")
        name, extra = rows[p + 46 : p + 46 + n], rows[p + 46 + n : p + 46 + n + m]
        while len(extra) >= 4:
            kind, wide = struct.unpack("<HH", extra[:4])
            if kind == ZIP64_FIELD:  # holds those of the three that carry the mark, in this order
                field = extra[4 : 4 + wide]
                values = iter(struct.unpack(f"<{wide // 8}Q", field[: wide // 8 * 8]))
                full = next(values) if full == MARK32 else full
                packed = next(values) if packed == MARK32 else packed
                offset = next(values) if offset == MARK32 else offset
            extra = extra[4 + wide :]
        found[name.decode()] = Member(name.decode(), method, offset, packed, full)
        p += 46 + n + m + k
    return found


def data_range(file, member: Member) -> tuple[int, int]:
    """Where a stored member's bytes begin in the file, and how many they are."""
    if member.method:
        raise ValueError(f"{member.name} is compressed; its records can't be read by range")
    head = file.read_at(30, member.offset)
    if head[:4] != LOCAL:
        raise ValueError(f"{member.name} has no local header")
    n, m = struct.unpack("<HH", head[26:30])
    return member.offset + 30 + n + m, member.size


# WARC ---------------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    value = "none" if page_id is None else str(page_id)
    return f"<urn:page:{value}>"


def page_of(name: str | None) -> int | None:
    value = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return None if value in ("", "none") else int(value)


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response, or a revisit without the payload, of an HTTP exchange."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}"]
    head += [f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}"]
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(data: bytes) -> tuple[dict[str, str], bytes]:
    """The header lines (names in lower case) and what follows them."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, rest


def parse_record(data: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of one record.

    A response's length and digest are those of its payload; a revisit states those of the payload it stands for.
    """
    warc, rest = headers(data)
    block = rest[: int(warc["content-length"])]
    http, payload = headers(block)
    kind, stated = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha1:")
    size = int(http["content-length"])
    if kind == "response" and (len(payload) != size or bare_digest(payload) != stated):
        raise ValueError(f"record {warc['warc-record-id']} does not hold the payload it states")
    refers = page_of(warc.get("warc-refers-to")) if kind == "revisit" else None
    return page_of(warc["warc-record-id"]), size, stated, kind, refers


# Packages -----------------------------------------------------------------


def write_package(path: str, records: Iterable[tuple[str, bytes]], zip64: bool = True) -> None:
    """Write (index key, record) pairs as one package, streaming; a retry replaces the file as a whole.

    The sizes in the first local header are filled in by writing the data member beside the package first.
    """
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    part, lines = f"{place}.data", []
    crc = length = 0
    with store.open_output_stream(part, compression=None) as out:
        for key, record in records:
            packer = zlib.compressobj(1, zlib.DEFLATED, 31)
            packed = packer.compress(record) + packer.flush()
            entry = {"offset": length, "length": len(packed), "filename": "data.warc.gz"}
            lines.append(f"{key} {json.dumps(entry)}\n")
            out.write(packed)
            crc, length = zlib.crc32(packed, crc), length + len(packed)
    index = "".join(lines).encode()
    members, at = [], 0
    with store.open_output_stream(f"{place}.part", compression=None) as out:
        for name, size, check in ((DATA, length, crc), (INDEX, len(index), zlib.crc32(index))):
            members.append((name.encode(), at, size, check))
            head = local_header(name.encode(), size, check, zip64)
            out.write(head)
            if name == DATA:
                with store.open_input_stream(part, compression=None) as data:
                    while chunk := data.read(1 << 20):
                        out.write(chunk)
            else:
                out.write(index)
            at += len(head) + size
        out.write(directory(members, at, zip64))
    store.delete_file(part)
    store.move(f"{place}.part", place)


class _Ranges:
    """Range reads of a file in any store."""

    def __init__(self, path: str):
        store, place = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(place)

    def size(self) -> int:
        return self.file.size()

    def read_at(self, n: int, at: int) -> bytes:
        return self.file.read_at(n, at)


def read_package(path: str) -> Iterator[tuple[str, tuple]]:
    """(index key, parsed record) for every line of a package's index, by range reads."""
    file = _Ranges(path)
    members = read_directory(file)
    index_at, index_size = data_range(file, members[INDEX])
    data_at, data_size = data_range(file, members[DATA])
    for line in file.read_at(index_size, index_at).decode().splitlines():
        key, _, entry = line.partition(" ")
        place = json.loads(entry)
        if place["offset"] + place["length"] > data_size:
            raise ValueError(f"{path}: the index points beyond the data")
        packed = file.read_at(place["length"], data_at + place["offset"])
        yield key, parse_record(zlib.decompress(packed, 31))


# Spark --------------------------------------------------------------------


SALTS = 16


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, payload) with digest and refers_to: null for responses.

    Of pages with equal payloads of at least min_bytes bytes the smallest page_id is the response, and all rows
    repeated with that page_id; the others refer to it. A page without page_id is a revisit if its payload has a
    response, else a response. Only digests are grouped. Payloads are dealt by digest and by page over SALTS keys, so
    copies of one payload spread over as many tasks; only repeated digests, a few bytes each, are sent to all of them.
    """
    digest = F.sha1("payload")
    ids = pages.where(F.octet_length("payload") >= min_bytes).groupBy(digest.alias("digest"))
    first = ids.agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    first = first.where("copies > 1 AND first_id IS NOT NULL").select("digest", "first_id", salts)
    # from the row's own values, so that a task that runs again deals its rows alike
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    keys = pages.select("page_id", "url", "payload", digest.alias("digest"), salt.alias("salt"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return keys.join(first, ["digest", "salt"], "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_packages(pages: DataFrame, folder: str, min_bytes: int = 0, zip64: bool = True) -> DataFrame:
    """Write pages (page_id, url, html) as packages below folder, one per task; returns (path, records).

    A null html is an empty payload, a null url an empty target. Rows are dealt evenly over the tasks.
    """
    plain = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/part-{context.partitionId():06d}-{context.attemptNumber()}-{context.taskAttemptId()}.wacz"
        count = 0

        def records():
            nonlocal count
            for batch in batches:
                for page_id, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    count += 1
                    yield record_id(page_id), warc_record(page_id, url, payload, bare_digest(payload), refers)

        write_package(name, records(), zip64)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], names=["path", "records"])

    return with_revisits(plain, min_bytes).mapInArrow(run, "path string, records bigint")


RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_packages(packages: DataFrame) -> DataFrame:
    """One row per record of the packages named in the column path."""
    names = [field.split()[0] for field in RECORD.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths in batches:
            for path in paths.column(0).to_pylist():
                rows = []
                for _, record in read_package(path):
                    rows.append(record)
                    if len(rows) == 10_000:
                        yield batch(rows)
                        rows = []
                yield batch(rows)

    return packages.select("path").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages to packages in the shared folder and return what reading them gives.

    The list of packages is written too: packages of failed or repeated attempts are not on it and are not read.
    """
    folder = run_dir(pages.sparkSession, "packages")
    folder = folder if ":/" in folder else f"file://{folder}"
    packages = materialize(write_packages(pages, folder, min_bytes), "package-list")
    return read_packages(packages.repartition(max(1, packages.count())))
