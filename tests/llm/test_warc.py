"""Packages written, read back, and held against zipfile and a plain computation."""

import base64
import gzip
import hashlib
import io
import struct
import zipfile

import pytest

from costalloc.llm import warc
from tests.conftest import SMALL


class Bytes:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


def plain(rows, least=0):
    first = {}
    for page_id, html in rows:
        if page_id is not None and len(html) >= least:
            first[html] = min(first.get(html, page_id), page_id)
    out = []
    for page_id, html in rows:
        refers = first.get(html)
        refers = None if refers == page_id else refers
        digest = base64.b32encode(hashlib.sha1(html).digest()).decode()
        out.append((page_id, len(html), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_round_trip(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    odd = [(10_000, None, None), (10_001, "u", ""), (10_002, "a\r\nb", "same é\r\n\r\n"), (10_003, None, "same é\r\n\r\n"),
           (10_003, None, "same é\r\n\r\n"), (None, "n", "same é\r\n\r\n"), (None, None, "alone"), (10_004, "x", "long " * 100_000)]
    pages = pages.unionByName(spark.createDataFrame(odd, "page_id bigint, url string, html string"))
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    for least in (0, 5):
        got = sorted(map(tuple, warc.round_trip(pages, least).collect()), key=repr)
        assert got == plain(rows, least)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_copies_of_one_payload_spread(spark):
    pages = spark.range(4_000).selectExpr("id AS page_id", "concat('u', id) AS url", "CAST('same' AS BINARY) AS payload")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = warc.with_revisits(pages).select("page_id", "refers_to", warc.F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {r.page_id: r.refers_to for r in rows} == {i: 0 if i else None for i in range(4_000)}
    sizes = [sum(r.task == t for r in rows) for t in {r.task for r in rows}]
    assert len(sizes) > 8 and max(sizes) < 1_500


@pytest.mark.parametrize("zip64", [True, False])
def test_other_readers_accept_a_package(tmp_path, zip64):
    path = f"file://{tmp_path}/a.wacz"
    records = [(warc.record_id(i), warc.warc_record(i, "u", b"x" * i, warc.bare_digest(b"x" * i), None)) for i in range(5)]
    warc.write_package(path, records, zip64)
    with zipfile.ZipFile(f"{tmp_path}/a.wacz") as package:
        assert package.testzip() is None
        assert gzip.decompress(package.read(warc.DATA)) == b"".join(r for _, r in records)
        assert len(package.read(warc.INDEX).splitlines()) == 5
    assert [p[0] for _, p in warc.read_package(path)] == list(range(5))


def test_directories_of_other_writers():
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as package:
        package.writestr(warc.DATA, b"12345")
        with package.open("big", "w", force_zip64=True) as member:
            member.write(b"abc")
        package.writestr(zipfile.ZipInfo("packed"), b"z" * 50, zipfile.ZIP_DEFLATED)
        package.comment = b"a comment with PK\5\6 in it"
    file = Bytes(data.getvalue())
    members = warc.read_directory(file)
    at, size = warc.data_range(file, members["big"])
    assert file.read_at(size, at) == b"abc" and set(members) == {warc.DATA, "big", "packed"}
    with pytest.raises(ValueError):
        warc.data_range(file, members["packed"])
    with pytest.raises(ValueError):
        warc.read_directory(Bytes(b"no archive"))


def test_offsets_beyond_four_gigabytes():
    """A directory whose member begins far behind 4 GB, without writing that much."""
    at = 5 << 30
    rows = warc.directory([(b"m", at - 100, 70, 0)], at, zip64=True)

    class Sparse(Bytes):
        def size(self):
            return at + len(rows)

        def read_at(self, n, where):
            return rows[max(0, where - at) : max(0, where - at) + n] if where + n > at else b"\0" * n

    sparse = Sparse(rows)
    sparse.read_at = lambda n, where: (b"\0" * max(0, min(n, at - where)) + rows[max(0, where - at) : max(0, where + n - at)])
    member = warc.read_directory(sparse)["m"]
    assert (member.offset, member.size) == (at - 100, 70)
    assert struct.calcsize("<4s6H3L5H2L") == 46
