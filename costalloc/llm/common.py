"""Helpers of the operators: scratch tables, blocks of documents, words as arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text. Words are
handled as numpy arrays over a whole Arrow batch: positions, document numbers and 64-bit hashes.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import costalloc
from costalloc.session import run_dir

U = np.uint64
SEGMENT = 1 << 17  # bytes hashed at once; a longer word makes its segment longer

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def fmix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (the finishing step of a common public hash)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_CODES = fmix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the odd base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SEGMENT) + 1
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, U)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers[0], _powers[1]


def hash_slices(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, beginning: int = 0
) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """64-bit hash of data[s:e] for ascending, disjoint slices; equal bytes have equal hashes.

    With `beginning` also the hashes of the first so many bytes of each.
    """
    out = np.empty((2 if beginning else 1, len(starts)), U)
    codes = _CODES[LOWER] if lower else _CODES
    i = 0
    while i < len(starts):
        first = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, first + SEGMENT, side="right")))
        piece = data[first : int(ends[j - 1])]
        power, inverse = _power_tables(len(piece))
        sums = np.zeros(len(piece) + 1, U)
        np.cumsum(codes[piece] * power[: len(piece)], out=sums[1:])
        s, e = starts[i:j] - first, ends[i:j] - first
        for row, end in enumerate((e, np.minimum(e, s + beginning))[: len(out)]):
            out[row, i:j] = fmix((sums[end] - sums[s]) * inverse[s] + (end - s).astype(U) * U(0x9E3779B97F4A7C15))
        i = j
    return (out[0], out[1]) if beginning else out[0]


class Words:
    """The words of some documents: bytes, places, and the document each one belongs to."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = IS_SPACE):
        """breaks: for each byte, whether it parts words."""
        offsets = offsets.astype(np.int64)
        self.data = data = data[offsets[0] : offsets[-1]]
        self.offsets = offsets = offsets - offsets[0]
        self.n_docs, n = len(offsets) - 1, len(data)
        self.inside = inside = ~breaks[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        self.mark(cut)
        first, last = inside.copy(), inside.copy()
        if n:
            first[1:] &= ~inside[:-1] | cut[1:n]
            last[:-1] &= ~inside[1:] | cut[1:n]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])  # first word of each document

    def mark(self, cut: np.ndarray) -> None:
        """For kinds of words that are not parted by bytes alone: change `inside`, and where words are cut."""

    def hashes(self, lower: bool = False) -> np.ndarray:
        return hash_slices(self.data, self.starts, self.ends, lower)

    def per_byte(self, table: np.ndarray) -> np.ndarray:
        """For each document, the sum of table over its bytes."""
        sums = np.concatenate([[0], np.cumsum(table[self.data], dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def windows(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `size` words (by first word), and whether it stays in one document."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, U), np.empty(0, bool)
    out = np.zeros(n, U)
    for j in range(size):
        out = out * U(0x2545F4914F6CDD1D) + hashes[j : n + j]
    return fmix(out), doc[:n] == doc[size - 1 :]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a text or binary column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def slices(offsets: np.ndarray, limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about `limit` bytes (one document may be longer)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = j


def batched_words(
    column: pa.Array, limit: int = 1 << 21, breaks: np.ndarray = IS_SPACE, kind: type[Words] = Words
) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) over a column, a few MB at a time."""
    data, offsets = buffers(column)
    for i, j in slices(offsets, limit):
        yield i, j, kind(data, offsets[i : j + 1], breaks)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def materialize(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the folder that all executors share, and read them back.

    Cuts the lineage: a lost executor costs no more than the files not written yet.
    """
    spark = rows.sparkSession
    path = run_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def n_blocks(docs: DataFrame, column: str = "text", block_bytes: int = 8 << 20) -> int:
    """How many blocks of about block_bytes the texts make: grows with the data."""
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, -(-int(total) // block_bytes))


def block_of(n: int, *columns: str) -> Column:
    """The block of a row, by a hash of the given columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


ADDED = "segment int, numbers binary"
ADDED_SEGMENT = 1 << 13


def added_up(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks of the array of `size` whole numbers that `count` makes of a task's batches.

    The size is fixed, whatever the rows. Arrays travel in segments, each added up in one task, streaming.
    """
    step = ADDED_SEGMENT

    def segments(numbers: np.ndarray, which: list[int]) -> pa.RecordBatch:
        data = [zlib.compress(numbers[s * step : (s + 1) * step].astype("<i8").tobytes(), 1) for s in which]
        return pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(data, pa.binary())], names=["segment", "numbers"])

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(batches)
        yield segments(numbers, [s for s in range(-(-size // step)) if numbers[s * step : (s + 1) * step].any()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, seen = np.zeros(size, np.int64), set()
        for batch in batches:
            for s, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                numbers[s * step : (s + 1) * step] += np.frombuffer(zlib.decompress(data), "<i8")
                seen.add(s)
        yield segments(numbers, sorted(seen))

    out = np.zeros(size, np.int64)
    for row in rows.mapInArrow(one, ADDED).repartition("segment").mapInArrow(add, ADDED).collect():
        out[row.segment * step : (row.segment + 1) * step] = np.frombuffer(zlib.decompress(row.numbers), "<i8")
    return out


def whole_groups(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Tables of about `least` rows that end where the first column, by which rows are sorted, changes."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count > least:
            rows = pa.Table.from_batches(held)
            key = rows.column(0).to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield rows.slice(0, cut)
                held, count = rows.slice(cut).to_batches(), rows.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def semi_join(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is among ids."""
    return docs.join(ids.select("doc_id"), "doc_id", "left_semi").select(docs.columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the workers of this session import the package, wherever they run.

    Adds it to the session's Python files once, unless the workers find it on PYTHONPATH.
    """
    context = spark.sparkContext
    root = Path(costalloc.__file__).resolve().parent
    on_path = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root.parent in on_path or context.applicationId in _shipped:
        return
    bundle = Path(tempfile.mkdtemp(prefix="costalloc-code-")) / "costalloc.zip"
    with zipfile.ZipFile(bundle, "w") as out:
        for file in root.rglob("*.py"):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(bundle))
    _shipped.add(context.applicationId)
