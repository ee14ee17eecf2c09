"""Packing documents into token sequences along a Hilbert curve.

A document's token ids are hashed into a count vector, which a fixed random matrix projects to a few numbers. Their
place on a Hilbert curve is the sort key, so that similar documents lie close together. Each range of the curve is
packed by one task: documents follow each other without gaps and are cut wherever a sequence is full. What is left at
the end of a range is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costalloc.llm.common import U, fmix, materialize, text_or_empty

SEQUENCE = 2048
END_ID = 1
DIMENSIONS, BITS = 4, 10
VECTOR = 512  # places of the hashed count vector
# Texts of other characters go to the slower library, whose tables of characters may be of another age.
PLAIN = re.compile(r"[\x00-\u0377\u0400-\u052f\u2010-\u2027\u20ac]*")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write bytes as letters: printable ones as themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(others)}


_LETTERS = _byte_letters()


class Encoder:
    """Token ids of texts by a byte-level tokenizer file.

    Two libraries read the same vocabulary: its ids are in the order of its merges, so they serve as ranks for the
    library that is several times as fast.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        added = {t.content for t in self.slow.get_added_tokens_decoder().values()}
        self.added = re.compile("|".join(map(re.escape, sorted(added))) or "(?!)")  # such a string in a text is one token
        words = self.slow.get_vocab(with_added_tokens=True)
        ranks = {bytes(_LETTERS[c] for c in word): i for word, i in words.items() if word not in added}
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if (text.isascii() or PLAIN.fullmatch(text)) and not self.added.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def projection() -> np.ndarray:
    """VECTOR x DIMENSIONS fixed signs."""
    bits = fmix(np.arange(1, VECTOR * DIMENSIONS + 1, dtype=U) * U(0x9E3779B97F4A7C15)) >> U(63)
    return (2.0 * bits.astype(float) - 1.0).reshape(VECTOR, DIMENSIONS)


# The place of each token id in the hashed count vector.
_PLACES = (fmix(np.arange(1, (1 << 16) + 1, dtype=U)) >> U(65 - VECTOR.bit_length())).astype(np.int64)


def coordinates(ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Where a document lies: DIMENSIONS whole numbers below 2**BITS."""
    vector = np.sqrt(np.bincount(_PLACES[ids], minlength=VECTOR))
    spread = vector @ matrix / max(1e-9, np.sqrt((vector**2).sum()))
    # unit vectors project to about -1..1 each; the logistic keeps outliers apart without a cut
    unit = 1 / (1 + np.exp(-2.0 * spread))
    return np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole numbers below 2**bits.

    Gray-codes the coordinates and undoes the rotation of each sub-cube, from the highest bit down.
    """
    x = [points[:, i].astype(np.int64).copy() for i in range(points.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(x[0]), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros(len(x[0]), np.int64)
    x = [v ^ turn for v in x]
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | ((v >> b) & 1)
    return key


TOKENS = "doc_id bigint, place bigint, n_tokens bigint, ids binary"


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, place on the curve, n_tokens, ids as 16-bit numbers) of every document, END_ID included."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, matrix = Encoder(path), projection()
        for batch in batches:
            told, points = [], []
            for text in batch.column(1).to_pylist():
                ids = np.append(encoder.encode(text), np.uint32(END_ID))
                points.append(coordinates(ids, matrix))  # an id beyond 16 bits has no place and ends the task
                told.append(ids.astype("<u2"))
            if not told:
                continue
            columns = [
                batch.column(0),
                pa.array(hilbert_keys(np.array(points))),
                pa.array([len(ids) for ids in told], pa.int64()),
                pa.array([ids.tobytes() for ids in told], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "place", "n_tokens", "ids"])

    texts = docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text"))
    return texts.mapInArrow(run, TOKENS)


PLACE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
PIECE = PLACE + ", ids binary"


class Packer:
    """Fills sequences with documents in turn; the last of them is cut again at the end."""

    def __init__(self, first_id: int, sequence: int):
        self.next_id, self.sequence, self.used = first_id, sequence, 0
        self.open: list[tuple] = []  # pieces of the sequence that is being filled

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        """The pieces of the sequences that are full now: (doc_id, start, ids, doc_tokens, sequence_id, offset)."""
        out, start = [], 0
        while start < len(ids):
            n = min(len(ids) - start, self.sequence - self.used)
            self.open.append((doc_id, start, ids[start : start + n], len(ids), self.next_id, self.used))
            start, self.used = start + n, self.used + n
            if self.used == self.sequence:
                out += self.open
                self.open, self.used, self.next_id = [], 0, self.next_id + 1
        return out

    def close(self) -> list[tuple]:
        """What is left, cut into sequences whose lengths are powers of two, the longest first."""
        edges = [0]
        for bit in range(self.used.bit_length() - 1, -1, -1):
            if self.used >> bit & 1:
                edges.append(edges[-1] + (1 << bit))
        out = []
        for doc_id, start, ids, total, _, offset in self.open:
            for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
                s, e = max(offset, low), min(offset + len(ids), high)
                if s < e:
                    out.append((doc_id, start + s - offset, ids[s - offset : e - offset], total, self.next_id + k, s - low))
        self.open, self.used, self.next_id = [], 0, self.next_id + len(edges) - 1
        return out


def _pack(sequence: int, with_ids: bool):
    names = [field.split()[0] for field in (PIECE if with_ids else PLACE).split(", ")]
    types = [pa.int64()] * 7 + [pa.binary()] * with_ids

    def told(pieces: list[tuple]) -> pa.RecordBatch:
        rows = []
        for doc_id, start, ids, total, number, offset in pieces:
            data = ids.astype("<u4").tobytes()
            row = (doc_id, start, len(ids), zlib.crc32(data), total, number, offset)
            rows.append((*row, ids.tobytes()) if with_ids else row)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = None
        for batch in batches:
            pieces = []
            for task, doc_id, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                packer = packer or Packer(task << 32, sequence)
                pieces += packer.add(doc_id, np.frombuffer(ids, "<u2"))
            if pieces:
                yield told(pieces)
        if packer and (pieces := packer.close()):
            yield told(pieces)

    return run


def pack(docs: DataFrame, sequence: int = SEQUENCE, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document: which ids of it lie where in which sequence (and the ids, 16 bits each).

    docs: doc_id, text; a null or empty text is the one token END_ID. Each id of each row lies in exactly one piece.
    Sequences hold `sequence` tokens; only the last ones of a range of the curve are shorter, and those hold a power
    of two, so nothing is padded. Equal texts share a place on the curve; ties are cut by doc_id and a row number, so a
    large group of copies is spread over ranges. Rows without doc_id and repeated rows are packed like others. Other
    columns are ignored. path: a tokenizer file of fewer than 65,536 ids that every executor can open.
    """
    tokens = materialize(tokenized(docs, path).withColumn("row", F.monotonically_increasing_id()), "tokens")
    ordered = tokens.repartitionByRange("place", "doc_id", "row").sortWithinPartitions("place", "doc_id", "row")
    rows = ordered.select(F.spark_partition_id().cast("bigint").alias("task"), "doc_id", "ids")
    return rows.mapInArrow(_pack(sequence, with_ids), PIECE if with_ids else PLACE)
