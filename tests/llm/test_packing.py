"""Packing: every id in exactly one place, and equal to the tokenizer's."""

import collections
import zlib

import numpy as np
from tokenizers import Tokenizer

from costalloc.llm import packing
from tests.conftest import SMALL


def check(pieces, texts):
    """pieces: rows; texts: [(doc_id, text)] with unique ids."""
    slow = Tokenizer.from_file(packing.vocabulary_path())
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == {d for d, _ in texts}
    for doc_id, text in texts:
        ids = [*slow.encode(text or "", add_special_tokens=False).ids, 1]
        place = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert p.start == place and p.length > 0 and p.doc_tokens == len(ids)
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            place += p.length
        assert place == len(ids)
    for parts in by_sequence.values():
        place = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == place
            place += p.length
        assert place == 2048 or place < 2048 and place & (place - 1) == 0
    return by_sequence


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = packing.pack(docs).collect()
    sequences = check(pieces, texts)
    total = sum(p.length for p in pieces)
    assert len(sequences) <= total / 2048 + 11 * 4


def test_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, "<|endoftext|> it's  é\t\n ñ　中文 😀 \x85\xa0 1234"), (4, "word " * 30_000), (5, " "), (6, "＃ ǆ 𝒳")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in texts], "doc_id bigint, text string, ids string")
    check(packing.pack(docs).collect(), texts)
    more = docs.unionByName(spark.createDataFrame([(None, "a", "x"), (2, "", "y")], docs.schema))
    pieces = packing.pack(more).collect()
    assert sum(p.start == 0 for p in pieces) == 8 and sum(p.doc_id is None for p in pieces) == 1
    assert packing.pack(docs.limit(0)).count() == 0


def test_libraries_agree_on_plain_characters():
    encoder = packing.Encoder(packing.vocabulary_path())
    for point in range(0x2100):
        c = chr(point)
        if packing.PLAIN.fullmatch(c):
            text = f"a{c}b {c}{c} x1{c}2  {c}\n{c}"
            assert encoder.encode(text).tolist() == encoder.slow.encode(text, add_special_tokens=False).ids, hex(point)


def test_strings_of_added_tokens_are_as_the_library_has_them():
    encoder = packing.Encoder(packing.vocabulary_path())
    plain = Tokenizer.from_file(packing.vocabulary_path())
    for text in ("<|endoftext|> x", "a<|endoftext|><|endoftext|>b", "<|endoftext|", "<|im_start|>é 中", "x"):
        assert encoder.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert encoder.encode("<|endoftext|> x").tolist()[0] > 50_000


def test_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
        keys = packing.hilbert_keys(points, bits)
        assert sorted(keys) == list(range(1 << bits * n))
        assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_similar_texts_are_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.tokenized(docs).join(docs.select("doc_id", "lang"), "doc_id").orderBy("place").collect()
    same = sum(a.lang == b.lang for a, b in zip(rows, rows[1:], strict=False)) / len(rows)
    shares = collections.Counter(r.lang for r in rows)
    chance = sum((n / len(rows)) ** 2 for n in shares.values())
    assert same > chance + 0.15
