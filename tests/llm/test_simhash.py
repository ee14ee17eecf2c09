"""SimHash near-duplicates against a plain computation over all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from costalloc.llm import simhash
from tests.conftest import SMALL


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, distance=3):
    """{doc_id: smallest reachable} of (doc_id, fingerprint)."""
    root = {d: d for d, _ in pairs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(pairs):
        for b, y in pairs[i + 1 :]:
            if (x ^ y).bit_count() <= distance:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in root}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    pairs = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    assert {d: f"{f:016x}" for d, f in pairs} == {d: r.fingerprint for d, r in got.items()}
    assert plain_components(pairs) == {d: r.component_id for d, r in got.items()}


@pytest.mark.parametrize("hot", [simhash.HOT, 20])
def test_links_find_every_near_pair(spark, hot):
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fps = set()
    for c in centres:
        for _ in range(12):
            f = int(c)
            for bit in rng.integers(0, 64, rng.integers(0, 5)):
                f ^= 1 << int(bit)
            fps.add(f)
    pairs = list(enumerate(sorted(fps)))
    rows = [(f - (1 << 64) if f >> 63 else f, i) for i, f in pairs]
    from costalloc.llm.graph import components

    got = components(simhash.links(spark.createDataFrame(rows, "fp bigint, node bigint"), 3, hot)).collect()
    roots = {r.node: r.root for r in got}
    assert plain_components(pairs) == {i: roots.get(i, i) for i, _ in pairs}


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b c d e f", "x"), (5, "a b c d e f", None), (4, "A B C d e f", "y"),
            (7, "one", "y"), (7, "one", "y"), (9, "word " * 50_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == "0" * 16 and by[2].component_id == 1
    assert by[5].component_id == 4 and by[None].component_id == 4
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 4), (False, 7), (False, 9), (True, 0)]
    assert simhash.near_duplicates(docs.where(F.lit(False))).count() == 0


def test_one_doc_id_with_different_texts(spark):
    """Texts that are not near all stay, whatever their doc_id; which of equal rows stays is fixed."""
    a, b, c = ("alpha beta gamma delta " * 9, "one two three four five six " * 9, "red green blue " * 12)
    rows = [(5, a, "z"), (5, a, "y"), (5, b, "x"), (3, b, "w"), (7, a.upper(), "v"), (9, c, "u"), (9, c, "t"), (None, a, "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for frame in (docs, docs.repartition(3), docs.orderBy("source")):
        kept = simhash.drop_near_duplicates(frame)
        assert kept.columns == docs.columns
        assert sorted(r.source for r in kept.collect()) == ["s", "t", "w", "y"]
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()} == {(5, 5), (5, 3), (3, 3), (7, 5), (9, 9), (None, 5)}


def test_columns_of_any_type(spark):
    """Maps can't be ordered or grouped; rows alike in id and fingerprint still become one."""
    rows = [(1, "a b c " * 20, {"k": 1}, [{"x": 2}]), (1, "a b c " * 20, {"k": 1}, [{"x": 2}]), (1, "a b c " * 20, None, []), (2, "d e f g h " * 30, {}, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, m map<string,int>, a array<map<string,int>>")
    docs = docs.withColumn("odd name", F.create_map(F.lit("q"), F.struct(F.lit(1).alias("in side"))))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
