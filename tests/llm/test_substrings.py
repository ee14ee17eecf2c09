"""Removal of repeated runs against a plain computation over all of them."""

import hashlib
import random
import re

import pytest

from pyspark.sql import functions as F

from costalloc.llm import substrings
from tests.conftest import SMALL

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain(rows, size=13):
    """{(doc_id, text): (n_words, n_removed, digest)}"""
    split = [(d, t, WORD.findall((t or "").encode())) for d, t in rows]
    first = {}
    for d, _, words in split:
        for i in range(len(words) - size + 1):
            run = tuple(words[i : i + size])
            if d is not None:
                first[run] = min(first.get(run, d), d)
    out = []
    for d, _, words in split:
        gone = set()
        for i in range(len(words) - size + 1):
            if d is not None and first[tuple(words[i : i + size])] < d:
                gone |= set(range(i, i + size))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def told(frame, **how):
    rows = substrings.remove_repeats(frame, digest=True, **how).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=repr)


@pytest.mark.parametrize("hot", [substrings.HOT, 1])
def test_whole_table(spark, hot, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    monkeypatch.setattr(substrings, "n_blocks", lambda docs: 7)
    assert told(docs, hot=hot) == want and sum(r[2] for r in want) > 1000


def test_many_overlaps(spark, monkeypatch):
    rng = random.Random(4)
    pool = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(40)) for _ in range(6)]
    rows = []
    for d in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            words = rng.choice(pool).split()
            a = rng.randint(0, 30)
            parts += words[a : a + rng.randint(5, 30)] + [f"n{rng.randint(0, 99)}"] * rng.randint(0, 2)
        rows.append((rng.randint(0, 50), " ".join(parts)))
    monkeypatch.setattr(substrings, "n_blocks", lambda docs: 5)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for hot in (1, 5, 10**6):
        assert told(frame, hot=hot) == plain(rows)


def test_automaton():
    rng = random.Random(1)
    for _ in range(200):
        texts = [[rng.randint(0, 2) for _ in range(rng.randint(1, 25))] for _ in range(rng.randint(1, 6))]
        automaton = substrings.Automaton()
        for d, text in enumerate(texts):
            automaton.add(text, d)
        automaton.finish()
        query = [rng.randint(0, 2) for _ in range(30)]
        for size in (1, 3, 6):
            want = []
            for i in range(len(query)):
                run = query[max(0, i + 1 - size) : i + 1]
                holds = [d for d, t in enumerate(texts) if any(t[k : k + size] == run for k in range(len(t)))]
                want.append(min(holds) if len(run) == size and holds else substrings.NONE)
            assert automaton.statistics(query, size) == want


def test_odd_rows(spark):
    line = " ".join(f"w{i}" for i in range(20))
    rows = [(1, None), (2, ""), (None, line), (3, "x " + line.replace(" ", "\n")), (3, "x " + line), (4, line), (4, line), (5, "a " * 40_000),
            (6, "a " * 20_000 + line), (7, "short text"), (8, "short text")]
    frame = spark.createDataFrame([(d, t, "p", 1.5) for d, t in rows], "doc_id bigint, text string, block string, c2 double")
    assert told(frame) == plain(rows)
    out = substrings.remove_repeats(frame)
    assert out.columns == [*frame.columns, "n_words", "n_removed"]
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert (3, "x " + line.replace(" ", "\n")) in got and (4, "") in got and (6, "") in got and (None, line) in got
    assert substrings.remove_repeats(frame.limit(0)).count() == 0


def test_columns_of_any_type(spark):
    rows = [(1, "a b c d e f g " * 9, {"k": 1}, [{"x": 2}]), (2, "a b c d e f g " * 9, None, [])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, m map<string,int>, a array<map<string,int>>")
    docs = docs.withColumn("odd name", F.create_map(F.lit("q"), F.struct(F.lit(1).alias("in side"))))
    got = substrings.remove_repeats(docs).orderBy("doc_id").collect()
    assert [(r.doc_id, r.m, r.n_removed > 0) for r in got] == [(1, {"k": 1}, False), (2, None, True)]
    assert got[0]["odd name"]["q"]["in side"] == 1
