"""Greedy string tiling against a plain form of it."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from costalloc.llm import decontam
from tests.conftest import SMALL

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def tokens(text):
    return [w.lower() for w in TOKEN.findall((text or "").encode())]


def plain_covered(item, text, least=5):
    """Tokens of item under tiles: the longest common run of unmarked tokens is marked, until none is left."""
    used_i, used_t = [False] * len(item), [False] * len(text)
    covered = 0
    while True:
        best, run = (0, 0, 0), {}
        for i in range(len(item)):
            now = {}
            for t in range(len(text)):
                if item[i] == text[t] and not used_i[i] and not used_t[t]:
                    now[t] = run.get(t - 1, 0) + 1
                    if now[t] > best[0]:
                        best = (now[t], i, t)
            run = now
        n, i, t = best
        if n < least:
            return covered
        used_i[i - n + 1 : i + 1] = used_t[t - n + 1 : t + 1] = [True] * n
        covered += n


def test_tiling():
    rng = random.Random(2)
    for _ in range(150):
        item = [rng.randint(0, 30) for _ in range(rng.randint(1, 60))]
        parts = [item[a : a + rng.randint(2, 25)] for a in rng.sample(range(len(item)), min(len(item), 4))]
        noise = [[rng.randint(0, 40) for _ in range(rng.randint(0, 9))] for _ in parts]
        text = [x for p, n in zip(parts, noise, strict=True) for x in n + p]
        a, b = (np.array(x, np.uint64) * np.uint64(0x9E3779B97F4A7C15) for x in (item, text))
        found = decontam.tiles(a, b)
        assert sum(n for _, _, n in found) == pytest.approx(plain_covered(item, text), abs=8)
        used_i, used_t = set(), set()
        for i, t, n in found:
            assert n >= 5 and item[i : i + n] == text[t : t + n]
            assert not used_i & set(range(i, i + n)) and not used_t & set(range(t, t + n))
            used_i |= set(range(i, i + n))
            used_t |= set(range(t, t + n))


def test_whole_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()}
    want = set()
    for b in bench.collect():
        item = tokens(b.text)
        seeds = {tuple(item[i : i + 5]) for i in range(len(item) - 4)}
        for d in docs.collect():
            text = tokens(d.text)
            if any(tuple(text[i : i + 5]) in seeds for i in range(len(text) - 4)):
                if plain_covered(item, text) >= 0.5 * len(item):
                    want.add((d.doc_id, b.item_id))
    assert got == want and want
    kept = {r.doc_id for r in decontam.drop_leaks(docs, bench).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in want}


def test_reordered_and_odd_rows(spark, monkeypatch):
    item = "the quick brown fox jumps over the lazy dog while seven wizards box daily with liquid jugs"
    a, b = item.split()[:8], item.split()[8:]
    rows = [(1, f"x y. {' '.join(b)} noise {' '.join(a).upper()}!", "p"), (2, " ".join(a[:5]), "p"), (3, None, "p"), (4, "", "p"),
            (None, item, "p"), (5, item, "p"), (5, item, "p"), (6, f"{item} " * 3000, "p"), (7, "?" * 10, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (None, "a b c d e f g")], "item_id bigint, text string")
    for size in (decontam.BLOCK_BYTES, 20):
        monkeypatch.setattr(decontam, "BLOCK_BYTES", size)
        got = decontam.leaks(docs, bench).collect()
        assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 1), (1, 1), (5, 1), (5, 1), (6, 1)]
        kept = decontam.drop_leaks(docs, bench)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 7]
    assert decontam.leaks(docs.limit(0), bench).count() == 0
    assert decontam.leaks(docs, bench.limit(0)).count() == 0
    assert decontam.drop_leaks(docs, bench.limit(0)).count() == len(rows)


def test_short_items_and_unspaced_scripts(spark):
    items = ["Two words?", "Paris", "日本語の文章を正しく見つける", "東京。", "สวัสดีครับ", "été où", "!?"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = ["they are two words, of course", "two of words", "in PARIS.", "parisian", "前の文。日本語の文章を正しく見つける、と書いた。", "日本、語の",
            "私は東京に住む", "京東", "เขาพูดว่าสวัสดีครับแล้วไป", "«été»\u3000où…", "étéoù", "日 本語の文章を正しく", "!?"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()}
    assert got == {(0, 0), (2, 1), (4, 2), (6, 3), (8, 4), (9, 5), (11, 2)}
    # a document goes for the long item, and where a line is a short one and nothing else
    assert sorted(r.doc_id for r in decontam.drop_leaks(docs, bench).collect()) == [0, 1, 2, 3, 5, 6, 7, 10, 12]


def test_one_common_word_as_an_item_takes_no_clean_documents(spark):
    rows = [(1, "the cat and the dog"), (2, "The!"), (3, "some line\n the \nmore of the same"), (4, "a the"), (5, "the\nthe end"), (6, "the the"), (7, "in\nthe end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "the")], "item_id bigint, text string")
    assert sorted(r.doc_id for r in decontam.leaks(docs, bench).collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert sorted(r.doc_id for r in decontam.drop_leaks(docs, bench).collect()) == [1, 4, 6, 7]


def test_a_template_that_many_items_and_documents_share(spark, monkeypatch):
    """Seeds are counted once a document, and a slice of them at a time; nothing is lost by it."""
    template = "please answer the following question with one of the options given below"
    items = [(k, f"{template} item{k} of{k} kind{k} and{k} more{k} words{k} here{k} that{k} tell{k} it{k} apart{k}") for k in range(60)]
    docs = [(d, f"{template} " * 30 + (items[d][1] if d % 2 else "")) for d in range(40)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    words = next(decontam.batched_words(pa.array([t.encode() for _, t in docs], pa.binary()), breaks=decontam.NOT_TOKEN, kind=decontam.Tokens))[2]
    held = decontam.Benchmark([k for k, _ in items], [t.encode() for _, t in items], 5)
    want = held.judge(words, 0.6)
    assert {(d, i) for d, i, *_ in want} == {(d, d) for d in range(40) if d % 2}
    for hits in (1, 500):
        monkeypatch.setattr(decontam, "HITS", hits)
        parts = list(held.shared_seeds(words, words.hashes(lower=True)))
        assert len(parts) == 40 if hits == 1 else 1 < len(parts)
        assert held.judge(words, 0.6) == want
    seeds_of_template = len(template.split()) - 4
    assert max(len(doc) for doc, _, _ in parts) <= 500 + 60 * seeds_of_template + 60  # not times 30
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(frame, bench, coverage=0.6).collect()} == {(d, d) for d in range(40) if d % 2}
