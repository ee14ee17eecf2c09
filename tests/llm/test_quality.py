"""Quality rules against a plain computation."""

import collections
import math
import re

import numpy as np
import pytest

from costalloc.llm import quality
from costalloc.llm.common import LOWER, Words, fmix, hash_slices
from tests.conftest import SMALL

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_rules(text):
    data = (text or "").encode()
    words = WORD.findall(data)
    lines = [line for line in data.split(b"\n")]
    seen, duplicates = set(), 0
    for line in lines:
        duplicates += bool(WORD.search(line)) and line in seen
        seen.add(line)
    found = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if found[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(len(w.decode()) for w in words), symbols, duplicates, len(covered)


ODD = [None, "", " ", "\n\n", "a", "x\n x\nx\nx", "a b c d e f g h " * 3, "é\x85ü\xa0b \x1cq z", "# *$ % <>|&&amp;",
       " lead and trail ", "tab\tsplit\x0bv\x0cf\rr", "one two three four five six seven eight nine " * 5000, "w" * 300_000]


def batch(texts):
    data = [(t or "").encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    return Words(np.frombuffer(b"".join(data), np.uint8), offsets)


def test_words_and_hashes():
    words = batch([t for t in ODD])
    want = [(i, w) for i, t in enumerate(ODD) for w in WORD.findall((t or "").encode())]
    got = [(int(d), words.data[s:e].tobytes()) for d, s, e in zip(words.doc, words.starts, words.ends, strict=True)]
    assert got == want
    by = collections.defaultdict(set)
    for (_, w), h in zip(want, words.hashes().tolist(), strict=True):
        by[w].add(h)
    assert all(len(h) == 1 for h in by.values()) and len({min(h) for h in by.values()}) == len(by)
    one = np.frombuffer(b"ThIs", np.uint8)
    assert hash_slices(one, np.array([0]), np.array([4]), lower=True) == hash_slices(LOWER[one], np.array([0]), np.array([4]))


def test_base_counts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(100_000 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    docs = docs.select("doc_id", "text").unionByName(odd)
    got = quality.quality_rules(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    plain = {r.doc_id: plain_rules(r.text) for r in docs.collect()}
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got} == plain
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= r.threshold)


def test_scores(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0}
    grams = {}
    for r in docs.collect():
        words = [w.lower() for w in WORD.findall(r.text.encode())]
        grams[r.doc_id] = collections.Counter(words) + collections.Counter(zip(words, words[1:], strict=False))
        grams[r.doc_id] += collections.Counter((w[:6], None) for w in words)
    shift = np.uint64(44)

    def bucket(gram):
        # a word, a pair of words, or (beginning, None)
        parts = [gram] if isinstance(gram, bytes) else [w for w in gram if w is not None]
        hashes = [hash_slices(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)])) for w in parts]
        if not isinstance(gram, bytes) and gram[1] is None:
            return int((fmix(hashes[0] + np.uint64(6)) >> shift)[0])
        if len(hashes) == 1:
            return int((hashes[0] >> shift)[0])
        return int((fmix(hashes[0] * np.uint64(0x2545F4914F6CDD1D) + hashes[1]) >> shift)[0])

    place = {g: bucket(g) for c in grams.values() for g in c}
    raw, target = collections.Counter(), collections.Counter()
    own = {}
    for d, c in grams.items():
        own[d] = collections.Counter()
        for g, n in c.items():
            own[d][place[g]] += n
        raw += own[d]
        if d in trusted:
            target += own[d]
    share = sum(target.values()) / sum(raw.values())
    for r in quality.quality_rules(docs, labels).collect():
        total = 0.0
        for b, n in own[r.doc_id].items():
            t = target[b] - (n if r.doc_id in trusted else 0)
            ratio = math.log((t + 5) / ((raw[b] - n) * share + 5))
            total += n * ratio if ratio <= -0.5 else 0.0
        assert r.score == pytest.approx(total / max(1, sum(own[r.doc_id].values())), abs=1e-9)


def test_separates_held_out_labels(spark):
    """Labels of every second document are hidden; their documents are still told apart."""
    base = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{base}/labels.parquet")
    rated = quality.quality_rules(spark.read.parquet(f"{base}/documents.parquet"), labels.where("doc_id % 2 = 0"))
    hidden = rated.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r for r in hidden if r.quality == 1 and r.toxic == 0 and not r.base_failed]
    bad = [r for r in hidden if r.quality == 0 or r.toxic == 1]
    assert sum(r.kept for r in good) / len(good) > 0.9
    assert sum(not r.kept for r in bad) / len(bad) > 0.9


def test_odd_rows(spark):
    rows = [(1, None, "p"), (None, "a " * 40, "p"), (2, "good words here " * 9, "p"), (2, "good words here " * 9, "p")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, trusted string")
    labels = spark.createDataFrame([(2, 1, None), (None, 1, 0), (1, None, 1)], "doc_id bigint, quality int, toxic int")
    assert quality.quality_rules(docs, labels).count() == 4
    assert quality.quality_rules(docs, labels.limit(0)).count() == 4
    assert quality.quality_rules(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_alike_with_joined_labels(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rated = {r.doc_id for r in quality.quality_rules(docs, labels).where("kept").collect()}
    assert {r.doc_id for r in quality.keep_good(docs, labels).collect()} == rated and rated
    monkeypatch.setattr(quality, "MOST_IDS", 0)
    assert {r.doc_id for r in quality.quality_rules(docs, labels).where("kept").collect()} == rated
    assert {r.doc_id for r in quality.keep_good(docs, labels).collect()} == rated


def test_each_row_by_its_own_text_with_joined_labels(spark, monkeypatch):
    """Rows without doc_id, and rows that share one, are judged alike by either path."""
    clean = [f"{w} " + " ".join(f"word{i * k} of" for i in range(30)) for k, w in enumerate(("one", "two", "three"), 1)]
    rows = [(1, clean[0], "a"), (1, "bad", "b"), (None, clean[1], "c"), (None, "bad", None), (2, clean[2], "d"), (2, clean[2], "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, trusted string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1)], "doc_id bigint, quality int, toxic int")
    for most in (quality.MOST_IDS, 0):
        monkeypatch.setattr(quality, "MOST_IDS", most)
        got = quality.keep_good(docs, labels, threshold=-100.0)
        assert got.columns == docs.columns
        assert sorted(r.trusted for r in got.collect()) == ["a", "c", "d", "d"]
