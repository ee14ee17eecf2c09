"""The prefix tree against a plain computation, and the double arrays by themselves."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from costalloc.llm import trie

SCHEMA = "conv_id bigint, turn int, role string, text string, depth string, shard string"


def plain_tree(conversations):
    """conversations: id -> list of (role, text)."""
    built = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(conversations.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    words = lambda key: len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
    out = []
    for key, convs in members.items():
        under = [k for k in members if k[: len(key)] == key]
        kids = [k for k in under if len(k) == len(key) + 1]
        leaves = [k for k in under if not any(len(o) == len(k) + 1 and o[: len(k)] == k for o in under)]
        ends = ",".join(str(c) for c in sorted(c for c in convs if built[c] == key))
        out.append((
            min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs), len(kids), len(leaves),
            sum((len(members[k]) - 1) * words(k) for k in under), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rows_of(conversations):
    return [(c, 3 * i, role, text, "x", "y") for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]


def got(frame, **how):
    return sorted(map(tuple, trie.prefix_tree(frame, **how).collect()), key=repr)


def logs(seed, n=120):
    rng = random.Random(seed)
    out = {}
    for c in rng.sample(range(-40, 200), n):
        if out and rng.random() < 0.5:
            old = rng.choice(list(out.values()))
            turns = old[: rng.randint(1, len(old))] + [("user", f"more {rng.randint(0, 3)} \t x")] * rng.randint(0, 2)
        else:
            turns = [(("user", "assistant")[i % 2], f"say {rng.randint(0, 2)}") for i in range(rng.randint(1, 6))]
        out[c] = turns
    out[220] = [("user", f"turn {i} of a long one") for i in range(90)]
    out[240] = out[220][:70] + [("user", "another end")]
    return out


@pytest.mark.parametrize("shard_turns", [1, 12, 1 << 16])
def test_against_plain_tree(spark, shard_turns):
    """With one turn a shard nearly all nodes lie above the cuts, with many nearly none."""
    conversations = logs(7)
    rows = rows_of(conversations)
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(frame, shard_turns=shard_turns) == plain_tree(conversations)


def test_one_conversation_and_copies_hold_most_rows(spark):
    """A conversation lies in several tasks, and a list of ends in several pieces."""
    conversations = {0: [("user", f"{i % 5} word") for i in range(300)]}
    conversations |= {c: [("user", "hello there"), ("bot", "again")] for c in range(1000, 1150)}
    frame = spark.createDataFrame(rows_of(conversations), SCHEMA)
    old, trie.CHUNK = trie.CHUNK, 16
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert got(frame, shard_turns=50) == plain_tree(conversations)
    finally:
        trie.CHUNK = old
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None, "a", "b"), (1, 0, None, None, "a", "b"), (None, 0, "user", "x", "a", "b"), (21, 5, "u", "later", "", ""),
        (21, None, "u", "first", "", ""), (45, 1, "u", "w " * 100_000, "", ""), (46, 0, "", "", "", ""),
    ]
    conversations = {1: [("", "")] * 2, 21: [("u", "first"), ("u", "later")], 45: [("u", "w " * 100_000)], 46: [("", "")]}
    frame = spark.createDataFrame(rows, SCHEMA)
    want = plain_tree(conversations)
    assert got(frame) == want and any(r[1] == 0 and r[7] != trie.EMPTY for r in want)  # some end at the root
    assert got(frame.limit(0)) == []
    assert trie.prefix_tree(frame).columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_double_array_walks_what_was_put_in():
    rng = random.Random(2)
    paths = sorted({tuple([rng.randint(0, 5), *[rng.randint(0, 300) for _ in range(rng.randint(0, 6))]]) for _ in range(3000)})
    flat = np.array([c for p in paths for c in p])
    lengths = np.array([len(p) for p in paths])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    array = trie.DoubleArray(flat, starts, lengths)
    slots = {}
    for p in paths:
        at = np.zeros(1, np.int64)
        for d, c in enumerate(p):
            before, at = at, array.step(at, np.array([c]))
            assert array.check[at[0]] == before[0]
            assert slots.setdefault(p[: d + 1], at[0]) == at[0]
    assert len(set(slots.values())) == len(slots) == len(np.unique(array.slot))
    assert array.end < 3 * len(slots)  # packed
    with pytest.raises(ValueError):
        array.step(np.array([slots[paths[0][:1]]]), np.array([99_999]))
