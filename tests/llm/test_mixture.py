"""Repeating documents to target weights, against plain arithmetic."""

import random
import re

import pytest

from costalloc.llm import mixture

SCHEMA = "doc_id bigint, text string, source string, size string, copy string"


def plain_targets(sizes, weights, most=3):
    """Shares by weight, cut at the bound, the excess reshared until none is above."""
    total, full = sum(sizes.values()), {}
    while True:
        left = {s: w for s, w in weights.items() if s not in full}
        if not left:
            return full
        level = (total - sum(full.values())) / sum(left.values())
        above = {s: most * sizes[s] for s, w in left.items() if level * w > most * sizes[s]}
        if not above:
            return full | {s: level * w for s, w in left.items()}
        full |= above


def rows(spark, data):
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in data], SCHEMA)


def test_against_plain_arithmetic(spark):
    rng = random.Random(5)
    data = []
    for s in [None, "", "a", "B", "é", "z", "\U0001f600", "￮"]:
        n = rng.choice([3, 40, 400])
        data += [(len(data) + i, " ".join("w" * rng.randint(1, 60)) + rng.choice(["", " \n", "\t"]), s) for i in range(n)]
    sizes = {}
    for _, text, s in data:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = plain_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    got = mixture.rated(rows(spark, data)).collect()
    assert len(got) == len(data)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = r.row.source
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        rate = want[s] / sizes[s]
        assert int(rate) <= r.copies <= int(rate) + 1 and r.copies <= 3
        taken[s] += r.size * r.copies
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:  # five standard deviations of the draws
        spread = sum(r.size**2 for r in got if r.row.source == s) ** 0.5 / 2
        assert abs(taken[s] - want[s]) <= 5 * spread


def test_excess_goes_round_again(spark):
    """The first round fills a, what it leaves over fills b, and so on."""
    data = [(0, "w", "a"), (1, "w w w", "b"), (2, "w " * 40, "c"), (3, "w " * 400, "d")]
    got = {r.row.source: r.target for r in mixture.rated(rows(spark, data)).collect()}
    want = plain_targets({"a": 1, "b": 3, "c": 40, "d": 400}, {"a": 5, "b": 2, "c": 1, "d": 5})
    assert got == pytest.approx(want) and got["a"] == 3 and got["b"] == 9


def test_reruns_and_layout_do_not_matter(spark):
    data = [(i, f"some words {i}", "ab"[i % 2]) for i in range(300)]
    first = sorted((r.doc_id, r.copy) for r in mixture.mix(rows(spark, data)).collect())
    again = sorted((r.doc_id, r.copy) for r in mixture.mix(rows(spark, data[::-1]).repartition(7)).collect())
    assert first == again and len(first) > 100


def test_given_weights(spark):
    data = [(i, "one two three four", s) for i, s in enumerate([None] * 200 + ["a"] * 200 + ["b"] * 200)]
    weights = spark.createDataFrame([(None, 3), ("a", 1)], "source string, weight int")
    got = mixture.rated(rows(spark, data), weights)
    by = {r[0]: (r[1], r[2]) for r in got.groupBy("row.source").agg({"target": "max", "copies": "sum"}).select("source", "max(target)", "sum(copies)").collect()}
    assert by["b"] == (0.0, 0) and by[None][0] == pytest.approx(1200.0) and by["a"] == (pytest.approx(400.0), by["a"][1])
    assert by[None][1] == pytest.approx(300, abs=40)


def test_odd_rows(spark):
    data = [(None, None, None), (None, "a b", None), (None, "c d", None), (1, "", "s"), (1, "", "s"), (2, "long " * 200_000, "t"), (2, "long " * 200_000, "t")]
    frame = rows(spark, data)
    got = mixture.rated(frame).collect()
    assert len(got) == 7
    assert [(r.size, r.source_size, r.copies) for r in got if r.row.source == "s"] == [(0, 0, 0)] * 2
    assert len({r.copies for r in got if r.row.source == "t"}) == 1  # repeated rows share their draw
    mixed = mixture.mix(frame)
    assert sorted(mixed.columns) == ["copy", "doc_id", "size", "source", "text"]
    assert {r["size"] for r in mixed.collect()} == {"x"}
    assert mixture.rated(frame.limit(0)).count() == 0 and mixture.mix(frame.limit(0)).count() == 0
    assert mixture.rated(rows(spark, [(1, None, "a"), (2, " ", "b")])).agg({"target": "sum"}).first()[0] == 0


def test_runs_without_python(spark):
    frame = rows(spark, [(1, "a b", "s"), (2, "c", "t")])
    for plan in (mixture.rated(frame), mixture.mix(frame)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "InPandas" not in text
