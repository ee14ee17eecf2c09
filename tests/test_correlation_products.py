"""The correlation index by products of a store: every pair, by plain columns and by bands, and no row per pair."""

import datetime as dt

import numpy as np
import pytest

from costalloc.operators import correlation_index as index

START, END = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 11)
FACT = "StoreNumber string, DeviceId string, TimeWindow timestamp, AllocatedCost double"


def _fact(spark, stores):
    """stores: name -> {device: series of ten days}"""
    rows = [(s, d, START + dt.timedelta(days=t), float(v)) for s, some in stores.items() for d, x in some.items() for t, v in enumerate(x)]
    return spark.createDataFrame(rows, FACT)


def _even(seed, n):
    rng = np.random.default_rng(seed)
    return {f"d{i:03d}": np.round(50 + rng.normal(size=10), 6) for i in range(n)}


def _brute(some, limit):
    names, found = sorted(some), {}
    for a in names:
        for b in names:
            r = round(float(np.corrcoef(some[a], some[b])[0, 1]), 9)
            if a != b and abs(r) > limit:
                found.setdefault(a, []).append((-abs(r), b, r))
    return found


def _check(got, stores, limit):
    want = {(s, d): found for s, some in stores.items() for d, found in _brute(some, limit).items()}
    got = {(r.StoreNumber, r.DeviceId): r for r in got.collect()}
    assert got.keys() == want.keys() and len(want) > 50
    for key, found in want.items():
        row, (_, other, r) = got[key], min(found)
        assert (row.Links, row.Partner, row.Group) == (len(found), other, min([key[1], *[b for _, b, _ in found]]))
        assert row.Correlation == pytest.approx(r, abs=1e-8)


@pytest.mark.parametrize("plain", [64, 0])
def test_partners_by_products(spark, monkeypatch, plain):
    monkeypatch.setattr(index, "PLAIN_BUCKETS", plain)
    stores = {"a": _even(1, 90), "b": _even(2, 5), "c": _even(3, 1)}
    for d in range(0, 60, 7):  # the same course, and its mirror image
        stores["a"][f"e{d:03d}"], stores["a"][f"c{d:03d}"] = 3 * stores["a"]["d004"] + 1, 900 - 2 * stores["a"]["d004"]
    _check(index.device_correlation_index(_fact(spark, stores), START, END, limit=0.5), stores, 0.5)


def test_bands_and_products_agree(spark, monkeypatch):
    stores = {"a": _even(6, 70), "b": _even(7, 30)}
    monkeypatch.setattr(index, "bands_pay", lambda *a: True)
    _check(index.device_correlation_index(_fact(spark, stores), START, END, limit=0.7), stores, 0.7)


def test_bands_where_they_pay():
    assert not index.bands_pay(45_000, 0.5) and not index.bands_pay(1_000, 0.7)
    assert index.bands_pay(100_000, 0.95)


def test_no_row_per_pair_leaves_a_task(spark):
    """Devices that all go with each other: what is shuffled after the products is a row per device and task."""
    course = np.random.default_rng(5).normal(size=10)
    result = index.device_correlation_index(_fact(spark, {"a": {f"d{i:03d}": 100 + (i + 1) * course for i in range(60)}}), START, END)
    assert [r.Links for r in result.collect()] == [59] * 60
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "posexplode" not in plan
    assert "rint" in plan and "partial_max" in plan


def test_devices_without_a_course_have_no_partner(spark):
    flat = _fact(spark, {"a": {"d1": np.ones(10), "d2": np.ones(10)}})
    assert index.device_correlation_index(flat, START, END).count() == 0
