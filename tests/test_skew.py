"""Salted joins, distributed ranking and device comparisons against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from costalloc.operators import correlation_index as index
from costalloc.operators.advanced import device_pair_join
from costalloc.operators.measures import cost_vs_prev_month, trailing_30d_cost
from costalloc.operators.skew import add_global_rank, salted_join


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_the_plain_join(spark, how):
    detail = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k7", 4)], "k string, v int")
    salted = sorted(salted_join(detail, lookup, ["k"], ["id"], how).select("k", "id", "v").collect(), key=str)
    assert salted == sorted(detail.join(lookup, "k", how).select("k", "id", "v").collect(), key=str)


def test_hot_key_is_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        detail = spark.range(8000).select(F.lit("hot").alias("k"), "id")
        joined = salted_join(detail, spark.createDataFrame([("hot", 1)], "k string, v int"), ["k"], ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("values", [
    [], [5.0], [1.0] * 40 + [2.0, 3.0, 3.0], [float(i % 700) for i in range(2000)] + [0.0] * 1000])
def test_global_rank(spark, values):
    rows = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    got = {r.id: r["rank"] for r in add_global_rank(rows, "v", "rank", ["id"]).collect()}
    ordered = sorted(values, reverse=True)
    first = {}
    for place, v in enumerate(ordered, 1):
        first.setdefault(v, place)
    assert got == {i: first[v] for i, v in enumerate(values)}


def test_devices_against_the_rest_of_their_store(spark):
    rng = random.Random(5)
    series = []
    for store, n in (("hot", 25), ("cold", 3), ("single", 1)):
        for d in range(n):
            for w in rng.sample(range(12), rng.randint(1, 12)):
                # some constant series, some large offsets, some few common windows
                cost = 7.5 if d % 6 == 0 else (1e6 * (d % 3) + rng.choice([0.0, 0.25, rng.random()]))
                series.append((store, f"d{d}", w, cost))
    want = {}
    for store in {s for s, *_ in series}:
        own = [x for x in series if x[0] == store]
        for device in {d for _, d, *_ in own}:
            pairs = []
            for _, d, w, cost in own:
                rest = [c for _, e, v, c in own if v == w and e != device]
                if d == device and rest:
                    pairs.append((round(cost, 9), round(sum(c for _, _, v, c in own if v == w) - cost, 9)))
            x, y = zip(*pairs, strict=True) if pairs else ((), ())
            if len(pairs) >= 2 and len(set(x)) > 1 and len(set(y)) > 1:
                r = float(np.corrcoef(x, y)[0, 1])
                if abs(r) > 0.3:
                    want[store, device] = (len(pairs), r)
    rows = spark.createDataFrame(series, "StoreNumber string, DeviceId string, TimeWindow int, AllocatedCost double")
    got = {(r.StoreNumber, r.DeviceId): (r.CommonWindows, r.Correlation) for r in device_pair_join(rows, 0.3).collect()}
    assert got.keys() == want.keys() and want
    for device, (n, r) in want.items():
        assert got[device][0] == n and got[device][1] == pytest.approx(r, abs=1e-5)


def _planted(seed, stores):
    """Devices in groups that share a course of cost, up to noise and sign, among devices of their own course."""
    rng = np.random.default_rng(seed)
    rows = []
    for store, n in stores.items():
        courses = rng.normal(size=(max(1, n // 6), 30))
        for d in range(n):
            x = courses[d % len(courses)] * rng.choice([1, -1]) + rng.normal(size=30) * rng.choice([0.2, 0.9, 3.0])
            if d % 11 == 0:
                x = np.zeros(30)
            rows += [(store, f"d{d:03d}", t, float(round(10 + v, 6))) for t, v in enumerate(x) if d % 13 or t % 2]
    return rows


def test_correlation_index_finds_the_pairs_of_brute_force(spark):
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)
    data = _planted(4, {"large": 150, "small": 9, "one": 1})
    frame = spark.createDataFrame([(s, d, start + dt.timedelta(days=t, hours=5), c) for s, d, t, c in data],
                                  "StoreNumber string, DeviceId string, TimeWindow timestamp, AllocatedCost double")
    series = {}
    for s, d, t, c in data:
        series.setdefault((s, d), np.zeros(30))[t] = c
    want = {}
    for (s, a), x in series.items():
        for (o, b), y in series.items():
            if s == o and a < b and np.ptp(x) > 0 and np.ptp(y) > 0 and abs(r := float(np.corrcoef(x, y)[0, 1])) > 0.7:
                want[s, a, b] = r
    vectors = index.cost_vectors(frame, start, end, 24)
    got = {(r.StoreNumber, r.a, r.b): r.Correlation for r in index.correlated_pairs(vectors).collect()}
    assert got.keys() == want.keys() and len(want) > 100
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
    # with fewer bands some pairs are missed, but none that was not promised
    rough = {(r.StoreNumber, r.a, r.b) for r in index.correlated_pairs(vectors, missed=0.1).collect()}
    assert rough <= set(want) and len(rough) >= 0.9 * len(want)
    rows = {(r.StoreNumber, r.DeviceId): r for r in index.device_correlation_index(frame, start, end).collect()}
    partners = {}
    for (s, a, b), r in want.items():
        partners.setdefault((s, a), []).append((b, r))
        partners.setdefault((s, b), []).append((a, r))
    assert rows.keys() == partners.keys()
    for key, found in partners.items():
        row = rows[key]
        assert row.Links == len(found) and row.Group == min(key[1], *[b for b, _ in found])
        assert abs(abs(row.Correlation) - max(abs(r) for _, r in found)) < 1e-6 and row.device_count == (150 if key[0] == "large" else 9)
        assert row.Relationship == ("positive" if row.Correlation > 0 else "negative")


def test_bands_grow_with_the_store():
    for n in (2, 100, 10_000, 1_000_000):
        bands, signs = index.bands_for(n)
        assert n / 2**signs <= index.CHANCE_MATES and (1 - (1 - math.acos(0.7) / math.pi) ** signs) ** bands <= 1e-6
    assert index.bands_for(1_000_000, missed=0.1)[0] * index.CHANCE_MATES < 20_000


def test_missing_month_counts_as_zero(spark):
    rows = spark.createDataFrame([("2024-01-01", 5.0), ("2024-03-01", 7.0)], "m string, Cost double").select(
        F.to_date("m").alias("Month"), "Cost")
    got = [(str(r.Month), r.CostChange) for r in cost_vs_prev_month(rows).orderBy("Month").collect()]
    assert got == [("2024-01-01", 5.0), ("2024-02-01", -5.0), ("2024-03-01", 7.0)]


def test_trailing_window_ends(spark):
    rows = spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-30", 2.0), ("2024-01-31", 4.0)], "d string, Cost double")
    rows = rows.select(F.to_date("d").alias("Date"), "Cost")
    assert [r.TrailingCost for r in trailing_30d_cost(rows).orderBy("Date").collect()] == [1.0, 3.0, 6.0]
