"""States per day: merged answers against the rows, the stated errors, and what is read."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from costalloc.functions import moments as m
from costalloc.operators import advanced, cleanse, daily_state, summaries
from costalloc.plans.fact import correlated_fact
from costalloc.session import run_dir
from costalloc.sources import testtables as tt

START, END = dt.date(2024, 1, 8), dt.date(2024, 1, 15)


@pytest.fixture(scope="module")
def stored(spark):
    folder = "/root/testdata/sf0.01"
    base = run_dir(spark, "t")
    fact = correlated_fact(tt.telemetry(spark, folder), tt.billing(spark, folder), tt.AS_OF)
    daily_state.write_fact_states(fact, base)
    calls = cleanse.preprocess_telemetry(tt.telemetry(spark, folder))
    daily_state.write_usage_states(calls, base)
    return base, fact, calls


def near(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        for u, v in zip(x, y, strict=True):
            assert u == v or abs(u - v) <= 1e-6 * max(1.0, abs(v)), (x, y)


def test_models_of_a_range_equal_those_of_its_rows(spark, stored):
    base, fact, _ = stored
    rows = fact.where(f"TimeWindow >= TIMESTAMP '{START}' AND TimeWindow < TIMESTAMP '{END}'")
    want = advanced.device_cost_models(rows)
    got = daily_state.range_cost_models(spark, base, START, END).select(want.columns)
    near(sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect())))


def test_only_states_of_the_range_are_read(spark, stored):
    base, _, _ = stored
    for operator in (daily_state.range_summary, daily_state.range_store_performance, daily_state.range_model_usage,
                     daily_state.range_cost_models, daily_state.range_usage_patterns, daily_state.range_busy_hours):
        frame = operator(spark, base, START, END)
        assert frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert all("/state/" in file for file in frame.inputFiles())
        assert "PartitionFilters: [isnotnull(WindowDate" in plan


def test_a_day_is_replaced(spark, stored):
    _, fact, _ = stored
    base = run_dir(spark, "t")
    daily_state.write_fact_states(fact, base)
    doubled = fact.where("to_date(TimeWindow) = DATE '2024-01-10'").withColumn("AllocatedCost", F.col("AllocatedCost") * 2)
    daily_state.write_fact_states(doubled, base)
    day = dt.date(2024, 1, 10)
    whole = fact.where("to_date(TimeWindow) = DATE '2024-01-10'").agg(F.sum("AllocatedCost")).first()[0]
    got = daily_state.range_summary(spark, base, day, day + dt.timedelta(days=1)).first()
    assert got.total_allocated_cost == pytest.approx(2 * whole)
    assert daily_state.range_summary(spark, base, dt.date(2025, 1, 1), dt.date(2025, 1, 2)).first().total_records == 0


def test_sketches_stay_within_their_error(spark):
    """Many devices over ten days, most of them on several: united counts and merged quantiles."""
    rows = spark.range(0, 400_000, 1, 8).selectExpr(
        "concat('device-', id % 60000) AS DeviceId", "date_add(DATE '2024-01-01', CAST(xxhash64(id) % 10 AS INT) % 10) AS day",
        "CAST(pmod(xxhash64(id, 7), 100000) AS DOUBLE) AS v")
    days = rows.groupBy("day").agg(F.hll_sketch_agg("DeviceId", daily_state.SKETCH_BITS).alias("h"), F.kll_sketch_agg_double("v", daily_state.SKETCH_K).alias("k"))
    got = days.agg(F.hll_sketch_estimate(F.hll_union_agg("h", False)).alias("n"), F.kll_merge_agg_double("k").alias("k")).select(
        "n", F.kll_sketch_get_quantile_double("k", F.lit(0.8)).alias("q")).first()
    assert abs(got.n - 60_000) <= 3 * 60_000 * 1.04 / 2 ** (daily_state.SKETCH_BITS / 2)
    rank = rows.agg(F.avg((F.col("v") <= F.lit(got.q)).cast("int"))).first()[0]
    assert abs(rank - 0.8) <= 0.02


def test_merged_moments_of_large_even_values(spark):
    """Sums of squares would lose all digits here; the merged state does not."""
    rng = np.random.default_rng(3)
    x = 1e9 + rng.normal(size=3000)
    y = 5e8 + (x - 1e9) * 0.5 + rng.normal(size=3000)
    frame = spark.createDataFrame([(int(i % 17), float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "g int, x double, y double")
    states = frame.groupBy("g").agg(m.moments({"x": F.col("x"), "y": F.col("y")}).alias("s"))
    s = states.agg(m.merged(F.collect_list("s"), ["x", "y"]).alias("s"))
    got = s.select(m.variance(F.col("s"), "x").alias("v"), m.correlation(F.col("s"), "x", "y").alias("r"), "s.n", "s.x").first()
    assert got.v == pytest.approx(np.var(x, ddof=1), rel=1e-6) and got.r == pytest.approx(np.corrcoef(x, y)[0, 1], rel=1e-6)
    assert got.n == 3000 and got.x == pytest.approx(x.mean(), rel=1e-12)
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double").agg(m.moments({"x": F.col("x"), "y": F.col("y")}).alias("s"))
    assert one.select(m.variance(F.col("s"), "x").alias("v"), m.correlation(F.col("s"), "x", "y").alias("r")).first()[:] == (None, None)


def test_recommendation_for_large_even_values(spark):
    """A spread of about 2 on values of about 1e9: the variance must not cancel."""
    rng = np.random.default_rng(5)
    data = [(f"d{i % 9}", "s", int(1_000_000_000 + rng.integers(0, 5))) for i in range(2000)]
    calls = spark.createDataFrame(data, "deviceId string, storeNumber string, TokensUsed bigint")
    cost = spark.createDataFrame([(1.0,)], "Cost double")
    got = advanced.recommend_allocation(calls, cost).first()
    t = np.array([x[2] for x in data], float)
    assert got.token_spread == pytest.approx(np.var(t, ddof=1) / t.mean(), rel=1e-6)


def test_estimates_are_exact_while_devices_are_few(spark, stored):
    base, fact, _ = stored
    rows = fact.where(f"TimeWindow >= TIMESTAMP '{START}' AND TimeWindow < TIMESTAMP '{END}'")
    want = {r.StoreNumber: r.DeviceId_nunique for r in summaries.store_performance(rows).collect()}
    assert {r.StoreNumber: r.DeviceId_nunique for r in daily_state.range_store_performance(spark, base, START, END).collect()} == want
