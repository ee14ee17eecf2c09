"""Properties that hold for every input, on the smallest given tables."""

import pytest
from pyspark.sql import functions as F

from costalloc.operators import correlate, quality
from costalloc.operators.advanced import recommend_allocation
from costalloc.operators.cleanse import preprocess_telemetry
from costalloc.plans.fact import correlated_fact, windowed_cost
from costalloc.sources import testtables as tt
from costalloc.sources.billing import filter_costs_by_resources


def _fact(spark, small, **how):
    return correlated_fact(tt.telemetry(spark, small), tt.billing(spark, small), tt.AS_OF, **how)


@pytest.mark.parametrize("method", list(correlate.METHODS))
def test_cost_is_conserved(spark, small, method):
    fact = _fact(spark, small, method=method)
    groups = fact.groupBy(*correlate.KEYS, "MeterName").agg(
        F.sum("AllocatedCost").alias("a"), F.max("TotalCost").alias("t"))
    assert groups.where(F.abs(F.col("a") - F.col("t")) > 1e-9).count() == 0


def test_reference_mode_spends_the_first_line(spark, small):
    fact = _fact(spark, small, method="equal", mode="reference")
    groups = fact.groupBy(*correlate.KEYS).agg(F.sum("AllocatedCost").alias("a"), F.max("TotalCost").alias("t"))
    assert groups.where(F.abs(F.col("a") - F.col("t")) > 1e-9).count() == 0


def test_modes_agree_with_one_meter(spark, small):
    one = tt.billing(spark, small).where("cost_seq = 1")
    usage = tt.telemetry(spark, small).where("TokensUsed > 0")
    a, b = [correlated_fact(usage, one, tt.AS_OF, mode=m) for m in ("conserving", "reference")]
    columns = [*correlate.KEYS, "DeviceId", "StoreNumber", F.round("AllocatedCost", 9), F.round("TokenShare", 9)]
    left, right = sorted(a.select(columns).collect()), sorted(b.select(columns).collect())
    assert left == right and left


def test_input_order_does_not_matter(spark, small):
    shuffled = correlated_fact(
        tt.telemetry(spark, small).orderBy(F.rand(7)), tt.billing(spark, small).orderBy(F.rand(3)), tt.AS_OF)
    columns = [*correlate.KEYS, "MeterName", "DeviceId", "StoreNumber", F.round("AllocatedCost", 9)]
    assert sorted(shuffled.select(columns).collect()) == sorted(_fact(spark, small).select(columns).collect())


def test_scores_and_rules(spark, small):
    broken = {r.Rule: r.Violations for r in quality.dq_rules(_fact(spark, small)).collect()}
    assert {k: v for k, v in broken.items() if not k.endswith(" known")} == {
        k: 0 for k in broken if not k.endswith(" known")}
    assert broken["DeviceId known"] > 0


def test_reconciliation(spark, small):
    cost = windowed_cost(tt.billing(spark, small))
    used = cost.join(_fact(spark, small).select(*correlate.KEYS).distinct(), correlate.KEYS, "left_semi")
    good = quality.reconcile_total(_fact(spark, small), used).first()
    assert good.IsValid and good.Variance == pytest.approx(0, abs=1e-9) and good.UnallocatedCost == 0
    lossy = quality.reconcile_total(_fact(spark, small, mode="reference"), used).first()
    assert not lossy.IsValid
    whole = quality.reconcile_total(_fact(spark, small), cost).first()
    assert not whole.IsValid
    assert whole.OriginalCost == pytest.approx(whole.AllocatedCost + whole.UnallocatedCost)
    rows = quality.reconcile_allocation(_fact(spark, small), cost)
    assert rows.count() == cost.select(*correlate.KEYS, "MeterName").distinct().count()
    zero = quality._verdict(spark.createDataFrame([(0.0, 0.0), (0.0, 1.0)], "OriginalCost double, AllocatedCost double"))
    assert sorted(r.IsValid for r in zero.collect()) == [False, True]


def test_usage_without_latency_is_kept(spark):
    rows = [("2024-01-15 09:10:00", "r", f"d{i}", "s", 200, None if i else 5.0, 10) for i in range(2)]
    calls = spark.createDataFrame(
        rows, "t string, ResourceId string, deviceId string, storeNumber string, StatusCode int, ResponseTime double, TokensUsed bigint"
    ).select("*", F.col("t").cast("timestamp").alias("TimeGenerated"), F.date_trunc("hour", F.col("t").cast("timestamp")).alias("TimeWindow"))
    usage = correlate.usage_by_window(calls)
    assert usage.count() == 2
    assert correlate.window_totals(usage).first().TotalTokens == 20


def test_without_cost_the_split_is_equal(spark, small):
    calls = preprocess_telemetry(tt.telemetry(spark, small))
    cost = windowed_cost(tt.billing(spark, small))
    assert recommend_allocation(calls, cost).first().billed_lines > 0
    none = recommend_allocation(calls, cost.limit(0)).first()
    assert (none.recommended_method, none.reason) == ("equal", "no cost to split")


def test_resource_names_of_any_form_filter_costs(spark):
    bills = spark.createDataFrame([("/subscriptions/s/resourceGroups/g/providers/p/accounts/OpenAI-1", 1.0), ("/a/openai-2", 2.0), (None, 3.0)], "ResourceId string, PreTaxCost double")
    for name in ("https://openai-1.openai.azure.com/openai", "openai-1", "/subscriptions/t/resourceGroups/h/providers/p/accounts/openai-1"):
        kept = filter_costs_by_resources(bills, spark.createDataFrame([(name,)], "ResourceId string"))
        assert [r.PreTaxCost for r in kept.collect()] == [1.0]
        assert kept.columns == bills.columns


def test_unknown_method_is_refused(spark, small):
    with pytest.raises(ValueError):
        _fact(spark, small, method="by-colour")


def test_unreadable_numbers_are_counted(spark):
    rows = spark.createDataFrame([("1.5", "7"), ("n/a", None), ("", " "), ("1,5", "0x1"), ("-2e3", "8")], "cost string, n string")
    got = {r.Column: (r.RowsChecked, r.Unreadable) for r in quality.unreadable_numbers(rows, ["cost", "n"]).collect()}
    assert got == {"cost": (5, 2), "n": (5, 1)}
