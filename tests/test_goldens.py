"""Hand-computed results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costalloc.functions.ids import normalize_resource_id
from costalloc.operators import advanced
from costalloc.sources.billing import normalize_cost
from tests.helpers import ARM, AS_OF, bills, by_device, calls, fact

THREE = [("10:30:00", "device-001", "store-001", 500), ("10:31:00", "device-002", "store-001", 300),
         ("10:45:00", "device-003", "store-002", 400)]
COST = [("10:00:00", "GPT-5 Input Tokens", 12.5)]


def test_proportional(spark):
    rows = fact(calls(spark, THREE), bills(spark, COST))
    assert by_device(rows) == {"device-001": [5.208333], "device-002": [3.125], "device-003": [4.166667]}
    assert by_device(rows, "TokenShare") == {"device-001": [0.416667], "device-002": [0.25], "device-003": [0.333333]}
    assert by_device(rows, "DeviceUtilizationScore") == {"device-001": [0.3], "device-002": [0.2], "device-003": [0.25]}
    one = rows.where("DeviceId = 'device-001'").first()
    assert one.TimeWindow == dt.datetime(2024, 1, 15, 10)
    assert (one.DayOfWeek, one.ShiftCategory, one.IsBusinessHours, one.IsWeekday) == ("Monday", "Morning", True, True)
    assert (one.CorrelationConfidence, one.AllocationAccuracy) == (1.0, 0.9)
    assert (one.ModelFamily, one.CostType, one.ResourceName) == ("GPT-5", "Input Tokens", "openai-1")


@pytest.mark.parametrize("method, accuracy", [("equal", 0.7), ("usage-based", 0.8)])
def test_even_splits(spark, method, accuracy):
    rows = fact(calls(spark, THREE), bills(spark, COST), method)
    assert by_device(rows) == {f"device-00{i}": [4.166667] for i in (1, 2, 3)}
    assert {r.AllocationAccuracy for r in rows.collect()} == {accuracy}


def test_two_devices(spark):
    usage = calls(spark, [("10:05:00", "a", "s", 500), ("10:06:00", "b", "s", 300)])
    assert by_device(fact(usage, bills(spark, [("10:00:00", "m", 10.0)]))) == {"a": [6.25], "b": [3.75]}


def test_unknown_attribution(spark):
    row = fact(calls(spark, [("10:05:00", "unknown", "unknown", 500)]), bills(spark, COST)).first()
    assert row.IsUnknownDevice and row.IsUnknownStore and not row.HasCompleteAttribution
    assert row.CorrelationConfidence == pytest.approx(0.504)
    assert row.AllocationAccuracy == pytest.approx(0.567)


def test_null_ids_become_unknown(spark):
    row = fact(calls(spark, [("10:05:00", None, None, None)]), bills(spark, COST)).first()
    assert (row.DeviceId, row.StoreNumber, row.TokensUsed, row.AllocatedCost) == ("unknown", "unknown", 0, 12.5)


def test_zero_cost(spark):
    rows = fact(calls(spark, THREE), bills(spark, [("10:00:00", "m", 0.0)]))
    assert {r.AllocatedCost for r in rows.collect()} == {0.0}


def test_window_mismatch(spark):
    assert fact(calls(spark, THREE), bills(spark, [("11:00:00", "m", 5.0)])).count() == 0


def test_two_resources(spark):
    usage = calls(spark, [("10:05:00", "a", "s", 10, ARM + "r1"), ("10:06:00", "a", "s", 10, "https://R2.openai.azure.com/x")])
    cost = bills(spark, [("10:00:00", "GPT-5 Input Tokens", 20.0, ARM + "R1"), ("10:00:00", "GPT-4 Input Tokens", 12.0, ARM + "r2")])
    got = {(r.ModelFamily, r.AllocatedCost) for r in fact(usage, cost).collect()}
    assert got == {("GPT-5", 20.0), ("GPT-4", 12.0)}


def test_two_meters(spark):
    usage = calls(spark, [("10:05:00", "a", "s", 600), ("10:06:00", "b", "s", 400)])
    cost = bills(spark, [("10:00:00", "m1", 10.0), ("10:00:00", "m2", 4.0)])
    assert by_device(fact(usage, cost)) == {"a": [6.0, 2.4], "b": [4.0, 1.6]}
    assert by_device(fact(usage, cost, mode="reference")) == {"a": [3.0, 3.0], "b": [2.0, 2.0]}


def test_idle_device(spark):
    usage = calls(spark, [("10:05:00", "a", "s", 100), ("10:06:00", "b", "s", 0)])
    cost = bills(spark, [("10:00:00", "m", 10.0)])
    assert by_device(fact(usage, cost)) == {"a": [10.0], "b": [0.0]}
    assert by_device(fact(usage, cost, mode="reference")) == {"a": [10.0], "b": [5.0]}


def test_time_weighted_prefers_late_calls(spark):
    usage = calls(spark, [("10:00:00", "a", "s", 100), ("10:59:00", "b", "s", 100)])
    cost = bills(spark, [("10:00:00", "m", 10.0)])
    got = by_device(fact(usage, cost, "time-weighted"))
    assert got["b"][0] > got["a"][0] and got["a"][0] + got["b"][0] == pytest.approx(10.0)
    assert by_device(fact(usage, cost, "time-weighted", "reference")) == {"a": [5.0], "b": [5.0]}


def test_meter_rules(spark):
    names = ["GPT-5 Input Tokens", "GPT-5-Turbo Output Tokens", "GPT-5-Preview Input Tokens", "GPT-4o Output Tokens",
             "GPT-4-Turbo Input Tokens", "gpt-4o-mini-0718-Inp-glbl Tokens", "PTU", "gpt-35 fine-tuning", "x canada training"]
    rows = normalize_cost(bills(spark, [("10:00:00", n, 1.0) for n in names])).collect()
    assert [r.ModelFamily for r in rows] == [
        "GPT-5", "GPT-5-Turbo", "GPT-5-Preview", "GPT-4o", "GPT-4-Turbo", "GPT-4o", "Unknown", "GPT-3.5-Turbo", "Ada"]
    assert [r.CostType for r in rows] == [
        "Input Tokens", "Output Tokens", "Input Tokens", "Output Tokens", "Input Tokens", "Unknown",
        "Provisioned Throughput", "Fine-tuning", "Training"]
    assert [r.IsTokenBased for r in rows] == [True] * 5 + [False] * 4
    extended = normalize_cost(bills(spark, [("10:00:00", names[5], 1.0)]), extended=True).first()
    assert (extended.CostType, extended.TokenType) == ("Input Tokens", "Input")


def test_resource_names(spark):
    given = [(ARM + "My-Res", "my-res"), ("https://My-Res.openai.azure.com:443/x", "my-res"), (" X ", "x"),
             (None, "unknown"), ("", "unknown"), ("unknown", "unknown"), ("/subscriptions/a/b/", ""),
             ("http:no-host", "unknown"), ("https://user@h.example.com/x", "h")]
    rows = spark.createDataFrame([(g,) for g, _ in given], "id string")
    got = [r.n for r in rows.select(normalize_resource_id(F.col("id")).alias("n")).collect()]
    assert got == [want for _, want in given]


def test_billing_spellings(spark):
    rows = spark.createDataFrame(
        [(20240115, 2.0, 4.0, "/subscriptions/s9/resourcegroups/g9/providers/p/accounts/Acc")],
        "UsageDate int, totalCost double, usageQuantity double, ResourceId string")
    row = normalize_cost(rows).first()
    assert (row.UsageDate, row.Cost, row.CostPerUnit) == (dt.datetime(2024, 1, 15), 2.0, 0.5)
    assert (row.SubscriptionId, row.ResourceGroup, row.ResourceName) == ("s9", "g9", "Acc")
    assert (row.MeterName, row.ServiceName, row.Currency) == ("Unknown", "Azure OpenAI", "USD")


def test_anomaly_is_strict(spark):
    pattern = spark.createDataFrame([("d", "s", 1000.0, 10.0)],
        "device_id string, store_number string, avg_tokens_per_hour double, avg_api_calls_per_hour double")

    def found(tokens):
        usage = calls(spark, [("10:05:00", "d", "s", tokens)]).withColumn("TimeGenerated", F.col("TimeGenerated").cast("timestamp"))
        return [(r.anomaly_type, r.severity) for r in advanced.usage_anomalies(usage, pattern).collect()]

    assert found(3000) == []
    assert found(3001) == [("usage_spike", "medium")]
    assert found(7000) == [("usage_spike", "high")]


@pytest.mark.parametrize("rows, method", [
    ([("10:05:00", f"d{i}", "s", t) for i, t in enumerate([100, 5000, 200])], "token-based"),
    ([("10:05:00", "unknown", "s", 100), ("10:05:00", "unknown", "s", 9000)], "equal"),
    ([("10:05:00", "a", "s", 5)] * 9 + [("10:05:00", "b", "s", 5)], "usage-based"),
    ([("10:05:00", "a", "s", 5), ("10:05:00", "b", "s", 5)], "proportional"),
    ([], "equal"),
])
def test_recommendation(spark, rows, method):
    cost = bills(spark, [("10:00:00", "GPT-4o Input Tokens", 1.0)])
    assert advanced.recommend_allocation(calls(spark, rows), cost).first().recommended_method == method


def test_short_history_gives_no_model(spark):
    usage = calls(spark, [(f"1{i}:05:00", "a", "s", 100 * (i + 1)) for i in range(4)])
    cost = bills(spark, [(f"1{i}:00:00", "m", 1.0 + i) for i in range(4)])
    assert advanced.device_cost_models(fact(usage, cost)).count() == 0


def test_prediction_follows_tokens(spark):
    usage = calls(spark, [(f"1{i}:05:00", "a", "s", 100 * (i + 1)) for i in range(6)])
    cost = bills(spark, [(f"1{i}:00:00", "m", 1.0 * (i + 1)) for i in range(6)])
    models = advanced.device_cost_models(fact(usage, cost))
    now = calls(spark, [("20:00:00", "a", "s", 1000), ("20:00:00", "other", "s", 1000)])
    rows = advanced.predict_cost(now, models).collect()
    assert [(r.DeviceId, round(r.PredictedCost, 6)) for r in rows] == [("a", 10.0)]


def test_constant_calls_have_no_correlation(spark):
    usage = calls(spark, [(f"1{i}:05:00", "a", "s", 100 * (i + 1)) for i in range(6)])
    cost = bills(spark, [(f"1{i}:00:00", "m", 1.0 * (i + 1)) for i in range(6)])
    row = advanced.device_cost_models(fact(usage, cost)).first()
    assert row.call_coefficient is None and row.token_coefficient == pytest.approx(1.0)


def test_patterns(spark):
    rows = [(f"{h:02d}:{m:02d}:00", "a", "s", 100 + 10 * h + 5 * m) for h in range(24) for m in range(3)]
    usage = calls(spark, rows + [("10:00:00", "unknown", "s", 1)]).withColumn("TimeGenerated", F.col("TimeGenerated").cast("timestamp"))
    row = advanced.device_usage_patterns(usage, AS_OF, 7).collect()
    assert len(row) == 1
    assert row[0].peak_hours == [19, 20, 21, 22, 23]
    assert row[0].avg_api_calls_per_hour == 3.0
    assert row[0].avg_tokens_per_hour == pytest.approx(sum(r[3] for r in rows) / 24)


def test_constant_series_over_many_partitions(spark):
    """Merged partial variances of equal values need not be 0; the values decide."""
    rows = spark.range(0, 385, 1, 16).selectExpr(
        "'d' AS DeviceId", "'s' AS StoreNumber", "id AS TokensUsed", "1L AS ApiCalls", "id * 0.37D AS AllocatedCost")
    model = advanced.device_cost_models(rows).first()
    assert model.call_coefficient is None and model.token_coefficient == pytest.approx(1.0)
    flat = rows.withColumn("AllocatedCost", F.lit(0.1))
    assert advanced.device_cost_models(flat).count() == 0
