"""Small inputs for the golden tests."""

from __future__ import annotations

from costalloc.operators.cleanse import preprocess_cost
from costalloc.operators.correlate import finish_fact, allocate
from costalloc.plans.fact import windowed_usage
from costalloc.sources.billing import normalize_cost

AS_OF = "2024-01-16 00:00:00"
ARM = "/subscriptions/sub-1/resourceGroups/rg-1/providers/Microsoft.CognitiveServices/accounts/"

CALL = (
    "TimeGenerated string, RequestId string, deviceId string, storeNumber string, ApiName string, "
    "StatusCode int, ResponseTime double, TokensUsed bigint, ResourceId string"
)
BILL = (
    "UsageDate string, ResourceId string, Meter string, PreTaxCost double, UsageQuantity double, "
    "Currency string, cost_seq int"
)


def calls(spark, rows, resource="openai-1"):
    """rows: (time of 2024-01-15, device, store, tokens[, resource])"""
    data = []
    for i, (time, device, store, tokens, *rest) in enumerate(rows):
        stamp = time if "T" in time else f"2024-01-15T{time}Z"
        data.append((stamp, f"req-{i}", device, store, "chat", 200, 100.0, tokens, rest[0] if rest else ARM + resource))
    return spark.createDataFrame(data, CALL)


def bills(spark, rows, resource="openai-1"):
    """rows: (time, meter, cost[, resource])"""
    data = []
    for i, (time, meter, cost, *rest) in enumerate(rows):
        stamp = time if "T" in time else f"2024-01-15T{time}Z"
        data.append((stamp, rest[0] if rest else ARM + resource, meter, cost, 1000.0, "USD", i + 1))
    return spark.createDataFrame(data, BILL)


def fact(usage, billing, method="proportional", mode="conserving", minutes=60):
    cells = windowed_usage(usage, minutes, 2.0 if method == "time-weighted" else None)
    cost = preprocess_cost(normalize_cost(billing), minutes)
    return finish_fact(allocate(cells, cost, method, mode), AS_OF)


def by_device(rows, column="AllocatedCost"):
    out = {}
    for r in rows.collect():
        out.setdefault(r["DeviceId"], []).append(round(r[column], 6))
    return {k: sorted(v, reverse=True) for k, v in out.items()}
