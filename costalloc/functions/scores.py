"""Quality scores of an allocated row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scoring model.
CONFIDENCE = {
    "unknown device": 0.6,
    "unknown store": 0.8,
    "no tokens": 0.5,
    "complete": 1.1,
    "real usage": 1.05,
}
REAL_USAGE_TOKENS = 100
ACCURACY = {"token-based": 0.95, "proportional": 0.90, "usage-based": 0.80, "equal": 0.70}
ACCURACY_UNKNOWN_DEVICE = 0.7
ACCURACY_UNKNOWN_STORE = 0.9
FULL_USE_CALLS = 10.0
FULL_USE_TOKENS = 1000.0


def _factor(condition: Column, value: float) -> Column:
    return F.when(condition, F.lit(value)).otherwise(F.lit(1.0))


def confidence(unknown_device: Column, unknown_store: Column, tokens: Column) -> Column:
    product = (
        _factor(unknown_device, CONFIDENCE["unknown device"])
        * _factor(unknown_store, CONFIDENCE["unknown store"])
        * _factor(tokens == 0, CONFIDENCE["no tokens"])
        * _factor(~(unknown_device | unknown_store), CONFIDENCE["complete"])
        * _factor(tokens > REAL_USAGE_TOKENS, CONFIDENCE["real usage"])
    )
    return F.least(product, F.lit(1.0))


def accuracy(method: Column, unknown_device: Column, unknown_store: Column, tokens: Column) -> Column:
    base = F.lit(1.0)
    for name, value in ACCURACY.items():
        hit = method == name
        if name == "token-based":
            hit = hit & (tokens > 0)
        base = F.when(hit, F.lit(value)).otherwise(base)
    return (
        base
        * _factor(unknown_device, ACCURACY_UNKNOWN_DEVICE)
        * _factor(unknown_store, ACCURACY_UNKNOWN_STORE)
    )


def utilization(calls: Column, tokens: Column) -> Column:
    full = F.lit(1.0)
    return (F.least(calls / FULL_USE_CALLS, full) + F.least(tokens / FULL_USE_TOKENS, full)) / 2.0
