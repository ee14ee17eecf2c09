"""Exact splits: equality instead of a tolerance, the rule of largest remainders, and bodies parsed once."""

import json
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from costalloc.operators import apportion, correlate
from costalloc.plans.fact import windowed_cost, windowed_usage
from costalloc.sources import logs
from costalloc.sources import testtables as tt
from tests.helpers import bills, calls


@pytest.mark.parametrize("method", list(correlate.METHODS))
@pytest.mark.parametrize("parts", [None, 1])
def test_parts_add_up_to_the_bill(spark, small, method, parts):
    usage = windowed_usage(tt.telemetry(spark, small), decay_hours=2.0)
    cost = windowed_cost(tt.billing(spark, small))
    exact = apportion.allocate_exact(usage, cost, method, parts=parts)
    checked = apportion.reconcile_exact(exact, cost)
    assert checked.where("NOT IsExact").count() == 0 and checked.where("Cells > 1 AND BilledUnits > 0").count() > 10
    # each part is its share, up to one unit per level
    plain = correlate.allocate(usage, cost, method).select(*apportion.LINE, *correlate.CELL, F.col("AllocatedCost").alias("share"))
    apart = exact.join(plain, [*correlate.KEYS, "MeterName", *correlate.CELL]).agg(F.max(F.abs(F.col("Units") - F.col("share") * 10**6))).first()[0]
    assert apart <= (1.01 if parts == 1 else 2.5)


def plain_rule(total, weights):
    """Floors, then one more for the largest remainders; ties in the order of the names."""
    if not sum(weights.values()):
        weights = dict.fromkeys(weights, 1)
    quotas = {d: Fraction(total * w, sum(weights.values())) for d, w in weights.items()}
    given = {d: int(q) for d, q in quotas.items()}
    for d in sorted(weights, key=lambda d: (-(quotas[d] - given[d]), d))[: total - sum(given.values())]:
        given[d] += 1
    return given


@pytest.mark.parametrize("cost, tokens", [
    (0.01, [1, 1, 1]), (1.0, [0, 0, 0, 0, 0, 0, 0]), (0.1, [3, 0, 7, 11, 13]), (12345.67, [10**12, 1, 10**9, 7]), (0.0, [1, 2]), (-3.0, [1, 2]),
    (0.000001, [1, 1]), (100.0, [5]),
])
def test_largest_remainders(spark, cost, tokens):
    usage = windowed_usage(calls(spark, [("10:00:00", f"d{i:02d}", "s", t) for i, t in enumerate(tokens)]))
    lines = windowed_cost(bills(spark, [("10:00:00", "GPT-4o Input Tokens", cost)]))
    got = apportion.allocate_exact(usage, lines, parts=1).collect()
    want = plain_rule(max(0, round(cost * 10**6)), {f"d{i:02d}": t for i, t in enumerate(tokens)})
    assert {r.DeviceId: r.Units for r in got} == want
    assert all(str(r.AllocatedCost) == f"{r.Units / 10**6:.6f}" for r in got)


def test_a_line_with_many_cells_is_split_and_exact(spark):
    """One window and resource with all cells; each part holds a share of them only."""
    rows = spark.range(20_000).select(
        F.lit("2024-01-15 10:00:00").cast("timestamp").alias("TimeWindow"), F.lit("r").alias("ResourceId"),
        F.concat(F.lit("d"), F.col("id")).alias("DeviceId"), F.lit("s").alias("StoreNumber"), (F.col("id") % 7).alias("TokensUsed"),
        F.lit(1).cast("bigint").alias("ApiCalls"), F.lit(1.0).alias("AvgResponseTime"))
    cost = windowed_cost(bills(spark, [("10:00:00", "GPT-4o Input Tokens", 3.333333)], resource="r"))
    exact = apportion.allocate_exact(rows, cost, parts=16)
    assert exact.agg(F.sum("Units")).first()[0] == 3_333_333 and exact.count() == 20_000
    assert exact.where("TokensUsed = 0 AND Units > 0").count() == 0


@pytest.mark.parametrize("body, want", [
    ({"model": "gpt-4", "usage": {"total_tokens": 12, "prompt_tokens": "5", "completion_tokens": 7}}, (12, 5, 7, "gpt-4")),
    ({"usage": None}, (0, 0, 0, "unknown")), ({"model": 7, "usage": [1]}, (0, 0, 0, "7")), ("{\"model\":", (0, 0, 0, "unknown")),
    ({"usage": {"total_tokens": "many"}, "model": None}, (0, 0, 0, "unknown")), (None, (0, 0, 0, "unknown")), ("", (0, 0, 0, "unknown")),
    ({"usage": {"total_tokens": 10**15}}, (0, 0, 0, "unknown")), ([1, 2], (0, 0, 0, "unknown")),
])
def test_bodies_are_parsed_once(spark, body, want):
    text = body if body is None or isinstance(body, str) else json.dumps(body)
    rows = logs.extract_token_usage(spark.createDataFrame([(text,)], "ResponseBody string"))
    assert tuple(rows.first())[1:] == want and "_parsed" not in rows.columns


def test_tasks_grow_with_the_cells(spark, monkeypatch):
    """What one task sorts is bounded; into how many tasks the cells go changes no unit."""
    usage = windowed_usage(calls(spark, [("10:00:00", f"d{i}", "s", 1 + i % 7) for i in range(60)]))
    cost = windowed_cost(bills(spark, [("10:00:00", "GPT-4o Input Tokens", 1.234567)]).selectExpr("*", "'Azure OpenAI' AS ServiceName"))
    few = apportion.allocate_exact(usage, cost)
    monkeypatch.setattr(apportion, "TASK_ROWS", 5)
    many = apportion.allocate_exact(usage, cost)
    assert apportion._tasks(usage, correlate.cost_lines(cost)) == 12
    assert many._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression [_group") == 1
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect())) and few.count() == 60
