"""Small states per day, from which any range of days is answered without reading a row of the fact or of the telemetry.

Sums are added up, distinct devices are counted by sketches that unite, spreads and correlations are merged, quantiles
come from sketches that merge. A day is written when its windows are complete, and written again if they change: each
write replaces its days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costalloc.functions.ids import UNKNOWN
from costalloc.functions.moments import correlation, merged, moments
from costalloc.functions.timeparts import window_start
from costalloc.operators.advanced import EFFICIENT_TOKENS_PER_CALL, LEAST_HISTORY_ROWS
from costalloc.operators.measures import PEAK_QUANTILE

DAY = "WindowDate"
SKETCH_BITS = 14  # devices: relative error 1.04 / 2**7, exact up to some 2000
SKETCH_K = 200  # quantiles: rank error about 1.65 per cent, exact up to so many values
FACT_CELLS, DEVICES, HOURS, BUSY = "fact-cells", "device-moments", "device-hours", "busy-hours"
MEASURES = ["tokens", "calls", "cost"]


def _write(rows: DataFrame, base: str, kind: str) -> None:
    writer = rows.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(f"{base}/state/{kind}")


def _days(spark: SparkSession, base: str, kind: str, start: dt.date, end: dt.date) -> DataFrame:
    """States of a half-open range of days; the folders of others are not opened."""
    rows = spark.read.parquet(f"{base}/state/{kind}")
    return rows.where((F.col(DAY) >= F.lit(start)) & (F.col(DAY) < F.lit(end)))


def write_fact_states(fact: DataFrame, base: str) -> None:
    """States of whole days of the fact; days that it holds replace those that are there.

    One pass per table over the fact: cells (a store, a model family and an hour; so many a day whatever the traffic) and
    device moments (a device and store).
    """
    day = F.to_date("TimeWindow").alias(DAY)
    cells = fact.groupBy(day, "StoreNumber", "ModelFamily", "TimeWindow").agg(
        F.count("*").alias("n"),
        F.sum("AllocatedCost").alias("cost"),
        F.sum("TokensUsed").alias("tokens"),
        F.sum("ApiCalls").alias("calls"),
        F.count_if("IsUnknownDevice").alias("no_device"),
        F.count_if("IsUnknownStore").alias("no_store"),
        F.sum("CorrelationConfidence").alias("confidence"),
        F.sum("AllocationAccuracy").alias("accuracy"),
        F.sum("DeviceUtilizationScore").alias("utilization"),
        F.hll_sketch_agg("DeviceId", SKETCH_BITS).alias("devices"),
        F.hll_sketch_agg("DeviceStoreKey", SKETCH_BITS).alias("pairs"),
    )
    _write(cells, base, FACT_CELLS)
    values = {
        "tokens": F.coalesce("TokensUsed", F.lit(0)).cast("double"),
        "calls": F.coalesce("ApiCalls", F.lit(0)).cast("double"),
        "cost": F.coalesce("AllocatedCost", F.lit(0.0)),
    }
    span = [f(c).alias(f"{name}_{m}") for m, c in values.items() for name, f in (("least", F.min), ("most", F.max))]
    devices = fact.groupBy(day, "DeviceId", "StoreNumber").agg(moments(values).alias("state"), *span)
    _write(devices, base, DEVICES)


def write_usage_states(telemetry: DataFrame, base: str) -> None:
    """States of whole days of telemetry (columns of preprocess_telemetry): each device's active hours, and the quantiles of their tokens."""
    hour = window_start(F.col("TimeGenerated"), 60).alias("hour")
    hours = telemetry.groupBy(F.to_date("TimeGenerated").alias(DAY), "deviceId", "storeNumber", hour).agg(
        F.sum("TokensUsed").alias("tokens"), F.count("*").alias("calls")
    )
    _write(hours.withColumn("hour", F.hour("hour")), base, HOURS)
    there = telemetry.sparkSession.read.parquet(f"{base}/state/{HOURS}")
    days = there.join(hours.select(DAY).distinct(), DAY, "left_semi")
    sketch = F.kll_sketch_agg_double(F.col("tokens").cast("double"), SKETCH_K).alias("tokens")
    _write(days.groupBy(DAY, "deviceId", "storeNumber").agg(sketch), base, BUSY)


def _known(sketch: str) -> Column:
    return F.hll_sketch_estimate(F.hll_union_agg(sketch, False))


def _ratio(name: str, scale: float = 1.0) -> Column:
    return F.coalesce(F.try_divide(F.sum(name) * scale, F.sum("n")), F.lit(0.0))


def range_summary(spark: SparkSession, base: str, start: dt.date, end: dt.date) -> DataFrame:
    """One row about the fact of a range of days, as correlation_summary gives it; devices and pairs are estimates."""
    cells = _days(spark, base, FACT_CELLS, start, end)
    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("total_allocated_cost"),
        F.coalesce(_known("devices"), F.lit(0)).alias("unique_devices"),
        F.countDistinct("StoreNumber").alias("unique_stores"),
        F.coalesce(_known("pairs"), F.lit(0)).alias("unique_device_store_combinations"),
        _ratio("no_device", 100.0).alias("unknown_device_percentage"),
        _ratio("no_store", 100.0).alias("unknown_store_percentage"),
        _ratio("confidence").alias("avg_confidence"),
        _ratio("accuracy").alias("avg_accuracy"),
        _ratio("utilization").alias("avg_utilization_score"),
    )


def range_store_performance(spark: SparkSession, base: str, start: dt.date, end: dt.date) -> DataFrame:
    """Per store, as store_performance gives it for a range of days; the number of devices is an estimate."""
    return _days(spark, base, FACT_CELLS, start, end).groupBy("StoreNumber").agg(
        F.sum("cost").alias("AllocatedCost_sum"),
        _ratio("cost").alias("AllocatedCost_mean"),
        F.sum("n").alias("AllocatedCost_count"),
        F.sum("tokens").alias("TokensUsed_sum"),
        _ratio("tokens").alias("TokensUsed_mean"),
        F.sum("calls").alias("ApiCalls_sum"),
        _ratio("calls").alias("ApiCalls_mean"),
        _known("devices").alias("DeviceId_nunique"),
        _ratio("utilization").alias("DeviceUtilizationScore_mean"),
    )


def range_model_usage(spark: SparkSession, base: str, start: dt.date, end: dt.date, prefix: str = "GPT-5") -> DataFrame:
    """Cost, tokens and (estimated) devices per model family and hour, as model_usage_hourly gives them."""
    rows = _days(spark, base, FACT_CELLS, start, end).where(F.lower("ModelFamily").startswith(prefix.lower()))
    return rows.groupBy("ModelFamily", F.col("TimeWindow").alias("HourStart")).agg(
        F.sum("cost").alias("TotalCost"), F.sum("tokens").alias("TotalTokens"), _known("devices").alias("UniqueDevices")
    )


def range_cost_models(spark: SparkSession, base: str, start: dt.date, end: dt.date) -> DataFrame:
    """Per device how cost goes with tokens and calls, as device_cost_models gives it; one state a day and device is merged."""
    rows = _days(spark, base, DEVICES, start, end)
    span = [f(c).alias(c) for m in MEASURES for c, f in ((f"least_{m}", F.min), (f"most_{m}", F.max))]
    devices = rows.groupBy("DeviceId", "StoreNumber").agg(merged(F.collect_list("state"), MEASURES).alias("s"), *span)

    def varies(m: str) -> Column:
        return F.col(f"least_{m}") < F.col(f"most_{m}")

    def goes_with(m: str) -> Column:
        return F.when(varies(m) & varies("cost"), correlation(F.col("s"), m, "cost"))

    n, cost = F.col("s.n"), F.col("s.cost") * F.col("s.n")
    return devices.where((n >= LEAST_HISTORY_ROWS) & varies("cost")).select(
        "DeviceId",
        "StoreNumber",
        n.cast("bigint").alias("data_points"),
        goes_with("tokens").alias("token_coefficient"),
        goes_with("calls").alias("call_coefficient"),
        (cost / F.greatest(F.col("s.tokens") * n, F.lit(1.0))).alias("avg_cost_per_token"),
        (cost / F.greatest(F.col("s.calls") * n, F.lit(1.0))).alias("avg_cost_per_call"),
        F.col("s.cost").alias("historical_avg"),
    )


def range_usage_patterns(spark: SparkSession, base: str, start: dt.date, end: dt.date) -> DataFrame:
    """Usage pattern of every known device over a range of days, as device_usage_patterns gives it: from at most 24 rows a device and day."""
    rows = _days(spark, base, HOURS, start, end).where((F.col("deviceId") != UNKNOWN) & (F.col("storeNumber") != UNKNOWN))
    by_hour = rows.groupBy("deviceId", "storeNumber", "hour").agg(
        F.sum("tokens").alias("tokens"), F.sum("calls").alias("calls"), F.count("*").alias("active")
    )
    tokens, calls, active = F.sum("tokens"), F.sum("calls"), F.sum("active")
    variation = F.stddev_samp("tokens") / (F.avg("tokens") + 1)
    devices = by_hour.groupBy("deviceId", "storeNumber").agg(
        (tokens / active).alias("avg_tokens_per_hour"),
        (calls / active).alias("avg_api_calls_per_hour"),
        (F.lit(1.0) - F.coalesce(variation, F.lit(0.0))).alias("steadiness"),
        (tokens / calls / EFFICIENT_TOKENS_PER_CALL).alias("efficiency"),
        F.percentile("tokens", F.lit(PEAK_QUANTILE)).alias("peak"),
        F.array_sort(F.collect_list(F.struct("hour", "tokens"))).alias("hours"),
    )
    peaks = F.filter("hours", lambda h: h["tokens"] >= F.col("peak"))
    return devices.select(
        F.col("deviceId").alias("device_id"),
        F.col("storeNumber").alias("store_number"),
        "avg_tokens_per_hour",
        "avg_api_calls_per_hour",
        F.transform(peaks, lambda h: h["hour"]).alias("peak_hours"),
        F.greatest(F.lit(0.0), F.col("steadiness")).alias("usage_consistency_score"),
        F.least(F.lit(1.0), F.col("efficiency")).alias("cost_efficiency_score"),
    )


def range_busy_hours(spark: SparkSession, base: str, start: dt.date, end: dt.date, quantile: float = PEAK_QUANTILE) -> DataFrame:
    """Per device and store: the quantile of its tokens per active hour over a range of days, and how many hours that were."""
    rows = _days(spark, base, BUSY, start, end).groupBy("deviceId", "storeNumber").agg(F.kll_merge_agg_double("tokens").alias("s"))
    return rows.select(
        F.col("deviceId").alias("device_id"),
        F.col("storeNumber").alias("store_number"),
        F.kll_sketch_get_n_double("s").alias("active_hours"),
        F.kll_sketch_get_quantile_double("s", F.lit(quantile)).alias("busy_hour_tokens"),
    )
