"""Usage patterns, prediction, anomalies, spillover and method choice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costalloc.functions.ids import UNKNOWN
from costalloc.functions.numbers import safe_corr, varies
from costalloc.functions.timeparts import window_start
from costalloc.operators.cleanse import lookback_filter
from costalloc.operators.measures import PEAK_QUANTILE
from costalloc.operators.skew import salted_join
from costalloc.operators.summaries import weighted_cost, weighted_usage

PAIR = ["deviceId", "storeNumber"]

# Fixed values of the analyses.
EFFICIENT_TOKENS_PER_CALL = 1000.0
LEAST_HISTORY_ROWS = 5
RELIABLE_CORRELATION = 0.5
ANOMALY_DEVIATION = 2.0
SEVERE_DEVIATION = 5.0
SPILLOVER_CORRELATION = 0.7
LEAST_COMMON_WINDOWS = 2
UNKNOWN_RATIO_LIMIT = 0.5
TOKEN_SPREAD_LIMIT = 2.0
CALL_SPREAD_LIMIT = 1.5
MANY_DEVICES = 10


def weighted_merge(usage: DataFrame, cost: DataFrame) -> DataFrame:
    """Weighted usage of each device and resource with that resource's weighted cost, if both are of the same hour.

    Expects usage by resource, so that a device meets the resources it has used, and the result grows with the usage.
    """
    hour = window_start(F.col("LatestTime"), 60)
    left = usage.withColumn("TimeWindow", hour).withColumnsRenamed(
        {"TotalWeight": "TotalWeight_telemetry", "LatestTime": "LatestTime_telemetry"}
    )
    right = cost.withColumn("TimeWindow", hour).withColumnsRenamed(
        {"TotalWeight": "TotalWeight_cost", "LatestTime": "LatestTime_cost"}
    )
    return salted_join(left, right, ["TimeWindow", "ResourceId"], PAIR)


def time_weighted_correlation(
    telemetry: DataFrame, cost: DataFrame, as_of, decay_hours: float = 2.0
) -> DataFrame:
    usage = weighted_usage(telemetry, as_of, decay_hours, by_resource=True)
    return weighted_merge(usage, weighted_cost(cost, as_of, decay_hours))


def _active_hours(telemetry: DataFrame) -> DataFrame:
    """Tokens and calls per device and hour in which it was active at all."""
    hour = window_start(F.col("TimeGenerated"), 60).alias("_hour")
    return telemetry.groupBy(*PAIR, hour).agg(F.sum("TokensUsed").alias("tokens"), F.count("*").alias("calls"))


def device_usage_patterns(telemetry: DataFrame, as_of, lookback_days: int = 7) -> DataFrame:
    """Usage pattern of every known device over the lookback, from one scan."""
    recent = lookback_filter(telemetry, "TimeGenerated", as_of, days=lookback_days).where(
        (F.col("deviceId") != UNKNOWN) & (F.col("storeNumber") != UNKNOWN)
    )
    by_hour_of_day = _active_hours(recent).groupBy(*PAIR, F.hour("_hour").alias("hour")).agg(
        F.sum("tokens").alias("tokens"), F.sum("calls").alias("calls"), F.count("*").alias("active")
    )
    tokens, calls, active = F.sum("tokens"), F.sum("calls"), F.sum("active")
    variation = F.stddev_samp("tokens") / (F.avg("tokens") + 1)
    devices = by_hour_of_day.groupBy(*PAIR).agg(
        (tokens / active).alias("avg_tokens_per_hour"),
        (calls / active).alias("avg_api_calls_per_hour"),
        (F.lit(1.0) - F.coalesce(variation, F.lit(0.0))).alias("_steadiness"),
        (tokens / calls / EFFICIENT_TOKENS_PER_CALL).alias("_efficiency"),
        F.percentile("tokens", F.lit(PEAK_QUANTILE)).alias("_peak"),
        # at most 24 entries a device
        F.array_sort(F.collect_list(F.struct("hour", "tokens"))).alias("_hours"),
    )
    peaks = F.filter("_hours", lambda h: h["tokens"] >= F.col("_peak"))
    return devices.select(
        F.col("deviceId").alias("device_id"),
        F.col("storeNumber").alias("store_number"),
        "avg_tokens_per_hour",
        "avg_api_calls_per_hour",
        F.transform(peaks, lambda h: h["hour"]).alias("peak_hours"),
        F.greatest(F.lit(0.0), F.col("_steadiness")).alias("usage_consistency_score"),
        F.least(F.lit(1.0), F.col("_efficiency")).alias("cost_efficiency_score"),
    )


def device_cost_models(fact: DataFrame) -> DataFrame:
    """Per device: how cost goes with tokens and calls, and unit costs."""
    cost = F.coalesce("AllocatedCost", F.lit(0.0))
    rows = fact.select(
        "DeviceId",
        "StoreNumber",
        F.coalesce("TokensUsed", F.lit(0)).cast("double").alias("tokens"),
        F.coalesce("ApiCalls", F.lit(0)).cast("double").alias("calls"),
        cost.alias("cost"),
    )
    models = rows.groupBy("DeviceId", "StoreNumber").agg(
        F.count("*").alias("data_points"),
        varies("cost").alias("_varies"),
        safe_corr("tokens", "cost").alias("token_coefficient"),
        safe_corr("calls", "cost").alias("call_coefficient"),
        (F.sum("cost") / F.greatest(F.sum("tokens"), F.lit(1.0))).alias("avg_cost_per_token"),
        (F.sum("cost") / F.greatest(F.sum("calls"), F.lit(1.0))).alias("avg_cost_per_call"),
        F.avg("cost").alias("historical_avg"),
    )
    return models.where((F.col("data_points") >= LEAST_HISTORY_ROWS) & F.col("_varies")).drop("_varies")


def model_lookup_join(usage: DataFrame, models: DataFrame) -> DataFrame:
    """Current usage per device next to its cost model; devices without one drop out."""
    current = usage.groupBy(
        F.col("deviceId").alias("DeviceId"), F.col("storeNumber").alias("StoreNumber")
    ).agg(F.sum("TokensUsed").alias("current_tokens"), F.count("*").alias("current_calls"))
    return current.join(models, ["DeviceId", "StoreNumber"])


def predict_cost(usage: DataFrame, models: DataFrame) -> DataFrame:
    """Expected cost by the most reliable predictor of each device."""
    predicted = (
        F.when(
            F.col("token_coefficient") > RELIABLE_CORRELATION,
            F.col("current_tokens") * F.col("avg_cost_per_token"),
        )
        .when(
            F.col("call_coefficient") > RELIABLE_CORRELATION,
            F.col("current_calls") * F.col("avg_cost_per_call"),
        )
        .otherwise(F.col("historical_avg"))
    )
    return model_lookup_join(usage, models).select(
        "DeviceId", "StoreNumber", F.greatest(predicted, F.lit(0.0)).alias("PredictedCost")
    )


def pattern_lookup_join(usage: DataFrame, patterns: DataFrame) -> DataFrame:
    """Current rates per device next to its stored pattern."""
    hours = F.count("*")
    rates = _active_hours(usage).groupBy(
        F.col("deviceId").alias("device_id"), F.col("storeNumber").alias("store_number")
    ).agg(
        (F.sum("tokens") / hours).alias("current_tokens_per_hour"),
        (F.sum("calls") / hours).alias("current_calls_per_hour"),
    )
    return rates.join(patterns, ["device_id", "store_number"])


def usage_anomalies(
    usage: DataFrame, patterns: DataFrame, limit: float = ANOMALY_DEVIATION, severe: float = SEVERE_DEVIATION
) -> DataFrame:
    """Devices whose tokens or calls per hour are far from their pattern."""

    def deviation(now: str, expected: str):
        return F.abs(F.col(now) - F.col(expected)) / F.greatest(F.col(expected), F.lit(1.0))

    compared = pattern_lookup_join(usage, patterns).select(
        "device_id",
        "store_number",
        "current_tokens_per_hour",
        F.col("avg_tokens_per_hour").alias("expected_tokens_per_hour"),
        deviation("current_tokens_per_hour", "avg_tokens_per_hour").alias("token_deviation"),
        deviation("current_calls_per_hour", "avg_api_calls_per_hour").alias("call_deviation"),
    )
    worst = F.greatest("token_deviation", "call_deviation")
    rises = F.col("current_tokens_per_hour") > F.col("expected_tokens_per_hour")
    return compared.where(worst > limit).withColumns(
        {
            "anomaly_type": F.when(rises, "usage_spike").otherwise("usage_drop"),
            "severity": F.when(worst > severe, "high").otherwise("medium"),
        }
    )


def _cost_series(fact: DataFrame) -> DataFrame:
    return fact.groupBy("StoreNumber", "DeviceId", "TimeWindow").agg(F.sum("AllocatedCost").alias("Cost"))


def _against_store(series: DataFrame) -> DataFrame:
    """Every device's cost in a window beside that of all other devices of its store, where there are any."""
    stores = series.groupBy("StoreNumber", "TimeWindow").agg(F.sum("Cost").alias("_all"), F.count("*").alias("_devices"))
    both = salted_join(series, stores, ["StoreNumber", "TimeWindow"], ["DeviceId"])
    # Rounded, so that the noise of a sum does not make an unchanging rest look as if it varied.
    rows = both.where("_devices > 1").withColumn("_others", F.round(F.col("_all") - F.col("Cost"), 9))
    return rows.withColumn("Cost", F.round("Cost", 9))


def device_pair_join(fact: DataFrame, threshold: float = SPILLOVER_CORRELATION) -> DataFrame:
    """Devices whose cost goes with that of the rest of their store, over the windows they share.

    One row per device: each is paired with the rest of its store instead of with every other device, so work and
    result grow with the devices, not with their square.
    """
    rows = _against_store(_cost_series(fact))
    devices = rows.groupBy("StoreNumber", "DeviceId").agg(
        F.count("*").alias("CommonWindows"), safe_corr("Cost", "_others").alias("Correlation")
    )
    return devices.where((F.col("CommonWindows") >= LEAST_COMMON_WINDOWS) & (F.abs("Correlation") > threshold))


def device_spillover(fact: DataFrame, threshold: float = SPILLOVER_CORRELATION) -> DataFrame:
    """Devices that go with the rest of their store, with the sign and the cost figures of the store."""
    devices = _cost_series(fact).groupBy("StoreNumber", "DeviceId").agg(F.sum("Cost").alias("Cost"))
    stores = devices.groupBy("StoreNumber").agg(
        F.count("*").alias("device_count"),
        F.sum("Cost").alias("total_store_cost"),
        F.avg("Cost").alias("avg_device_cost"),
    )
    found = device_pair_join(fact, threshold).withColumn(
        "Relationship", F.when(F.col("Correlation") > 0, "positive").otherwise("negative")
    )
    return salted_join(found, stores, ["StoreNumber"], ["DeviceId"])


def recommend_allocation(telemetry: DataFrame, cost: DataFrame) -> DataFrame:
    """One row: the allocation method that suits the data, and why. Without cost there is nothing to tell them apart."""
    billed = cost.agg(F.count("*")).scalar()
    # per device the spread around its own mean; the spread of the means is added with the mean of all, which is known
    # by then, so nothing large is subtracted from something large
    value = F.col("TokensUsed").cast("double")
    groups = telemetry.groupBy(*PAIR).agg(
        F.count("*").alias("calls"), F.avg(value).alias("own"), (F.var_pop(value) * F.count(value)).alias("within")
    )
    overall = groups.agg(F.try_divide(F.sum(F.col("own") * F.col("calls")), F.sum("calls"))).scalar()
    groups = groups.withColumn("overall", overall)
    n, mean = F.sum("calls"), F.max("overall")
    apart = F.col("own") - F.col("overall")
    variance = F.when(n > 1, F.sum(F.col("within") + F.col("calls") * apart * apart) / (n - 1))
    call_mean = F.avg("calls")
    # Sample variance (not its root) over the mean, as the rule is defined.
    figures = groups.agg(
        F.coalesce(n, F.lit(0)).alias("records"),
        F.countDistinct("deviceId").alias("unique_devices"),
        F.try_divide(F.sum(F.when(F.col("deviceId") == UNKNOWN, F.col("calls")).otherwise(0)), n).alias("unknown_device_ratio"),
        mean.alias("token_mean"),
        (variance / F.greatest(mean, F.lit(1.0))).alias("token_spread"),
        (F.var_samp("calls") / F.greatest(call_mean, F.lit(1.0))).alias("call_spread"),
    )
    figures = figures.withColumn("billed_lines", billed)
    rules = [
        (F.col("records") == 0, "equal", "no usage to go by"),
        (F.col("billed_lines") == 0, "equal", "no cost to split"),
        (F.col("unknown_device_ratio") > UNKNOWN_RATIO_LIMIT, "equal", "most calls name no device"),
        (
            (F.col("token_spread") > TOKEN_SPREAD_LIMIT) & (F.col("token_mean") > 0),
            "token-based",
            "tokens vary much between calls",
        ),
        (F.col("call_spread") > CALL_SPREAD_LIMIT, "usage-based", "calls vary much between devices"),
        (F.col("unique_devices") > MANY_DEVICES, "proportional", "many devices of moderate variance"),
    ]
    method, reason = F.lit("proportional"), F.lit("usage is balanced")
    for condition, name, why in reversed(rules):
        method = F.when(condition, name).otherwise(method)
        reason = F.when(condition, why).otherwise(reason)
    return figures.withColumns({"recommended_method": method, "reason": reason})
