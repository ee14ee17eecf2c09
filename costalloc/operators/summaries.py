"""Summaries of telemetry, cost and the allocated fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costalloc.functions.ids import UNKNOWN
from costalloc.functions.timeparts import moment, recency_weight, window_start
from costalloc.operators.cleanse import lookback_filter
from costalloc.operators.skew import salted_join

PAIR = ["DeviceId", "StoreNumber"]


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def telemetry_summary(telemetry: DataFrame) -> DataFrame:
    """One row: counts, distinct devices and stores, latency, tokens, success, time range."""
    # One row per pair first: the distinct counts then run on a small table.
    pairs = telemetry.groupBy("deviceId", "storeNumber").agg(
        F.count("*").alias("n"),
        F.sum("ResponseTime").alias("latency"),
        F.count("ResponseTime").alias("timed"),
        F.sum("TokensUsed").alias("tokens"),
        F.count_if(F.col("StatusCode") < 400).alias("good"),
        F.min("TimeGenerated").alias("first"),
        F.max("TimeGenerated").alias("last"),
    )
    total = _zero(F.sum("n"))
    return pairs.agg(
        total.alias("total_records"),
        F.countDistinct("deviceId").alias("unique_users"),
        F.countDistinct("storeNumber").alias("unique_stores"),
        total.alias("total_api_calls"),
        _zero(F.try_divide(F.sum("latency"), F.sum("timed"))).alias("avg_response_time"),
        _zero(F.sum("tokens")).alias("total_tokens"),
        _zero(F.try_divide(F.sum("good") * 100.0, F.sum("n"))).alias("success_rate"),
        F.min("first").alias("start_time"),
        F.max("last").alias("end_time"),
    )


def cost_summary(costs: DataFrame) -> DataFrame:
    """Total, per cost type and per model family, in one pass (long form)."""
    by_resource = costs.groupBy("CostType", "ModelFamily", "ResourceId").agg(
        F.sum("Cost").alias("Cost"),
        F.sum("UsageQuantity").alias("UsageQuantity"),
        F.min("UsageDate").alias("first"),
        F.max("UsageDate").alias("last"),
    )
    sets = [[], [F.col("CostType")], [F.col("ModelFamily")]]
    return (
        by_resource.groupingSets(sets, "CostType", "ModelFamily")
        .agg(
            F.grouping("CostType").alias("_no_type"),
            F.grouping("ModelFamily").alias("_no_model"),
            F.sum("Cost").alias("total_cost"),
            F.sum("UsageQuantity").alias("total_usage"),
            F.countDistinct("ResourceId").alias("unique_resources"),
            F.min("first").alias("start_date"),
            F.max("last").alias("end_date"),
        )
        .select(
            F.when(F.col("_no_type") == 0, "cost_type")
            .when(F.col("_no_model") == 0, "model_family")
            .otherwise("total")
            .alias("dimension"),
            F.when(F.col("_no_type") == 0, F.col("CostType"))
            .when(F.col("_no_model") == 0, F.col("ModelFamily"))
            .otherwise("all")
            .alias("value"),
            "total_cost",
            "total_usage",
            "unique_resources",
            "start_date",
            "end_date",
        )
    )


def correlation_summary(fact: DataFrame, method: str = "proportional") -> DataFrame:
    """One row about the whole fact; zeros when it is empty."""
    pairs = fact.groupBy(*PAIR).agg(
        F.count("*").alias("n"),
        F.sum("AllocatedCost").alias("cost"),
        F.count_if("IsUnknownDevice").alias("no_device"),
        F.count_if("IsUnknownStore").alias("no_store"),
        F.sum("CorrelationConfidence").alias("confidence"),
        F.sum("AllocationAccuracy").alias("accuracy"),
        F.sum("DeviceUtilizationScore").alias("utilization"),
    )

    def per_row(name: str, scale: float = 1.0) -> Column:
        return _zero(F.try_divide(F.sum(name) * scale, F.sum("n")))

    return pairs.agg(
        _zero(F.sum("n")).alias("total_records"),
        _zero(F.sum("cost")).alias("total_allocated_cost"),
        F.countDistinct("DeviceId").alias("unique_devices"),
        F.countDistinct("StoreNumber").alias("unique_stores"),
        F.count("*").alias("unique_device_store_combinations"),
        per_row("no_device", 100.0).alias("unknown_device_percentage"),
        per_row("no_store", 100.0).alias("unknown_store_percentage"),
        per_row("confidence").alias("avg_confidence"),
        per_row("accuracy").alias("avg_accuracy"),
        per_row("utilization").alias("avg_utilization_score"),
        F.lit(method).alias("allocation_method"),
    )


def cost_breakdowns(fact: DataFrame) -> DataFrame:
    """Cost by device, store, model and shift, from one scan (long form)."""
    # Name of each breakdown and its column.
    dimensions = {
        "device": "DeviceId", "store": "StoreNumber", "model": "ModelFamily", "shift": "ShiftCategory",
    }
    columns = list(dimensions.values())
    combined = fact.groupBy(*columns).agg(F.sum("AllocatedCost").alias("cost"))
    grouped = combined.groupingSets([[F.col(c)] for c in columns], *columns).agg(
        F.sum("cost").alias("cost"), *[F.grouping(c).alias(f"_{c}") for c in columns]
    )
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for dimension, column in dimensions.items():
        own = F.col(f"_{column}") == 0
        name = F.when(own, dimension).otherwise(name)
        value = F.when(own, F.col(column)).otherwise(value)
    return grouped.select(name.alias("dimension"), value.alias("value"), "cost")


def device_performance(fact: DataFrame) -> DataFrame:
    """Per device; the store is that of its earliest window."""
    earliest = F.struct("TimeWindow", "StoreNumber", "ResourceId", "MeterName")
    return fact.groupBy("DeviceId").agg(
        F.sum("AllocatedCost").alias("AllocatedCost_sum"),
        F.avg("AllocatedCost").alias("AllocatedCost_mean"),
        F.count("AllocatedCost").alias("AllocatedCost_count"),
        F.sum("TokensUsed").alias("TokensUsed_sum"),
        F.avg("TokensUsed").alias("TokensUsed_mean"),
        F.sum("ApiCalls").alias("ApiCalls_sum"),
        F.avg("ApiCalls").alias("ApiCalls_mean"),
        F.avg("AvgResponseTime").alias("AvgResponseTime_mean"),
        F.avg("DeviceUtilizationScore").alias("DeviceUtilizationScore_mean"),
        F.min_by("StoreNumber", earliest).alias("StoreNumber_first"),
    )


def _store_cells(fact: DataFrame) -> DataFrame:
    """One row per store and device, so that a store's devices can be counted plainly."""
    return fact.groupBy("StoreNumber", "DeviceId").agg(
        F.sum("AllocatedCost").alias("cost"),
        F.count("*").alias("n"),
        F.sum("TokensUsed").alias("tokens"),
        F.sum("ApiCalls").alias("calls"),
        F.sum("DeviceUtilizationScore").alias("utilization"),
    )


def store_performance(fact: DataFrame) -> DataFrame:
    n = F.sum("n")
    return _store_cells(fact).groupBy("StoreNumber").agg(
        F.sum("cost").alias("AllocatedCost_sum"),
        (F.sum("cost") / n).alias("AllocatedCost_mean"),
        n.alias("AllocatedCost_count"),
        F.sum("tokens").alias("TokensUsed_sum"),
        (F.sum("tokens") / n).alias("TokensUsed_mean"),
        F.sum("calls").alias("ApiCalls_sum"),
        (F.sum("calls") / n).alias("ApiCalls_mean"),
        F.count("*").alias("DeviceId_nunique"),
        (F.sum("utilization") / n).alias("DeviceUtilizationScore_mean"),
    )


def shift_analysis(fact: DataFrame) -> DataFrame:
    return fact.groupBy("ShiftCategory").agg(F.sum("AllocatedCost").alias("AllocatedCost"))


def business_hours_split(fact: DataFrame) -> DataFrame:
    cost, inside = F.col("AllocatedCost"), F.col("IsBusinessHours")
    return fact.agg(
        _zero(F.sum(F.when(inside, cost))).alias("business_hours"),
        _zero(F.sum(F.when(~inside, cost))).alias("non_business_hours"),
    )


def device_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*PAIR).agg(
        F.sum("AllocatedCost").alias("TotalCost"),
        F.count("AllocatedCost").alias("RecordCount"),
        F.sum("TokensUsed").alias("TotalTokens"),
        F.sum("ApiCalls").alias("TotalApiCalls"),
        F.avg("AvgResponseTime").alias("AvgResponseTime"),
        F.avg("DeviceUtilizationScore").alias("AvgUtilization"),
    )


def store_summary(fact: DataFrame) -> DataFrame:
    return _store_cells(fact).groupBy("StoreNumber").agg(
        F.sum("cost").alias("TotalCost"),
        F.sum("n").alias("RecordCount"),
        F.sum("tokens").alias("TotalTokens"),
        F.sum("calls").alias("TotalApiCalls"),
        F.count("*").alias("UniqueDevices"),
    )


def run_stats(telemetry: DataFrame, cost: DataFrame, fact: DataFrame) -> DataFrame:
    """One row of counters about a run."""
    usage = telemetry.groupBy("deviceId", "storeNumber").agg(F.count("*").alias("n")).agg(
        F.countDistinct("deviceId").alias("unique_users"),
        F.countDistinct("storeNumber").alias("unique_stores"),
        _zero(F.sum("n")).alias("total_api_calls"),
    )
    resources = cost.groupBy("ResourceId").agg(F.sum("Cost").alias("Cost"))
    billed = resources.agg(F.struct(_zero(F.sum("Cost")).alias("cost"), F.count("*").alias("resources"))).scalar()
    split = fact.agg(
        F.struct(_zero(F.sum("AllocatedCost")).alias("cost"), F.count("*").alias("records"))
    ).scalar()
    return usage.select(
        "*",
        billed["cost"].alias("total_cost"),
        billed["resources"].alias("unique_resources"),
        split["cost"].alias("allocated_cost"),
        split["records"].alias("records"),
    )


def weighted_usage(telemetry: DataFrame, as_of, decay_hours: float = 2.0, by_resource: bool = False) -> DataFrame:
    """Usage per device and store (and resource), weighted by age; calls are count times total weight."""
    weight = recency_weight(F.col("TimeGenerated"), moment(as_of), decay_hours)
    return (
        telemetry.withColumn("_w", weight)
        .groupBy("deviceId", "storeNumber", *["ResourceId" for _ in range(by_resource)])
        .agg(
            F.sum(F.col("TokensUsed") * F.col("_w")).alias("WeightedTokens"),
            (F.count("StatusCode") * F.sum("_w")).alias("WeightedApiCalls"),
            F.sum("_w").alias("TotalWeight"),
            F.max("TimeGenerated").alias("LatestTime"),
        )
    )


def weighted_cost(cost: DataFrame, as_of, decay_hours: float = 2.0) -> DataFrame:
    """Cost and quantity per resource, weighted by age."""
    weight = recency_weight(F.col("UsageDate"), moment(as_of), decay_hours)
    return (
        cost.withColumn("_w", weight)
        .groupBy("ResourceId")
        .agg(
            F.sum(F.col("Cost") * F.col("_w")).alias("WeightedCost"),
            F.sum(F.col("UsageQuantity") * F.col("_w")).alias("WeightedUsage"),
            F.sum("_w").alias("TotalWeight"),
            F.max("UsageDate").alias("LatestTime"),
        )
    )


def api_usage_analysis(telemetry: DataFrame, as_of) -> DataFrame:
    """The last day's calls by device, store and API, busiest first."""
    return (
        lookback_filter(telemetry, "TimeGenerated", as_of, days=1)
        .groupBy("deviceId", "storeNumber", "ApiName")
        .agg(
            F.count("*").alias("TotalCalls"),
            F.avg("ResponseTime").alias("AvgResponseTime"),
            F.sum("TokensUsed").alias("TotalTokens"),
            (F.count_if(F.col("StatusCode") < 400) * 100.0 / F.count("*")).alias("SuccessRate"),
        )
        .orderBy(F.desc("TotalCalls"), "deviceId", "storeNumber", "ApiName")
    )


def cost_by_user_store_day(fact: DataFrame, as_of) -> DataFrame:
    """The last seven days' cost by device, store and day, newest first."""
    return (
        lookback_filter(fact, "TimeWindow", as_of, days=7)
        .groupBy(*PAIR, F.to_date("TimeWindow").alias("Date"))
        .agg(
            F.sum("AllocatedCost").alias("TotalAllocatedCost"),
            F.avg("AllocatedCost").alias("AvgDailyCost"),
        )
        .orderBy(F.desc("Date"), F.desc("TotalAllocatedCost"), *PAIR)
    )


def model_usage_hourly(fact: DataFrame, prefix: str = "GPT-5", approximate: bool = False) -> DataFrame:
    """Cost, tokens and devices per model family and hour."""
    rows = fact.where(F.lower("ModelFamily").startswith(prefix.lower()))
    hour = window_start(F.col("TimeWindow"), 60).alias("HourStart")
    if approximate:
        return rows.groupBy("ModelFamily", hour).agg(
            F.sum("AllocatedCost").alias("TotalCost"),
            F.sum("TokensUsed").alias("TotalTokens"),
            F.approx_count_distinct("DeviceId").alias("UniqueDevices"),
        )
    devices = rows.groupBy("ModelFamily", hour, "DeviceId").agg(
        F.sum("AllocatedCost").alias("cost"), F.sum("TokensUsed").alias("tokens")
    )
    return devices.groupBy("ModelFamily", "HourStart").agg(
        F.sum("cost").alias("TotalCost"),
        F.sum("tokens").alias("TotalTokens"),
        F.count("*").alias("UniqueDevices"),
    )


def resource_health(telemetry: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Share of calls with a known resource."""
    resource = F.col("ResourceId")
    missing = resource.isNull() | resource.isin("", UNKNOWN)
    counts = lookback_filter(telemetry, "TimeGenerated", as_of, hours=hours).agg(
        F.count("*").alias("TotalCalls"),
        F.count_if(~missing).alias("ValidResourceCalls"),
        F.count_if(missing).alias("UnknownResourceCalls"),
    )
    score = F.round(F.try_divide(F.col("ValidResourceCalls") * 100.0, F.col("TotalCalls")), 2)
    # Lower bounds of the two better states.
    status = (
        F.when(F.col("HealthScore") >= 95, "Healthy")
        .when(F.col("HealthScore") >= 80, "Warning")
        .otherwise("Critical")
    )
    return counts.withColumn("HealthScore", score).withColumn("Status", status)


def resource_time_coverage(telemetry: DataFrame) -> DataFrame:
    return telemetry.groupBy("ResourceId").agg(
        F.count("*").alias("Calls"),
        F.min("TimeGenerated").alias("MinTime"),
        F.max("TimeGenerated").alias("MaxTime"),
    )


def _per_window(logs: DataFrame, minutes: int, name: str) -> DataFrame:
    start = window_start(F.col("TimeGenerated"), minutes).alias("WindowStart")
    return logs.groupBy(start).agg(F.count("*").alias(name))


def trace_rate_5m(logs: DataFrame, text: str = "FinOpsApiCall") -> DataFrame:
    return _per_window(logs.where(F.lower("Message").contains(text.lower())), 5, "Events")


def throttle_hits_10m(logs: DataFrame) -> DataFrame:
    """Log lines about throttling per ten minutes."""
    message = F.lower("Message")
    return _per_window(logs.where(message.contains("429") | message.contains("rate limit")), 10, "RateLimitHits")


def invocation_outcomes(logs: DataFrame) -> DataFrame:
    return logs.groupBy("AppRoleName").agg(
        F.count("*").alias("Invocations"),
        F.count_if("Success").alias("Successes"),
        F.count_if(~F.col("Success")).alias("Failures"),
    )


def error_count(logs: DataFrame, least_severity: int = 3) -> DataFrame:
    errors = logs.where(F.col("SeverityLevel") >= least_severity)
    return errors.groupBy("AppRoleName").agg(F.count("*").alias("Errors"))


def date_hierarchy_rollup(daily: DataFrame) -> DataFrame:
    """Cost by year, quarter, month and day, with all subtotals. Expects Date and Cost."""
    day = F.col("Date")
    parts = daily.select(
        F.year(day).alias("Year"),
        F.quarter(day).alias("Quarter"),
        F.month(day).alias("Month"),
        F.dayofmonth(day).alias("Day"),
        "Cost",
    )
    return parts.rollup("Year", "Quarter", "Month", "Day").agg(
        F.sum("Cost").alias("Cost"), F.grouping_id().cast("int").alias("Level")
    )


def store_hierarchy_rollup(fact: DataFrame, regions: DataFrame) -> DataFrame:
    """Cost and tokens by region and store, with subtotals."""
    by_resource = fact.groupBy("ResourceId", "StoreNumber").agg(
        F.sum("AllocatedCost").alias("Cost"), F.sum("TokensUsed").alias("Tokens")
    )
    return (
        salted_join(by_resource, regions, ["ResourceId"], ["StoreNumber"])
        .rollup("Region", "StoreNumber")
        .agg(
            F.sum("Cost").alias("Cost"),
            F.sum("Tokens").alias("Tokens"),
            F.grouping_id().cast("int").alias("Level"),
        )
    )
