"""Rankings, shares and time comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costalloc.functions.numbers import ratio_or_null, ratio_or_zero
from costalloc.operators.skew import add_global_rank, sum_over_past

# Fixed value: part of the hourly totals below a peak hour.
PEAK_QUANTILE = 0.8


def _cost_by(fact: DataFrame, column: str) -> DataFrame:
    return fact.groupBy(column).agg(F.sum("AllocatedCost").alias("TotalCost"))


def device_rank(fact: DataFrame) -> DataFrame:
    """Devices ranked by cost, dearest first; equal costs share a rank."""
    # Ranked by a rounded cost, because a sum taken in another order must not break a tie.
    devices = _cost_by(fact, "DeviceId").withColumn("_cost", F.round("TotalCost", 9))
    return add_global_rank(devices, "_cost", "CostRank", ["DeviceId"]).drop("_cost")


def model_cost_share(fact: DataFrame) -> DataFrame:
    """Cost of each model family and its share of all cost."""
    # Families come from a fixed list of names, so this window holds a handful of rows.
    families = _cost_by(fact, "ModelFamily")
    total = F.sum("TotalCost").over(W.partitionBy(F.lit(1)))
    return families.withColumn("CostShare", ratio_or_zero(F.col("TotalCost"), total))


def daily_cost(costs: DataFrame, time: str, amount: str) -> DataFrame:
    return costs.groupBy(F.to_date(time).alias("Date")).agg(F.sum(amount).alias("Cost"))


def monthly_cost(costs: DataFrame, time: str, amount: str) -> DataFrame:
    month = F.trunc(F.to_date(time), "month")
    return costs.groupBy(month.alias("Month")).agg(F.sum(amount).alias("Cost"))


def every_month(monthly: DataFrame) -> DataFrame:
    """All months from the first to the last one, with cost 0 where there is none."""
    span = monthly.agg(F.min("Month").alias("a"), F.max("Month").alias("b")).where("a IS NOT NULL")
    spine = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("Month"))
    return spine.join(monthly, "Month", "left").select("Month", F.coalesce("Cost", F.lit(0.0)).alias("Cost"))


def _ahead(key: Column, steps: int, move) -> Column:
    """Targets (key, distance) from a row to itself and the next `steps` keys."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(steps)),
        lambda i: F.struct(move(key, i).alias("key"), i.alias("distance")),
    )


def cost_vs_prev_month(monthly: DataFrame) -> DataFrame:
    """Month cost less that of the month before, for every month from the first to the last; no cost counts as 0."""
    monthly = every_month(monthly)
    reach = _ahead(F.col("Month"), 1, F.add_months)
    both = sum_over_past(
        monthly, "Month", [], reach, {"CurrentCost": ("Cost", 0, 0), "PreviousCost": ("Cost", 1, 1)}
    )
    return both.withColumn("CostChange", F.col("CurrentCost") - F.col("PreviousCost"))


def trailing_30d_cost(daily: DataFrame) -> DataFrame:
    """Cost of the 30 days that end at each date."""
    reach = _ahead(F.col("Date"), 29, F.date_add)
    return sum_over_past(
        daily, "Date", [], reach, {"Cost": ("Cost", 0, 0), "TrailingCost": ("Cost", 0, 29)}
    )


def cost_forecast(monthly: DataFrame) -> DataFrame:
    """Next month by this month's growth; also the trailing three-month sum. Months without cost count as 0."""
    monthly = every_month(monthly)
    reach = _ahead(F.col("Month"), 2, F.add_months)
    rows = sum_over_past(
        monthly,
        "Month",
        [],
        reach,
        {"CurrentCost": ("Cost", 0, 0), "PreviousCost": ("Cost", 1, 1), "LastThreeMonths": ("Cost", 0, 2)},
    )
    current, previous = F.col("CurrentCost"), F.col("PreviousCost")
    growth = ratio_or_null(current - previous, previous)
    return rows.withColumn("GrowthRate", growth).withColumn(
        "ForecastCost", current * (F.lit(1.0) + F.coalesce("GrowthRate", F.lit(0.0)))
    )


def cost_anomaly_2sigma(fact: DataFrame, sigmas: float = 2.0) -> DataFrame:
    """Every fact row as High, Low or Normal against mean and spread of all rows."""
    limits = fact.agg(
        F.struct(F.avg("AllocatedCost").alias("mean"), F.stddev_samp("AllocatedCost").alias("spread"))
    ).scalar()
    cost, reach = F.col("AllocatedCost"), limits["spread"] * sigmas
    label = (
        F.when(cost > limits["mean"] + reach, "High")
        .when(cost < limits["mean"] - reach, "Low")
        .otherwise("Normal")
    )
    return fact.select(
        "TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "AllocatedCost", label.alias("CostAnomaly")
    )


def hourly_totals(telemetry: DataFrame) -> DataFrame:
    """Tokens per device, store and hour of the day: at most 24 rows a device."""
    hour = F.hour("TimeGenerated").alias("Hour")
    return telemetry.groupBy("deviceId", "storeNumber", hour).agg(F.sum("TokensUsed").alias("TotalTokens"))


def peak_hours(telemetry: DataFrame) -> DataFrame:
    """Hours of the day at or above the device's own 0.8 quantile of hourly tokens."""
    hours = hourly_totals(telemetry)
    w = W.partitionBy("deviceId", "storeNumber")  # at most 24 rows each
    threshold = F.percentile("TotalTokens", F.lit(PEAK_QUANTILE)).over(w)
    return hours.withColumn("Threshold", threshold).where(F.col("TotalTokens") >= F.col("Threshold"))


def top_devices(fact: DataFrame, n: int = 10) -> DataFrame:
    return _cost_by(fact, "DeviceId").orderBy(F.desc("TotalCost"), "DeviceId").limit(n)


def top_stores(fact: DataFrame, n: int = 10) -> DataFrame:
    return _cost_by(fact, "StoreNumber").orderBy(F.desc("TotalCost"), "StoreNumber").limit(n)


def top_device_cost(fact: DataFrame) -> DataFrame:
    """The single dearest device."""
    devices = _cost_by(fact, "DeviceId")
    return devices.agg(
        F.max_by("DeviceId", F.struct("TotalCost", "DeviceId")).alias("DeviceId"),
        F.max("TotalCost").alias("TopDeviceCost"),
    )


def recent_calls(logs: DataFrame, text: str = "FinOpsApiCall", n: int = 10) -> DataFrame:
    """The newest matching log lines (a top-n report)."""
    return (
        logs.where(F.lower("Message").contains(text.lower()))
        .orderBy(F.desc("TimeGenerated"), F.desc("event_id"))
        .limit(n)
        .select("TimeGenerated", "AppRoleName", "Message")
    )
