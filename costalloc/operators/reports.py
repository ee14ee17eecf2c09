"""Tables behind the dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costalloc.functions.ids import UNKNOWN
from costalloc.functions.numbers import ratio_or_zero
from costalloc.operators.correlate import KEYS

# Model families of the newest generation, and the shifts.
GPT5_FAMILIES = ["GPT-5", "GPT-5-Turbo", "GPT-5-Preview"]
SHIFTS = ["Morning", "Evening", "Night"]


def kpi_core(fact: DataFrame) -> DataFrame:
    """Total cost and tokens, cost per token, devices and stores."""
    pairs = fact.groupBy("DeviceId", "StoreNumber").agg(
        F.sum("AllocatedCost").alias("cost"), F.sum("TokensUsed").alias("tokens")
    )
    totals = pairs.agg(
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("TotalCost"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("TotalTokens"),
        F.countDistinct("DeviceId").alias("ActiveDevices"),
        F.countDistinct("StoreNumber").alias("StoreCount"),
    )
    return totals.withColumn("CostPerToken", ratio_or_zero(F.col("TotalCost"), F.col("TotalTokens")))


def store_cost_known(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("StoreNumber") != UNKNOWN)
        .groupBy("StoreNumber")
        .agg(F.sum("AllocatedCost").alias("StoreCost"), F.count("*").alias("StoreApiCount"))
    )


def gpt5_measures(fact: DataFrame) -> DataFrame:
    """Cost of the newest models, its ratio to the former ones, tokens per cost."""
    family, cost = F.col("ModelFamily"), F.col("AllocatedCost")
    sums = fact.agg(
        F.coalesce(F.sum(F.when(family.isin(GPT5_FAMILIES), cost)), F.lit(0.0)).alias("Gpt5Cost"),
        F.coalesce(F.sum(F.when(family.startswith("GPT-4"), cost)), F.lit(0.0)).alias("Gpt4Cost"),
        F.sum(F.when(family.startswith("GPT-5"), F.col("TokensUsed"))).alias("_tokens"),
        F.sum(F.when(family.startswith("GPT-5"), cost)).alias("_cost"),
    )
    return sums.select(
        "Gpt5Cost",
        ratio_or_zero(F.col("Gpt5Cost"), F.col("Gpt4Cost")).alias("Gpt5ToGpt4CostRatio"),
        ratio_or_zero(F.col("_tokens"), F.col("_cost")).alias("Gpt5TokensPerCost"),
    )


def _by_model(fact: DataFrame) -> DataFrame:
    return fact.groupBy("ModelFamily").agg(
        F.sum("TokensUsed").alias("TotalTokens"),
        F.sum("AllocatedCost").alias("TotalCost"),
        F.avg("AvgResponseTime").alias("AvgResponseTime"),
    )


def model_performance_score(fact: DataFrame) -> DataFrame:
    """Tokens per cost and second of mean response time."""
    per_cost = ratio_or_zero(F.col("TotalTokens"), F.col("TotalCost"))
    seconds = F.col("AvgResponseTime") / 1000
    return _by_model(fact).select(
        "ModelFamily", F.when(seconds != 0, per_cost / seconds).alias("PerformanceScore")
    )


def model_efficiency(fact: DataFrame) -> DataFrame:
    cost_per_token = ratio_or_zero(F.col("TotalCost"), F.col("TotalTokens"))
    return _by_model(fact).withColumn("CostPerToken", cost_per_token)


def shift_pivot(fact: DataFrame) -> DataFrame:
    pivoted = fact.groupBy("StoreNumber").pivot("ShiftCategory", SHIFTS).sum("AllocatedCost")
    return pivoted.fillna(0.0, SHIFTS).select("StoreNumber", *[F.col(s).alias(f"{s}Cost") for s in SHIFTS])


def dim_date(fact: DataFrame, time: str = "TimeWindow") -> DataFrame:
    """Calendar over the days the data spans."""
    span = fact.agg(F.min(F.to_date(time)).alias("a"), F.max(F.to_date(time)).alias("b")).where("a IS NOT NULL")
    # Month by month, so that one wrong date makes many rows instead of one huge array.
    months = span.select("a", "b", F.explode(F.sequence(F.trunc("a", "month"), "b", F.expr("INTERVAL 1 MONTH"))).alias("m"))
    days = F.sequence(F.greatest("a", "m"), F.least("b", F.last_day("m")))
    day = F.col("Date")
    return months.select(F.explode(days).alias("Date")).select(
        "Date",
        F.year(day).alias("Year"),
        F.month(day).alias("Month"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("Quarter"),
        F.dayofweek(day).alias("Weekday"),
        F.date_format(day, "EEEE").alias("WeekdayName"),
        (F.weekday(day) < 5).alias("IsBusinessDay"),
        F.dayofmonth(day).alias("DayOfMonth"),
    )


def usage_heatmap(telemetry: DataFrame) -> DataFrame:
    """Calls by device and hour of the day, one column per hour."""
    hours = list(range(24))
    pivoted = (
        telemetry.groupBy(F.col("deviceId").alias("DeviceId"), F.hour("TimeGenerated").alias("Hour"))
        .agg(F.count("*").alias("n"))
        .groupBy("DeviceId")
        .pivot("Hour", hours)
        .sum("n")
    )
    return pivoted.select(
        "DeviceId", *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"Hour{h:02d}") for h in hours]
    )


def model_by_store(fact: DataFrame) -> DataFrame:
    """Cost and tokens by store and model, and each store's dearest model."""
    cells = fact.groupBy("StoreNumber", "ModelFamily").agg(
        F.sum("AllocatedCost").alias("Cost"), F.sum("TokensUsed").alias("Tokens")
    )
    # At most one row per model family in a partition, and the families are a fixed list.
    preferred = F.max_by("ModelFamily", F.struct("Cost", "ModelFamily")).over(W.partitionBy("StoreNumber"))
    return cells.withColumn("PreferredModel", preferred)


def daily_cost_trend(fact: DataFrame) -> DataFrame:
    """Cost per day: for all stores together, and for each."""
    by_store = fact.groupBy(F.to_date("TimeWindow").alias("Date"), "StoreNumber").agg(
        F.sum("AllocatedCost").alias("Cost")
    )
    sets = [[F.col("Date")], [F.col("Date"), F.col("StoreNumber")]]
    trend = by_store.groupingSets(sets, "Date", "StoreNumber").agg(
        F.sum("Cost").alias("Cost"), F.grouping("StoreNumber").alias("_all")
    )
    return trend.select(
        "Date", F.when(F.col("_all") == 1, "all").otherwise(F.col("StoreNumber")).alias("StoreNumber"), "Cost"
    )


def daily_usage_share(daily_fact: DataFrame) -> DataFrame:
    """Daily resource cost and each device's share of it. Expects a fact at one-day windows."""
    cells = daily_fact.groupBy(*KEYS, "DeviceId", "StoreNumber").agg(
        F.sum("AllocatedCost").alias("AllocatedCost"), F.max("TokenShare").alias("UsageShare"),
        F.sum("TotalCost").alias("DailyCost"),
    )
    return cells.withColumn("Date", F.to_date("TimeWindow")).drop("TimeWindow")


def star_join(fact: DataFrame, dates: DataFrame, devices: DataFrame, stores: DataFrame) -> DataFrame:
    """Fact rows with the attributes of their date, device and store.

    Plain joins: a dimension that turns out small is broadcast by its measured size; else adaptive execution splits
    the rows of a hot device or store, also by measured size, and cold keys cost nothing extra.
    """
    dated = fact.withColumn("Date", F.to_date("TimeWindow")).join(dates, "Date", "left")
    return dated.join(devices, "DeviceId", "left").join(stores, "StoreNumber", "left")
