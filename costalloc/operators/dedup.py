"""Union of telemetry sources and duplicate handling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IDENTITY = ["RequestId", "TimeGenerated"]

# Which source wins for the same request.
SOURCE_ORDER = ["APIM", "ApplicationInsights"]


def union_telemetry(gateway: DataFrame, requests: DataFrame) -> DataFrame:
    return gateway.unionByName(requests, allowMissingColumns=True)


def dedup_telemetry(rows: DataFrame) -> DataFrame:
    """One row per request and time: the gateway's if there is one.

    The least (priority, row) is a plain aggregate, so copies of a request are
    merged before the shuffle and no task has to hold all copies of a hot one.
    """
    priority = F.lit(len(SOURCE_ORDER))
    for place, source in enumerate(SOURCE_ORDER):
        priority = F.when(F.col("Source") == source, place).otherwise(priority)
    payload = [c for c in rows.columns if c not in IDENTITY]
    best = F.min(F.struct(priority.alias("_priority"), *payload))
    return (
        rows.groupBy(*IDENTITY)
        .agg(best.alias("_best"))
        .select(*[F.col(c) if c in IDENTITY else F.col(f"_best.{c}") for c in rows.columns])
    )


def duplicate_check(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*IDENTITY).agg(F.count("*").alias("Copies")).where(F.col("Copies") > 1)
