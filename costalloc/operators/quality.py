"""Checks on the allocated fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costalloc.functions.numbers import ratio_or_null
from costalloc.operators.correlate import KEYS

# Fixed value: accepted relative difference.
TOLERANCE = 0.01


def _verdict(rows: DataFrame) -> DataFrame:
    original, allocated = F.col("OriginalCost"), F.col("AllocatedCost")
    variance = F.abs(original - allocated)
    return rows.withColumns(
        {
            "Variance": ratio_or_null(variance, original),
            "IsValid": F.when(original == 0, allocated == 0).otherwise(
                variance <= TOLERANCE * F.abs(original)
            ),
        }
    )


def reconcile_allocation(fact: DataFrame, cost: DataFrame) -> DataFrame:
    """Billed cost against allocated cost, per window, resource and meter of the bill.

    Cost of a window without usage cannot be split: it is reported as UnallocatedCost and counts as a difference.
    """
    group = [*KEYS, "MeterName"]
    allocated = fact.groupBy(*group).agg(F.sum("AllocatedCost").alias("AllocatedCost"))
    original = cost.groupBy(*group).agg(F.sum("Cost").alias("OriginalCost"))
    return _verdict(_with_unallocated(original.join(allocated, group, "left")))


def reconcile_total(fact: DataFrame, cost: DataFrame) -> DataFrame:
    """One row: all billed cost against all allocated cost. Unallocated cost beyond the tolerance is not valid."""
    allocated = fact.groupBy(*KEYS).agg(F.sum("AllocatedCost").alias("AllocatedCost"))
    original = cost.groupBy(*KEYS).agg(F.sum("Cost").alias("OriginalCost"))
    rows = _with_unallocated(original.join(allocated, KEYS, "left"))
    sums = ("OriginalCost", "AllocatedCost", "UnallocatedCost")
    return _verdict(rows.agg(*[F.sum(c).alias(c) for c in sums]))


def _with_unallocated(rows: DataFrame) -> DataFrame:
    none = F.col("AllocatedCost").isNull()
    return rows.withColumns(
        {
            "UnallocatedCost": F.when(none, F.col("OriginalCost")).otherwise(0.0),
            "AllocatedCost": F.coalesce("AllocatedCost", F.lit(0.0)),
        }
    )


def unreadable_numbers(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: values that are there but are no number. They count as 0 further on; this says how many do."""

    def lost(name: str):
        text = F.btrim(F.col(name).cast("string"))
        return (F.length(text) > 0) & text.try_cast("double").isNull()

    counted = rows.agg(F.count("*").alias("RowsChecked"), *[F.count_if(lost(c)).alias(c) for c in columns])
    return counted.unpivot(["RowsChecked"], columns, "Column", "Unreadable")


def dq_rules(fact: DataFrame) -> DataFrame:
    """Number of rows that break each rule, in one pass."""

    def missing(name: str):
        return F.col(name).isNull() | (F.col(name).cast("string") == "")

    def outside(name: str):
        return F.col(name).isNull() | ~F.col(name).between(0.0, 1.0)

    rules = {
        "DeviceId present": missing("DeviceId"),
        "StoreNumber present": missing("StoreNumber"),
        "ResourceId present": missing("ResourceId"),
        "TimeWindow present": F.col("TimeWindow").isNull(),
        "AllocatedCost present": F.col("AllocatedCost").isNull(),
        "AllocatedCost not negative": F.col("AllocatedCost") < 0,
        "TokensUsed not negative": F.col("TokensUsed") < 0,
        "ApiCalls not negative": F.col("ApiCalls") < 0,
        "CorrelationConfidence between 0 and 1": outside("CorrelationConfidence"),
        "AllocationAccuracy between 0 and 1": outside("AllocationAccuracy"),
        "DeviceUtilizationScore between 0 and 1": outside("DeviceUtilizationScore"),
        "DeviceId known": F.col("IsUnknownDevice"),
        "StoreNumber known": F.col("IsUnknownStore"),
    }
    counted = fact.agg(
        F.count("*").alias("RowsChecked"),
        *[F.count_if(broken).alias(rule) for rule, broken in rules.items()],
    )
    return counted.unpivot(["RowsChecked"], list(rules), "Rule", "Violations")
