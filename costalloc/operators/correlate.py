"""Usage per time window, matched with cost, and the split of that cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costalloc.functions import scores
from costalloc.functions.ids import UNKNOWN
from costalloc.functions.numbers import ratio_or_zero
from costalloc.functions.timeparts import (
    day_name,
    is_business_hour,
    is_weekday,
    moment,
    recency_weight,
    shift,
)
from costalloc.operators.cleanse import HOUR
from costalloc.operators.skew import salted_join
from costalloc.schemas import CORRELATED_FACT

KEYS = ["TimeWindow", "ResourceId"]
CELL = ["DeviceId", "StoreNumber"]

# Allocation methods, and the usage column each one splits by.
METHODS = {
    "proportional": "TokensUsed",
    "token-based": "TokensUsed",
    "usage-based": "ApiCalls",
    "time-weighted": "WeightedTokens",
    "equal": None,
}
CONSERVING, REFERENCE = "conserving", "reference"
# The order of a stored run: cells of a window and resource with the same tokens and calls get the same part of each line,
# so side by side, and the lines of a cell next to each other, they pack into less than half of the bytes.
STORED_ORDER = ["TimeWindow", "ResourceId", "TokensUsed", "ApiCalls", "StoreNumber", "DeviceId", "MeterName"]
LINE_LABELS = ["MeterName", "CostType", "ModelFamily", "ResourceName", "ResourceGroup", "Currency"]


def usage_by_window(
    telemetry: DataFrame, window_minutes: int = HOUR, decay_hours: float | None = None
) -> DataFrame:
    """Tokens, calls and mean response time per window, resource, device and store.

    With `decay_hours` also the tokens weighted by age at the end of the window.
    Expects the columns of preprocess_telemetry.
    """
    aggregates = [
        F.sum("TokensUsed").alias("TokensUsed"),
        F.count("StatusCode").alias("ApiCalls"),
        F.avg("ResponseTime").alias("AvgResponseTime"),
    ]
    if decay_hours is not None:
        end = F.col("TimeWindow") + F.make_dt_interval(mins=F.lit(window_minutes))
        weight = recency_weight(F.col("TimeGenerated"), end, decay_hours)
        aggregates.append(F.sum(F.col("TokensUsed") * weight).alias("WeightedTokens"))
    usage = telemetry.groupBy(
        *KEYS, F.col("deviceId").alias("DeviceId"), F.col("storeNumber").alias("StoreNumber")
    ).agg(*aggregates)
    # A 32-bit hash is never above the greatest 32-bit number and never NULL, so this keeps every row, whatever is
    # NULL in it. It needs all measures in every use of this table, so that totals and detail share one shuffle
    # instead of scanning the input twice.
    measures = sorted(set(usage.columns) - {*KEYS, *CELL})
    return usage.where(F.hash(*measures) <= (1 << 31) - 1)


def window_totals(usage: DataFrame) -> DataFrame:
    """Totals and number of cells per window and resource, merged before the shuffle."""
    sums = [
        F.sum("TokensUsed").alias("TotalTokens"),
        F.sum("ApiCalls").alias("TotalCalls"),
        F.count("*").alias("Cells"),
    ]
    if "WeightedTokens" in usage.columns:
        sums.append(F.sum("WeightedTokens").alias("TotalWeighted"))
    return usage.groupBy(*KEYS).agg(*sums)


def cost_lines(cost: DataFrame) -> DataFrame:
    """Cost per window, resource and meter: one line per distinct set of labels."""
    return cost.groupBy(*KEYS, *LINE_LABELS).agg(
        F.sum("Cost").alias("Cost"), F.sum("UsageQuantity").alias("UsageQuantity")
    )


def first_cost_line(cost: DataFrame) -> DataFrame:
    """The first line of each window and resource by cost_seq, and the number of lines."""
    order = F.struct(*[c for c in ("cost_seq", "MeterName", "Cost") if c in cost.columns])
    line = F.struct("Cost", "UsageQuantity", *LINE_LABELS)
    return (
        cost.groupBy(*KEYS)
        .agg(F.min_by(line, order).alias("_line"), F.count("*").alias("Lines"))
        .select(*KEYS, "_line.*", "Lines")
    )


def correlate_time_window(usage: DataFrame, lines: DataFrame) -> DataFrame:
    """Usage cells matched with every cost line of their window and resource."""
    return salted_join(usage, lines, KEYS, CELL)


def uncorrelated_rows(usage: DataFrame, cost: DataFrame) -> DataFrame:
    """Windows with usage but no cost, and with cost but no usage."""
    used, billed = window_totals(usage), cost.groupBy(*KEYS).agg(F.sum("Cost").alias("Cost"))
    no_cost = used.join(billed, KEYS, "left_anti").select(
        *KEYS,
        F.lit("usage without cost").alias("Side"),
        F.col("TotalTokens").alias("TokensUsed"),
        F.col("TotalCalls").alias("ApiCalls"),
        F.lit(0.0).alias("Cost"),
    )
    no_usage = billed.join(used, KEYS, "left_anti").select(
        *KEYS,
        F.lit("cost without usage").alias("Side"),
        F.lit(0).cast("bigint").alias("TokensUsed"),
        F.lit(0).cast("bigint").alias("ApiCalls"),
        "Cost",
    )
    return no_cost.unionByName(no_usage)


def usage_shares(usage: DataFrame) -> DataFrame:
    """Each cell's share of the tokens and calls of its window and resource."""
    cells = salted_join(usage, window_totals(usage), KEYS, CELL)
    return cells.withColumns(
        {
            "TokenShare": ratio_or_zero(F.col("TokensUsed"), F.col("TotalTokens")),
            "ApiCallShare": ratio_or_zero(F.col("ApiCalls"), F.col("TotalCalls")),
        }
    ).drop("TotalTokens", "TotalCalls", "Cells", "TotalWeighted")


def _share(method: str, mode: str) -> Column:
    """Part of a line's cost that falls to one cell."""
    equal = F.lit(1.0) / F.col("_cells")
    by = METHODS[method]
    if by is None:
        return equal
    totals = {"TokensUsed": "_tokens", "ApiCalls": "_calls", "WeightedTokens": "_weighted"}
    weight, total = F.col(by), F.col(totals[by])
    if mode == REFERENCE:
        return F.when((total > 0) & (weight > 0), weight / total).otherwise(equal)
    return F.when(total > 0, weight / total).otherwise(equal)


def allocate(
    usage: DataFrame,
    cost: DataFrame,
    method: str = "proportional",
    mode: str = CONSERVING,
    by_day: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """Split the cost of each window and resource over its usage cells.

    conserving: every cost line is split in full over the cells, by totals taken
    on the usage alone. reference: only the first line's cost counts, totals are
    inflated by the number of lines, and an idle cell still gets an equal part.
    Expects usage of usage_by_window and cost of preprocess_cost. by_day: deal the rows by day, by measured size (the
    rebalance hint), before amounts, shares and labels make them wide. in_order: each task's rows come in STORED_ORDER;
    cells are sorted before they meet the single lines of their window and resource, so a sort holds one row per cell.
    """
    if method not in METHODS or mode not in (CONSERVING, REFERENCE):
        raise ValueError(f"unknown allocation {method!r} / {mode!r}")
    cells = _costed_cells(usage, cost, mode, in_order)
    if by_day:
        cells = cells.withColumn("_day", F.to_date("TimeWindow")).hint("rebalance", "_day")
    if in_order:
        cells = cells.sortWithinPartitions(*STORED_ORDER[:-1])
        cells = cells.withColumn("_line", F.explode("_lines")).select(*cells.drop("_lines").columns, "_line.*")
    if mode == REFERENCE:
        cells = cells.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("Lines"))))
    return cells.select(
        *KEYS,
        *CELL,
        F.concat_ws("_", *CELL).alias("DeviceStoreKey"),
        _cost_part(method, mode).alias("AllocatedCost"),
        "TotalCost",
        F.lit(method).alias("AllocationMethod"),
        "TokensUsed",
        "ApiCalls",
        "AvgResponseTime",
        *LINE_LABELS,
        ratio_or_zero(F.col("TokensUsed"), F.col("_tokens")).alias("TokenShare"),
        ratio_or_zero(F.col("ApiCalls"), F.col("_calls")).alias("ApiCallShare"),
    )


def _cost_part(method: str, mode: str, cost: str = "TotalCost") -> Column:
    if mode == REFERENCE and method == "time-weighted":
        method = "proportional"
    return F.coalesce(F.when(F.col(cost) > 0, _share(method, mode) * F.col(cost)), F.lit(0.0))


def allocation_change(usage: DataFrame, lines: DataFrame, method: str = "proportional") -> DataFrame:
    """What changed cost lines change in the fact, split as `allocate` does it in conserving mode.

    lines: KEYS, LINE_LABELS, Cost, OldCost (null for a new line) and Lines (1 for a new line, -1 for one that is gone, else 0).
    AllocatedCost, TotalCost and Lines are differences, to be added to what is there.
    """
    if method not in METHODS:
        raise ValueError(f"unknown allocation {method!r}")
    lines = lines.withColumnsRenamed({"Lines": "LineChange"}).withColumn("Lines", F.lit(1))
    cells = cells_with_lines(usage, lines, ("OldCost", "LineChange"))
    return cells.select(
        *KEYS,
        *CELL,
        F.concat_ws("_", *CELL).alias("DeviceStoreKey"),
        (_cost_part(method, CONSERVING) - _cost_part(method, CONSERVING, "OldCost")).alias("AllocatedCost"),
        (F.coalesce("TotalCost", F.lit(0.0)) - F.coalesce("OldCost", F.lit(0.0))).alias("TotalCost"),
        F.lit(method).alias("AllocationMethod"),
        "TokensUsed",
        "ApiCalls",
        "AvgResponseTime",
        *LINE_LABELS,
        ratio_or_zero(F.col("TokensUsed"), F.col("_tokens")).alias("TokenShare"),
        ratio_or_zero(F.col("ApiCalls"), F.col("_calls")).alias("ApiCallShare"),
        F.col("LineChange").alias("Lines"),
    )


def allocated_by_all(usage: DataFrame, cost: DataFrame, mode: str = CONSERVING) -> DataFrame:
    """Cost per resource by every method, from one join of usage and cost.

    Expects usage with WeightedTokens.
    """
    copies = F.col("Lines") if mode == REFERENCE else F.lit(1)
    totals = _costed_cells(usage, cost, mode).groupBy("ResourceId").agg(
        *[F.sum(_cost_part(method, mode) * copies).alias(method) for method in METHODS]
    )
    return totals.unpivot(["ResourceId"], list(METHODS), "Method", "AllocatedCost").withColumn("Mode", F.lit(mode))


def _costed_cells(usage: DataFrame, cost: DataFrame, mode: str, listed: bool = False) -> DataFrame:
    """Usage cells with the cost lines of their window and resource, and the totals to split them by."""
    lines = cost_lines(cost).withColumn("Lines", F.lit(1)) if mode == CONSERVING else first_cost_line(cost)
    return cells_with_lines(usage, lines, listed=listed)


def cells_with_lines(
    usage: DataFrame, lines: DataFrame, carried: tuple[str, ...] = (), listed: bool = False
) -> DataFrame:
    """As above, for lines as they are; carried: further columns of a line to keep. listed: a cell stays one row, and what
    belongs to its lines is a list of structs in the column _lines, by meter."""
    # One small row per billed line: what a cell needs to know about its group.
    rates = lines.join(window_totals(usage), KEYS)
    rates = rates.select(
        *KEYS,
        *LINE_LABELS,
        *carried,
        F.col("Cost").alias("TotalCost"),
        "Lines",
        (F.col("TotalTokens") * F.col("Lines")).alias("_tokens"),
        (F.col("TotalCalls") * F.col("Lines")).alias("_calls"),
        (F.col("Cells") * F.col("Lines")).alias("_cells"),
        *[F.col("TotalWeighted").alias("_weighted") for c in usage.columns if c == "WeightedTokens"],
    )
    if listed:
        line = F.struct("MeterName", *[c for c in rates.columns if c not in (*KEYS, "MeterName")])
        rates = rates.groupBy(*KEYS).agg(F.sort_array(F.collect_list(line)).alias("_lines"))
        # like cells into the same task: a broadcast would leave them spread; what is large for a task is split by its size
        return salted_join(usage.hint("merge"), rates, KEYS, ["TokensUsed", "ApiCalls"])
    return salted_join(usage, rates, KEYS, CELL)


def enrich_fact(allocated: DataFrame, as_of) -> DataFrame:
    """Attribution flags, unit costs, clock attributes and time stamps."""
    hour = F.hour("TimeWindow")
    no_device, no_store = F.col("DeviceId") == UNKNOWN, F.col("StoreNumber") == UNKNOWN
    return allocated.withColumns(
        {
            "CorrelationTimestamp": moment(as_of),
            "ProcessingDate": F.to_date(moment(as_of)),
            "IsUnknownDevice": no_device,
            "IsUnknownStore": no_store,
            "HasCompleteAttribution": ~(no_device | no_store),
            "CostPerToken": ratio_or_zero(F.col("AllocatedCost"), F.col("TokensUsed")),
            "CostPerApiCall": ratio_or_zero(F.col("AllocatedCost"), F.col("ApiCalls")),
            "Hour": hour,
            "DayOfWeek": day_name(F.col("TimeWindow")),
            "IsBusinessHours": is_business_hour(hour),
            "IsWeekday": is_weekday(F.col("TimeWindow")),
            "ShiftCategory": shift(hour),
        }
    )


def score_fact(fact: DataFrame) -> DataFrame:
    no_device, no_store = F.col("IsUnknownDevice"), F.col("IsUnknownStore")
    tokens = F.col("TokensUsed")
    return fact.withColumns(
        {
            "CorrelationConfidence": scores.confidence(no_device, no_store, tokens),
            "AllocationAccuracy": scores.accuracy(F.col("AllocationMethod"), no_device, no_store, tokens),
            "DeviceUtilizationScore": scores.utilization(F.col("ApiCalls"), tokens),
        }
    )


def finish_fact(allocated: DataFrame, as_of) -> DataFrame:
    return score_fact(enrich_fact(allocated, as_of)).select(CORRELATED_FACT.names)
