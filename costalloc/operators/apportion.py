"""Splitting cost so that the parts add up to the bill to the last unit of money.

Shares in floating point leave a rest of rounding. Here a line is a whole number of units (by default millionths), every
cell gets its quota rounded down, and the units that are left go one by one to the cells whose quotas lost most: the rule of
largest remainders, in whole-number arithmetic. It is applied twice, first to parts of a line's cells, dealt by a hash, then to the
cells of each part, so that a line with very many cells is not in one task. Sums are exact at both levels.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costalloc.operators.correlate import CELL, KEYS, LINE_LABELS, METHODS, cells_with_lines, cost_lines, window_totals
from costalloc.operators.skew import LEAST_SALTS, _partitions

PLACES = 6
WEIGHT_SCALE = 1_000_000  # fractions of weighted tokens that still count
TASK_ROWS = 200_000  # cells of lines that one task sorts
LINE = [*KEYS, *LINE_LABELS]
WHOLE = T.DecimalType(38, 0)


def units(amount: Column, places: int = PLACES) -> Column:
    """Whole units of an amount; nothing for a credit, as in every method."""
    return F.greatest(F.round(amount * (10**places)), F.lit(0.0)).cast("bigint")


def _dealt(rows: DataFrame, within: str, whole: str, weight: str, order: list[Column], into: str, total: str | None = None) -> DataFrame:
    """Deal the units in `whole` over the rows of a group by their weights: floors first, then the largest remainders.

    total: a column with the sum of a group's weights, if it is known. The places come before the sum of the floors, so
    that one order of the rows serves both.
    """
    group = W.partitionBy(within)
    product = F.col(whole).cast(WHOLE) * F.col(weight).cast(WHOLE)
    known = F.sum(F.col(weight).cast(WHOLE)).over(group) if total is None else F.col(total)
    rows = rows.withColumn("_total", known.cast(WHOLE))
    some = F.col("_total") > 0
    rows = rows.withColumn("_floor", F.when(some, F.expr(f"CAST({whole} AS DECIMAL(38,0)) * {weight} DIV _total")).otherwise(0))
    rows = rows.withColumn("_rest", F.when(some, product % F.col("_total")).otherwise(F.lit(0).cast(WHOLE)))
    rows = rows.withColumn("_place", F.row_number().over(group.orderBy(F.desc("_rest"), *order)))
    rows = rows.withColumn("_left", F.col(whole) - F.sum("_floor").over(group))
    got = F.col("_floor") + F.when(some & (F.col("_place") <= F.col("_left")), 1).otherwise(0)
    return rows.withColumn(into, got.cast("bigint")).drop("_total", "_floor", "_rest", "_left", "_place")


def _tasks(usage: DataFrame, lines: DataFrame) -> int:
    """Among how many tasks to deal the cells of all lines, so that what one of them sorts does not grow with the tables."""
    n = lines.join(window_totals(usage), KEYS).agg(F.sum("Cells")).first()[0] or 0
    return max(_partitions(usage), -(-n // TASK_ROWS))


def allocate_exact(
    usage: DataFrame, cost: DataFrame, method: str = "proportional", places: int = PLACES, parts: int | None = None
) -> DataFrame:
    """Every cell's whole units of every cost line, and the amount as a decimal.

    By totals of the usage alone, as the conserving mode does it: an idle cell beside active ones gets nothing, all idle
    cells the same. parts: into how many a line's cells are dealt (default: by the shuffle partitions; 1 gives the plain rule).
    """
    if method not in METHODS:
        raise ValueError(f"unknown allocation {method!r}")
    lines = cost_lines(cost).withColumn("Lines", F.lit(1))
    cells = cells_with_lines(usage, lines)
    by = METHODS[method]
    scale = WEIGHT_SCALE if by == "WeightedTokens" else 1
    total = {"TokensUsed": "_tokens", "ApiCalls": "_calls", "WeightedTokens": "_weighted"}.get(by)
    weight = F.lit(1).cast("bigint") if by is None else F.when(F.col(total) > 0, F.floor(F.col(by) * scale)).otherwise(1).cast("bigint")
    n = parts or max(LEAST_SALTS, math.isqrt(_partitions(usage)))
    cells = cells.select(
        *LINE, *CELL, "TokensUsed", "ApiCalls", "TotalCost", units(F.col("TotalCost"), places).alias("TotalUnits"),
        weight.alias("Weight"), F.pmod(F.xxhash64(*CELL), F.lit(n)).cast("int").alias("Part"),
    )
    # a struct is never null and equal to one with the same nulls: one shuffle by it serves the join and the windows
    cells = cells.select(F.struct(*LINE, "Part").alias("_group"), *[c for c in cells.columns if c not in (*LINE, "Part")])
    heavy = cells.groupBy("_group").agg(F.sum("Weight").alias("PartWeight"), F.max("TotalUnits").alias("_units"))
    heavy = heavy.withColumns({"_line": F.struct(*[F.col(f"_group.{k}") for k in LINE]), "Part": F.col("_group.Part")})
    shares = _dealt(heavy, "_line", "_units", "PartWeight", [F.col("Part")], "PartUnits").select("_group", "PartWeight", "PartUnits")
    joined = cells.repartition(_tasks(usage, lines), "_group").join(shares, "_group")
    dealt = _dealt(joined, "_group", "PartUnits", "Weight", [F.col(c) for c in CELL], "Units", "PartWeight")
    dealt = dealt.select(*[F.col(f"_group.{k}").alias(k) for k in LINE], *CELL, "TokensUsed", "ApiCalls", "TotalCost", "TotalUnits", "Weight", "Units")
    amount = (F.col("Units").cast(T.DecimalType(38 - places, 0)) / F.lit(10**places).cast("decimal(18,0)")).cast(T.DecimalType(38, places))
    return dealt.select(*LINE, *CELL, "TokensUsed", "ApiCalls", "TotalCost", "TotalUnits", "Weight", "Units", amount.alias("AllocatedCost"))


def reconcile_exact(parts: DataFrame, cost: DataFrame, places: int = PLACES) -> DataFrame:
    """Billed units against allocated units per cost line: equal, or all unallocated where a window has no usage."""
    line = [*KEYS, "MeterName"]
    billed = cost_lines(cost).withColumn("Units", units(F.col("Cost"), places)).groupBy(*line).agg(F.sum("Units").alias("BilledUnits"))
    given = parts.groupBy(*line).agg(F.sum("Units").alias("given"), F.count("*").alias("Cells"))
    both = billed.join(given, line, "left")
    return both.select(
        *line, "BilledUnits", F.coalesce("given", F.lit(0)).alias("AllocatedUnits"), F.coalesce("Cells", F.lit(0)).alias("Cells"),
        F.when(F.col("given").isNull(), F.col("BilledUnits")).otherwise(0).alias("UnallocatedUnits"),
        (F.coalesce("given", F.col("BilledUnits")) == F.col("BilledUnits")).alias("IsExact"),
    )
