"""Cost that arrives hours after the usage it belongs to, and changes again later.

The fact is kept up by differences. A batch of billing lines is compared with the lines known before it; only lines whose cost
changed are split, over the usage of their windows, and what that changes is stored as one small folder per batch: the
new part less the old one. Readers add the differences up; merging in levels keeps them few. A batch thus costs what the
windows of its changed lines hold, whatever is stored besides.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from costalloc.operators.correlate import CELL, KEYS, LINE_LABELS, allocation_change, finish_fact
from costalloc.plans.fact import windowed_cost
from costalloc.sources import files
from costalloc.streaming.segments import DAY_PARTITION, Segments
from costalloc.streaming.usage import _in_range

HOUR_PARTITION = "WindowHour"
MOST_WINDOWS = 2000  # windows that a filter names one by one; beyond, it names their days, then their range
LINE_KEY = ["UsageDate", "ResourceId", "MeterName"]
_TYPES = {"TimeWindow": T.TimestampType(), "UsageDate": T.TimestampType(), "Cost": T.DoubleType(), "Batch": T.LongType()}
LINES = T.StructType([
    T.StructField(c, _TYPES.get(c, T.StringType()))
    for c in ["UsageDate", *KEYS, *LINE_LABELS, "Cost", "Batch"]
] + [T.StructField(DAY_PARTITION, T.DateType())])
_CHANGE_TYPES = {
    "TimeWindow": T.TimestampType(), "AllocatedCost": T.DoubleType(), "TotalCost": T.DoubleType(), "TokensUsed": T.LongType(),
    "ApiCalls": T.LongType(), "AvgResponseTime": T.DoubleType(), "TokenShare": T.DoubleType(), "ApiCallShare": T.DoubleType(),
    "Lines": T.LongType(),
}
CHANGES = T.StructType([
    T.StructField(c, _CHANGE_TYPES.get(c, T.StringType()))
    for c in [*KEYS, *CELL, "DeviceStoreKey", "AllocatedCost", "TotalCost", "AllocationMethod", "TokensUsed", "ApiCalls",
              "AvgResponseTime", *LINE_LABELS, "TokenShare", "ApiCallShare", "Lines"]
] + [T.StructField(DAY_PARTITION, T.DateType())])
ADDED = ["AllocatedCost", "TotalCost", "Lines"]


def write_usage(usage: DataFrame, path: str) -> None:
    """Store windowed usage by day and hour, for later correlation."""
    dated = usage.withColumns({DAY_PARTITION: F.to_date("TimeWindow"), HOUR_PARTITION: F.hour("TimeWindow")})
    spread = dated.hint("rebalance", DAY_PARTITION, HOUR_PARTITION)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY_PARTITION, HOUR_PARTITION).parquet(path)


def of_windows(windows: list[dt.datetime], hours: bool) -> Column:
    """A filter for the folders of some windows, of literals: it leaves out the others whatever the plan is."""
    days: dict[dt.date, list[int]] = {}
    for w in windows:
        days.setdefault(w.date(), []).append(w.hour)
    day = F.col(DAY_PARTITION)
    if not days:
        return F.lit(False)
    if len(days) > MOST_WINDOWS:
        return day.between(F.lit(min(days)), F.lit(max(days)))
    if not hours or len(windows) > MOST_WINDOWS:
        return day.isin([F.lit(d) for d in days])
    test = F.lit(False)
    for d, some in days.items():
        test = test | ((day == F.lit(d)) & F.col(HOUR_PARTITION).isin(sorted(set(some))))
    return test


def newest_lines(lines: DataFrame) -> DataFrame:
    """Of all batches' cost lines, those of the newest batch that has their date, resource and meter."""
    columns = [c for c in lines.columns if c not in (*LINE_KEY, "Batch")]
    best = F.max(F.struct("Batch", *columns)).alias("_best")
    return lines.groupBy(*LINE_KEY).agg(best).select(*LINE_KEY, *[f"_best.{c}" for c in (*columns, "Batch")])


def added_changes(changes: DataFrame) -> DataFrame:
    """Differences of one cell and line added up; what went away again is no row."""
    others = [c for c in changes.columns if c not in ADDED]
    return changes.groupBy(*others).agg(*[F.sum(c).alias(c) for c in ADDED])


def line_store(spark: SparkSession, path: str) -> Segments:
    return Segments(spark, path, LINES, newest_lines)


def change_store(spark: SparkSession, path: str) -> Segments:
    return Segments(spark, path, CHANGES, added_changes)


def changed_lines(new: DataFrame, old: DataFrame) -> DataFrame:
    """KEYS, LINE_LABELS, Cost, OldCost, Lines of lines that are new or whose cost or labels are not what they were.

    A line whose labels changed goes out under the old ones (Cost null) and comes in under the new ones.
    """
    labels = [c for c in LINE_LABELS if c != "MeterName"]
    was = old.select(*LINE_KEY, F.struct(*labels).alias("_was"), F.col("Cost").alias("OldCost"), F.lit(True).alias("_known"))
    both = new.join(was, LINE_KEY, "left").withColumn("_is", F.struct(*labels))
    known, same = F.coalesce("_known", F.lit(False)), F.col("_is").eqNullSafe(F.col("_was"))
    named = ["TimeWindow", "ResourceId", "MeterName"]

    def told(rows: DataFrame, under: str, cost, old_cost, change) -> DataFrame:
        parts = [F.col(f"{under}.{c}").alias(c) for c in labels]
        return rows.select(*named, *parts, cost.cast("double").alias("Cost"), old_cost.cast("double").alias("OldCost"), change.cast("bigint").alias("Lines"))

    moved = both.where(known & ~same)
    kept = both.where(~known | (same & (F.col("Cost") != F.col("OldCost"))))
    none = F.lit(None)
    return told(kept, "_is", F.col("Cost"), F.col("OldCost"), F.when(known, 0).otherwise(1)).unionByName(
        told(moved, "_was", none, F.col("OldCost"), F.lit(-1))
    ).unionByName(told(moved, "_is", F.col("Cost"), none, F.lit(1)))


def start_late_cost(
    billing: DataFrame,
    usage_path: str,
    cost_path: str,
    fact_path: str,
    checkpoint: str,
    method: str = "proportional",
    window_minutes: int = 60,
    **trigger,
) -> StreamingQuery:
    """Keep the fact up with billing rows that arrive, arrive again, or are restated.

    Of the lines with one date, resource and meter those of the newest batch count: a redelivery changes nothing, a
    restated amount replaces the old one. usage_path: usage as write_usage stores it. A batch that is run again replaces
    what it wrote. How many rows a batch has read and changed is noted beside the fact (`batch_notes`).
    """
    spark = billing.sparkSession
    lines, changes = line_store(spark, cost_path), change_store(spark, fact_path)

    def correlate(batch: DataFrame, batch_id: int) -> None:
        if lines.is_merged(batch_id) or changes.is_merged(batch_id):
            return  # done long ago
        told = windowed_cost(batch, window_minutes).groupBy("UsageDate", *KEYS, *LINE_LABELS).agg(F.sum("Cost").alias("Cost"))
        told = told.withColumns({"Batch": F.lit(batch_id).cast("bigint"), DAY_PARTITION: F.to_date("TimeWindow")})
        lines.write(told, batch_id)
        new = lines._read([f"b{batch_id:012d}"]).select(lines.columns)
        windows = [r[0] for r in new.select("TimeWindow").distinct().collect()]
        known = lines.before(batch_id).where(of_windows(windows, hours=False))
        changed = changed_lines(new, newest_lines(known)).persist(StorageLevel.DISK_ONLY)
        try:
            n_changed = changed.count()
            windows = [r[0] for r in changed.select("TimeWindow").distinct().collect()]
            usage = spark.read.parquet(usage_path).where(of_windows(windows, hours=True)).drop(DAY_PARTITION, HOUR_PARTITION)
            usage = usage.persist(StorageLevel.DISK_ONLY)
            n_usage = usage.count()
            change = allocation_change(usage, changed, method).withColumn(DAY_PARTITION, F.to_date("TimeWindow"))
            changes.write(change, batch_id)
            usage.unpersist()
        finally:
            changed.unpersist()
        note = f"{fact_path}/notes/{batch_id:012d}.json"
        files.delete(spark, note)
        files.put_text(spark, note, json.dumps({"Batch": batch_id, "LinesChanged": n_changed, "Windows": len(windows), "UsageRowsRead": n_usage}))
        lines.keep_small()
        changes.keep_small()

    writer = billing.writeStream.foreachBatch(correlate).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def batch_notes(spark: SparkSession, fact_path: str) -> DataFrame:
    """(Batch, LinesChanged, Windows, UsageRowsRead) of every batch."""
    return spark.read.schema("Batch bigint, LinesChanged bigint, Windows bigint, UsageRowsRead bigint").json(f"{fact_path}/notes")


def read_late_changes(spark: SparkSession, fact_path: str, start=None, end=None) -> DataFrame:
    """The allocation as it stands, of a half-open range of windows."""
    rows = _in_range(change_store(spark, fact_path).read(start, end), "TimeWindow", start, end)
    return rows.where("Lines > 0").drop("Lines", DAY_PARTITION)


def read_late_fact(spark: SparkSession, fact_path: str, as_of, start=None, end=None) -> DataFrame:
    """The fact as it stands, of a half-open range of windows."""
    return finish_fact(read_late_changes(spark, fact_path, start, end), as_of)
