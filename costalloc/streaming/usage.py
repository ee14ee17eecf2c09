"""Usage windows and duplicate removal on an unbounded telemetry stream, without state.

Each micro-batch is reduced to partial results and stored under its number; partials are merged in levels, and readers
merge the few that are left, of the days that they ask for. So no row is too late: a window is complete as soon as its rows
have arrived, whenever that is, and a window that is still open can be read as well. A batch that runs twice replaces
its own partials. The module `stateful` has the forms that emit results once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from costalloc.functions.timeparts import moment
from costalloc.operators.cleanse import HOUR, preprocess_telemetry
from costalloc.operators.dedup import dedup_telemetry
from costalloc.schemas import TELEMETRY
from costalloc.streaming.segments import DAY_PARTITION, Segments

GROUP = ["TimeWindow", "ResourceId", "DeviceId", "StoreNumber"]
SUMS = ["TokensUsed", "ApiCalls", "ResponseTimeSum", "ResponseTimeCount"]
PARTIAL = T.StructType([
    T.StructField("TimeWindow", T.TimestampType()),
    *[T.StructField(c, T.StringType()) for c in GROUP[1:]],
    *[T.StructField(c, T.DoubleType() if c == "ResponseTimeSum" else T.LongType()) for c in SUMS],
    T.StructField(DAY_PARTITION, T.DateType()),
])
DEDUPED = T.StructType([*TELEMETRY.fields, T.StructField(DAY_PARTITION, T.DateType())])


def _start(stream: DataFrame, reduce, kept: Segments, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Store reduce(batch) for every micro-batch, and keep the folders few."""

    def store(batch: DataFrame, batch_id: int) -> None:
        kept.write(reduce(batch), batch_id)
        kept.keep_small()

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def partial_usage(telemetry: DataFrame, window_minutes: int = HOUR) -> DataFrame:
    """Sums and counts per window, resource, device and store, which can be added up."""
    cleaned = preprocess_telemetry(telemetry, window_minutes)
    return cleaned.groupBy(
        "TimeWindow", "ResourceId", F.col("deviceId").alias("DeviceId"), F.col("storeNumber").alias("StoreNumber")
    ).agg(
        F.sum("TokensUsed").alias("TokensUsed"),
        F.count("StatusCode").alias("ApiCalls"),
        F.sum("ResponseTime").alias("ResponseTimeSum"),
        F.count("ResponseTime").alias("ResponseTimeCount"),
    ).withColumn(DAY_PARTITION, F.to_date("TimeWindow"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partials of one group added up; columns that partials have besides are part of the group."""
    others = [c for c in partials.columns if c not in SUMS]
    return partials.groupBy(*others).agg(*[F.sum(c).alias(c) for c in SUMS])


def finished(partials: DataFrame) -> DataFrame:
    """Usage as usage_by_window gives it, from partials that may still be several to a group."""
    return partials.groupBy(*GROUP).agg(
        F.sum("TokensUsed").alias("TokensUsed"),
        F.sum("ApiCalls").alias("ApiCalls"),
        F.try_divide(F.sum("ResponseTimeSum"), F.sum("ResponseTimeCount")).alias("AvgResponseTime"),
    )


def usage_store(spark: SparkSession, path: str) -> Segments:
    return Segments(spark, path, PARTIAL, merge_partials)


def start_stream_usage(
    telemetry: DataFrame, path: str, checkpoint: str, window_minutes: int = HOUR, **trigger
) -> StreamingQuery:
    """Usage per window from a stream, as partials below path."""
    kept = usage_store(telemetry.sparkSession, path)
    return _start(telemetry, lambda batch: partial_usage(batch, window_minutes), kept, checkpoint, trigger)


def _in_range(rows: DataFrame, time: str, start, end) -> DataFrame:
    if start is not None:
        rows = rows.where(F.col(time) >= moment(start))
    return rows if end is None else rows.where(F.col(time) < moment(end))


def read_stream_usage(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Usage of all windows (of a half-open range of time) that have rows so far; late rows included."""
    return finished(_in_range(usage_store(spark, path).read(start, end), "TimeWindow", start, end))


def dedup_store(spark: SparkSession, path: str) -> Segments:
    return Segments(spark, path, DEDUPED, dedup_telemetry)


def start_stream_dedup(telemetry: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The best copy of every request within a batch, stored by batch and day; merging keeps the best of all."""

    def best(batch: DataFrame) -> DataFrame:
        return dedup_telemetry(batch).withColumn(DAY_PARTITION, F.to_date("TimeGenerated"))

    return _start(telemetry, best, dedup_store(telemetry.sparkSession, path), checkpoint, trigger)


def read_stream_dedup(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """One row per request and time (of a half-open range): the gateway's if there is one, whichever arrived first.

    The copies of a request carry the same time, so they lie in one day whatever their batch.
    """
    return _in_range(dedup_store(spark, path).read(start, end), "TimeGenerated", start, end).drop(DAY_PARTITION)
