"""Streams that emit each result once: keyed state, event-time timers, late rows, corrections.

State is kept per hour and bucket, not per group or request: one bucket holds its cells or requests as a list, which is
read and merged as a whole in pandas. A batch thus makes a few calls to the state store per bucket that it touches, and a
bucket goes when its hour is over. Results are written as one folder per batch and merged in levels.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from costalloc.operators.cleanse import HOUR, preprocess_telemetry
from costalloc.operators.dedup import IDENTITY, SOURCE_ORDER, dedup_telemetry
from costalloc.schemas import TELEMETRY
from costalloc.streaming.segments import DAY_PARTITION, Segments
from costalloc.streaming.usage import GROUP, PARTIAL, SUMS, _in_range, finished, merge_partials

# A stream with state also starts a Python process beside the driver, which sees neither the session's Python files nor
# the driver's sys.path. The processors need nothing else of this package, so they travel whole instead of by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CLOSED, LATE = "closed", "late"
DELAY = "4 hours"
BUCKETS = 8
MERGE_AT = 4096  # list entries of a bucket that are merged into one per cell

CELL = GROUP[1:]
CELLS = ", ".join([*(f"{c} string" for c in CELL), *(f"{c} {'double' if c == 'ResponseTimeSum' else 'long'}" for c in SUMS)])
EMITTED = T.StructType([*PARTIAL.fields[:-1], T.StructField("Kind", T.StringType())])


def _plain(ts: str, minutes: int) -> Column:
    """Start of the window of a time, as a column that carries no watermark: state must see late rows as well."""
    step = minutes * 60_000_000
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step)))


class ClosedWindows(StatefulProcessor):
    """Per window and bucket: adds up cells, emits them once when the window is over, and passes on what comes later."""

    def __init__(self, minutes: int, merge_at: int = MERGE_AT):
        self.minutes, self.merge_at = minutes, merge_at

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cells = handle.getListState("cells", CELLS)
        self.entries = handle.getValueState("entries", "n long")

    @staticmethod
    def _added_up(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby(CELL, as_index=False, dropna=False)[SUMS].sum()

    def _held(self) -> pd.DataFrame:
        return self._added_up(pd.DataFrame(list(self.cells.get()), columns=[*CELL, *SUMS]))

    @staticmethod
    def _tuples(rows: pd.DataFrame) -> list[tuple]:
        texts = [[None if pd.isna(x) else str(x) for x in rows[c]] for c in CELL]
        sums = [[float(x) if c == "ResponseTimeSum" else int(x) for x in rows[c]] for c in SUMS]
        return list(zip(*texts, *sums, strict=True))

    def _told(self, key: tuple, rows: pd.DataFrame, kind: str) -> pd.DataFrame:
        told = rows[[*CELL, *SUMS]].copy()
        told.insert(0, "TimeWindow", key[0])
        told["Kind"] = kind
        return told

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = self._added_up(pd.concat(list(rows)))
        over = int(pd.Timestamp(key[0]).timestamp() * 1000) + self.minutes * 60_000
        if over <= timerValues.getCurrentWatermarkInMs():
            yield self._told(key, new, LATE)
            return
        known = self.entries.get()[0] if self.entries.exists() else 0
        if not known:
            self.handle.registerTimer(over)
        if known + len(new) > self.merge_at:
            new = self._added_up(pd.concat([self._held(), new]))
            self.cells.put(self._tuples(new))
            known = 0
        else:
            self.cells.appendList(self._tuples(new))
        self.entries.update((known + len(new),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.cells.exists():
            yield self._told(key, self._held(), CLOSED)
        self.cells.clear()
        self.entries.clear()

    def close(self) -> None:
        pass


def closed_usage(
    telemetry: DataFrame, window_minutes: int = HOUR, delay: str = DELAY, buckets: int = BUCKETS, merge_at: int = MERGE_AT
) -> DataFrame:
    """Cells of usage, as sums that can be added up: once `closed`, when the watermark has passed the end of their window, then `late`.

    delay: how far the watermark stays behind the latest time. It bounds the state, not the result: a row that is later
    than that comes out with the next batch as a late part of its cell.
    """
    cleaned = preprocess_telemetry(telemetry.withWatermark("TimeGenerated", delay), window_minutes)
    rows = cleaned.select(
        _plain("TimeGenerated", window_minutes).alias("TimeWindow"),
        F.pmod(F.hash("ResourceId", "deviceId", "storeNumber"), F.lit(buckets)).alias("Bucket"),
        "ResourceId",
        F.col("deviceId").alias("DeviceId"),
        F.col("storeNumber").alias("StoreNumber"),
        "TokensUsed",
        F.lit(1).cast("bigint").alias("ApiCalls"),
        F.col("ResponseTime").alias("ResponseTimeSum"),
        F.lit(1).cast("bigint").alias("ResponseTimeCount"),
    )
    return rows.groupBy("TimeWindow", "Bucket").transformWithStateInPandas(
        ClosedWindows(window_minutes, merge_at), EMITTED, "Append", "EventTime"
    )


CLOSED_LAYOUT = T.StructType([*EMITTED.fields, T.StructField(DAY_PARTITION, T.DateType())])


def closed_store(spark: SparkSession, path: str) -> Segments:
    return Segments(spark, path, CLOSED_LAYOUT, merge_partials)


def start_closed_usage(
    telemetry: DataFrame, path: str, checkpoint: str, window_minutes: int = HOUR, delay: str = DELAY,
    buckets: int = BUCKETS, merge_at: int = MERGE_AT, **trigger
) -> StreamingQuery:
    """Store closed windows and late parts below path, by day and kind of result."""
    kept = closed_store(telemetry.sparkSession, path)

    def store(batch: DataFrame, batch_id: int) -> None:
        kept.write(batch.withColumn(DAY_PARTITION, F.to_date("TimeWindow")), batch_id)
        kept.keep_small()

    writer = closed_usage(telemetry, window_minutes, delay, buckets, merge_at).writeStream.foreachBatch(store)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_closed_usage(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Usage of all windows that are over, late rows merged."""
    return finished(_in_range(closed_store(spark, path).read(start, end), "TimeWindow", start, end))


def read_late_parts(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """What came after its window was emitted."""
    rows = closed_store(spark, path).read(start, end).where(F.col("Kind") == LATE)
    return _in_range(rows, "TimeWindow", start, end).drop("Kind", DAY_PARTITION)


# Corrections ----------------------------------------------------------------------------------------------------------

PAYLOAD = [f.name for f in TELEMETRY.fields if f.name not in IDENTITY]
HELD = T.StructType([T.StructField("_priority", T.IntegerType()), *[TELEMETRY[c] for c in [*IDENTITY, *PAYLOAD]]])
CHANGE = T.StructType([*TELEMETRY.fields, T.StructField("Sign", T.IntegerType())])


class BestCopies(StatefulProcessor):
    """Per hour and bucket of requests: the best copy of each request so far; tells what a batch changes."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", HELD)

    @staticmethod
    def _chosen(rows: pd.DataFrame) -> pd.DataFrame:
        """Of each request and time the least (priority, row), null before any value, as dedup_telemetry chooses."""
        ordered = rows.sort_values([*IDENTITY, "_priority", *PAYLOAD], na_position="first", kind="stable")
        return ordered.drop_duplicates(IDENTITY)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = HELD.fieldNames()
        new = pd.concat(list(rows))
        new["_priority"] = [SOURCE_ORDER.index(s) if s in SOURCE_ORDER else len(SOURCE_ORDER) for s in new["Source"]]
        new = new[names].astype(object)
        over = int(pd.Timestamp(key[0]).timestamp() * 1000) + self.keep_ms
        if over > timerValues.getCurrentWatermarkInMs():
            known = self.best.exists()
            old = pd.DataFrame(list(self.best.get()) if known else [], columns=names, dtype=object)
            if not known:
                self.handle.registerTimer(over)
        else:
            known, old = None, pd.DataFrame([], columns=names, dtype=object)  # forgotten: readers choose again
        both = self._chosen(pd.concat([old.assign(_new=0), new.assign(_new=1)]))
        added = both[both["_new"] == 1]
        if not len(added):
            return
        if known is not None:
            held = both.drop(columns="_new")
            self.best.put([tuple(None if pd.isna(x) else x for x in row) for row in held.itertuples(index=False, name=None)])
        replaced = old.merge(added[IDENTITY], on=IDENTITY)
        told = pd.concat([replaced.assign(Sign=-1), added.drop(columns="_new").assign(Sign=1)])
        yield told[CHANGE.fieldNames()]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.best.clear()
        yield pd.DataFrame(columns=CHANGE.fieldNames())

    def close(self) -> None:
        pass


def dedup_changes(telemetry: DataFrame, keep_hours: int = 24, delay: str = DELAY, buckets: int = BUCKETS) -> DataFrame:
    """What each batch changes in the deduplicated telemetry: rows with Sign 1 come in, rows with Sign -1 go out.

    A request is known until the watermark is keep_hours past its hour. A copy that comes later is told as if it were the first;
    read_dedup_changes chooses among those when it reads.
    """
    rows = telemetry.withWatermark("TimeGenerated", delay).where("TimeGenerated IS NOT NULL")
    columns = [F.timestamp_micros(F.unix_micros("TimeGenerated")).alias(c) if c == "TimeGenerated" else F.col(c) for c in TELEMETRY.fieldNames()]
    keyed = rows.select(
        _plain("TimeGenerated", HOUR).alias("Hour"), F.pmod(F.hash("RequestId"), F.lit(buckets)).alias("Bucket"), *columns
    )
    return keyed.groupBy("Hour", "Bucket").transformWithStateInPandas(
        BestCopies((1 + keep_hours) * 3_600_000), CHANGE, "Append", "EventTime"
    )


CHANGE_LAYOUT = T.StructType([*CHANGE.fields, T.StructField(DAY_PARTITION, T.DateType())])


def net_changes(changes: DataFrame) -> DataFrame:
    """Rows that came in and went out again cancel."""
    others = [c for c in changes.columns if c != "Sign"]
    return changes.groupBy(*others).agg(F.sum("Sign").cast("int").alias("Sign")).where("Sign <> 0")


def changes_store(spark: SparkSession, path: str) -> Segments:
    return Segments(spark, path, CHANGE_LAYOUT, net_changes)


def start_dedup_changes(telemetry: DataFrame, path: str, checkpoint: str, **how) -> StreamingQuery:
    """Store the changes below path, batch by batch."""
    kept = changes_store(telemetry.sparkSession, path)
    trigger = how.pop("trigger", {"availableNow": True})

    def store(batch: DataFrame, batch_id: int) -> None:
        kept.write(batch.withColumn(DAY_PARTITION, F.to_date("TimeGenerated")), batch_id)
        kept.keep_small()

    writer = dedup_changes(telemetry, **how).writeStream.foreachBatch(store)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_dedup_changes(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """The deduplicated telemetry (of a half-open range of time)."""
    rows = _in_range(changes_store(spark, path).read(start, end), "TimeGenerated", start, end)
    return dedup_telemetry(rows.where("Sign > 0").drop("Sign", DAY_PARTITION))


def usage_of_changes(changes: DataFrame, window_minutes: int = HOUR) -> DataFrame:
    """Partial usage that a batch of changes adds or takes away: a sum of usage is kept up without reading old batches."""
    cleaned = preprocess_telemetry(changes, window_minutes)
    sign = F.col("Sign")
    return cleaned.groupBy(
        "TimeWindow", "ResourceId", F.col("deviceId").alias("DeviceId"), F.col("storeNumber").alias("StoreNumber")
    ).agg(
        F.sum(F.col("TokensUsed") * sign).alias("TokensUsed"),
        F.sum(sign).cast("bigint").alias("ApiCalls"),
        F.sum(F.col("ResponseTime") * sign).alias("ResponseTimeSum"),
        F.sum(sign).cast("bigint").alias("ResponseTimeCount"),
    ).withColumn(DAY_PARTITION, F.to_date("TimeWindow"))
