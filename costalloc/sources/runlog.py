"""The log of runs, and which run counts for which window.

Runs overlap: each one looks back over some hours. A run that saw only the latter part of a window must not stand for
it, so every run publishes, last of all, the span of windows that it has seen whole. Readers look up the newest run
whose span holds a window in this log; no row of a fact is read to find it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costalloc.functions.timeparts import moment
from costalloc.sources import files

MINUTE = dt.timedelta(minutes=1)
EPOCH = dt.datetime(1970, 1, 1)
# The columns of the first version come first; runs that were stored before the others were added have none of them.
LOG = T.StructType([
    T.StructField(name, kind) for name, kind in [
        ("Format", T.StringType()), ("Date", T.DateType()), ("Run", T.StringType()), ("Rows", T.LongType()),
        ("FirstWindow", T.TimestampType()), ("LastWindow", T.TimestampType()), ("CoveredFrom", T.TimestampType()),
        ("CoveredTo", T.TimestampType()), ("SeenTo", T.TimestampType()), ("WindowMinutes", T.IntegerType()),
        ("Files", T.LongType()), ("Bytes", T.LongType()),
    ]
])


@dataclass(frozen=True)
class Span:
    """Half-open: windows from `start` on; whole up to `whole_to`; the window in progress was seen up to `seen_to`."""

    start: dt.datetime
    whole_to: dt.datetime
    seen_to: dt.datetime
    minutes: int = 60


def window_floor(time: dt.datetime, minutes: int) -> dt.datetime:
    """Start of the epoch-aligned window that holds a time."""
    return EPOCH + (time - EPOCH) // (minutes * MINUTE) * (minutes * MINUTE)


def span_of_run(as_of: dt.datetime, lookback_hours: float, minutes: int = 60, since: dt.datetime | None = None) -> Span:
    """The span of a run at `as_of`: its first window is begun from its edge, so it is whole.

    since: an earlier time from which to begin, if the lookback would leave a gap after it.
    """
    start = as_of - dt.timedelta(hours=lookback_hours)
    return Span(window_floor(min(start, since or start), minutes), window_floor(as_of, minutes), as_of, minutes)


def key_of(as_of: dt.datetime) -> str:
    """Name of a run; names sort by time."""
    return f"{as_of:%Y%m%d%H%M%S}"


def _entry(base: str, as_of: dt.datetime, kind: str) -> str:
    return f"{base}/manifest/Kind={kind}/Stamp={key_of(as_of)}"


def publish(spark: SparkSession, base: str, as_of: dt.datetime, kind: str, rows: list[dict]) -> None:
    """Enter a run, one row per format, when its data is complete: a run that broke off is not in the log."""
    table = spark.createDataFrame([tuple(r.get(f.name) for f in LOG.fields) for r in rows], LOG)
    table.coalesce(1).write.mode("overwrite").parquet(_entry(base, as_of, kind))


def withdraw(spark: SparkSession, base: str, as_of: dt.datetime, kind: str) -> None:
    """Take a run out of the log before its data is written again; until then older runs count."""
    files.delete(spark, _entry(base, as_of, kind))


def read_log(spark: SparkSession, base: str) -> DataFrame:
    """All entries: columns of LOG, Kind, Stamp and RunKey, the name of the run."""
    layout = T.StructType([*LOG.fields, T.StructField("Kind", T.StringType()), T.StructField("Stamp", T.StringType())])
    if not files.exists(spark, f"{base}/manifest"):
        return spark.createDataFrame([], layout).withColumn("RunKey", F.col("Stamp"))
    rows = spark.read.schema(layout).parquet(f"{base}/manifest")
    return rows.withColumn("RunKey", F.concat(F.date_format("Date", "yyyyMMdd"), "Run"))


def fold_log(spark: SparkSession, base: str, before: dt.datetime) -> int:
    """Put the entries of runs before a time into one file a day, and remove the single ones.

    A run may be in the log twice while this goes on, or after it broke off; that changes no answer. A run whose entry was
    put away can no longer be withdrawn, so fold only what will not be run again. Returns how many entries were put together.
    """
    done = 0
    for folder in files.folders(spark, f"{base}/manifest/Kind=*"):
        stamps: dict[str, list[str]] = {}
        for path in files.folders(spark, f"{folder}/Stamp=*"):
            stamp = path.rsplit("=", 1)[1]
            if "day" not in stamp and stamp < key_of(before):
                stamps.setdefault(stamp[:8], []).append(path)
        for day, paths in stamps.items():
            sources = [*paths, *files.folders(spark, f"{folder}/Stamp={day}-day*")]
            both = spark.read.schema(LOG).parquet(*sources).distinct()
            both.coalesce(1).write.parquet(f"{folder}/Stamp={day}-day-{uuid.uuid4().hex}")
            for path in sources:
                files.delete(spark, path)
            done += len(paths)
    return done


def owners(log: DataFrame, start=None, end=None) -> DataFrame:
    """(TimeWindow, RunKey): for every window of a half-open range the newest run that has it whole.

    The window in progress at the end of a run counts as long as no run has it whole. Each run tells its windows, cut to the
    range; the greatest name per window is an aggregate of the log, whose size hangs on runs, not on rows of the fact.
    """
    step = F.make_dt_interval(mins=F.col("WindowMinutes"))
    first, last = F.col("CoveredFrom"), F.col("SeenTo")
    if start is not None:
        early = (F.unix_micros(moment(start)) - F.unix_micros(first)) / (F.col("WindowMinutes") * F.lit(60e6))
        first = first + F.make_dt_interval(mins=(F.greatest(F.lit(0), F.ceil(early)) * F.col("WindowMinutes")).cast("int"))
    if end is not None:
        last = F.least(last, moment(end))
    told = F.when(last > first, F.sequence(first, last - F.expr("INTERVAL 1 MICROSECOND"), step))
    windows = log.where("CoveredFrom IS NOT NULL").select("RunKey", "CoveredTo", F.explode(told).alias("TimeWindow"))
    best = F.max(F.struct((F.col("TimeWindow") < F.col("CoveredTo")).alias("whole"), "RunKey"))
    return windows.groupBy("TimeWindow").agg(best.alias("best")).select("TimeWindow", F.col("best.RunKey").alias("RunKey"))


def uncovered(log: DataFrame, since: dt.datetime, until: dt.datetime, minutes: int = 60) -> DataFrame:
    """(TimeWindow): windows of a half-open span that no run has whole, earliest first."""
    spine = log.sparkSession.sql(
        f"SELECT explode(sequence(TIMESTAMP '{since}', TIMESTAMP '{until}' - INTERVAL 1 MICROSECOND, INTERVAL {minutes} MINUTES)) AS TimeWindow"
    )
    whole = log.withColumn("SeenTo", F.col("CoveredTo"))
    return spine.join(owners(whole, since, until), "TimeWindow", "left_anti").orderBy("TimeWindow")
