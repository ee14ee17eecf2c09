"""One scheduled run: collect, correlate, store, count; and the repeated run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from costalloc.operators.cleanse import between
from costalloc.operators.sinks import write_by_window, write_fact, write_raw, write_summaries
from costalloc.plans.fact import correlated_fact, windowed_cost
from costalloc.sources.billing import model_services
from costalloc.sources.runlog import MINUTE, read_log, span_of_run, uncovered, window_floor
from costalloc.sources.store import FACT, FORMATS, read_partition

STATS = (
    "unique_users bigint, unique_stores bigint, total_api_calls bigint, total_cost double, unique_resources bigint, "
    "allocated_cost double, records bigint"
)


def run_once(
    spark: SparkSession,
    telemetry: DataFrame,
    billing: DataFrame,
    as_of: dt.datetime,
    base: str,
    lookback_hours: float = 24,
    method: str = "proportional",
    window_minutes: int = 60,
    since: dt.datetime | None = None,
    by_window: bool = False,
) -> DataFrame:
    """Run the whole job for one moment and return its counters.

    The lookback begins at the edge of a window (with `since`, not after that time), so the run has all its windows
    whole but the one in progress, and the log says so. Each input is read once: what the lookback holds is kept on the
    executors' disks while the job runs and read again only where an executor is lost. Calls, cost and records are counted
    inside the writes. Summaries are taken from the stored run. The same moment may be run again: it replaces its output.
    by_window: store the run for reports over a range of time, too.
    """
    span = span_of_run(as_of, lookback_hours, window_minutes, since)
    recent = between(telemetry, "TimeGenerated", span.start, as_of).persist(StorageLevel.DISK_ONLY)
    billed = between(model_services(billing), "UsageDate", span.start, as_of).persist(StorageLevel.DISK_ONLY)
    try:
        calls = Observation()
        write_raw(recent.observe(calls, F.count("*").alias("n")), billed, base, as_of)
        fact = correlated_fact(recent, billed, as_of, method=method, window_minutes=window_minutes)
        seen = write_fact(fact, base, as_of, span, window_minutes)
        stored = read_partition(spark, base, as_of.date())
        if by_window:
            write_by_window(stored, base, as_of, span, window_minutes)
        write_summaries(stored, base, as_of)
        pairs = recent.groupBy("deviceId", "storeNumber").agg(F.count("*").alias("n"))
        users = pairs.agg(F.countDistinct("deviceId"), F.countDistinct("storeNumber")).first()
        cost = windowed_cost(billed, window_minutes).groupBy("ResourceId").agg(F.sum("Cost").alias("Cost"))
        bills = cost.agg(F.coalesce(F.sum("Cost"), F.lit(0.0)), F.count("*")).first()
        row = (users[0], users[1], calls.get["n"], float(bills[0]), bills[1], float(seen["AllocatedCost"]), seen["Rows"])
        return spark.createDataFrame([row], STATS)
    finally:
        recent.unpersist()
        billed.unpersist()


Sources = Callable[[], tuple[DataFrame, DataFrame]]


def run_due(
    spark: SparkSession,
    sources: Sources,
    now: dt.datetime,
    base: str,
    first: dt.datetime,
    lookback_hours: float = 1,
    window_minutes: int = 60,
    **how,
) -> DataFrame:
    """The run for `now`, which also makes up for what earlier runs have missed.

    It looks back to the first window from `first` on that no run has whole, if that is further than the lookback. So
    after an interruption of any length the next run leaves no gap. sources: gives telemetry and billing as they are now.
    """
    log = read_log(spark, base).where((F.col("Kind") == FACT) & (F.col("Format") == FORMATS[0]))
    floor = window_floor(now, window_minutes)
    gap = uncovered(log, window_floor(first, window_minutes), floor, window_minutes).first() if floor > first else None
    since = gap.TimeWindow if gap else None
    return run_once(spark, *sources(), now, base, lookback_hours, window_minutes=window_minutes, since=since, **how)


def start_schedule(
    spark: SparkSession,
    sources: Sources,
    base: str,
    checkpoint: str,
    first: dt.datetime,
    every: dt.timedelta = 6 * MINUTE,
    pace: str | None = None,
    **how,
) -> StreamingQuery:
    """Run again and again: for `first`, and for every further moment in steps of `every`.

    The moments come from a stream of ticks, and its checkpoint holds the last one that was done: a restarted schedule goes
    on with the next. A tick that failed is tried again when the schedule is started anew, and its run replaces what it left behind. pace: how
    often a tick is taken (default: as often as `every`); a short pace lets a schedule catch up.
    """
    step = int(every.total_seconds() * 1000)
    ticks = spark.readStream.format("rate-micro-batch").options(
        rowsPerBatch=1, numPartitions=1, startTimestamp=int(first.replace(tzinfo=dt.timezone.utc).timestamp() * 1000),
        advanceMillisPerBatch=step,
    ).load()

    def run(batch: DataFrame, batch_id: int) -> None:
        told = batch.agg(F.max(F.unix_millis("timestamp"))).first()[0]
        if told is not None:
            now = dt.datetime.fromtimestamp(told / 1000, dt.timezone.utc).replace(tzinfo=None)
            run_due(spark, sources, now, base, first, **how)

    writer = ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=pace or f"{step} milliseconds").start()
