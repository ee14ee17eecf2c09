"""Overlapping runs, the log that says which one counts, and the repeated run."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from costalloc.operators import sinks
from costalloc.plans.fact import correlated_fact
from costalloc.plans.run import run_due, run_once, start_schedule
from costalloc.session import run_dir
from costalloc.sources import files, runlog, store
from costalloc.sources import testtables as tt
from costalloc.sources.runlog import Span, owners, read_log, span_of_run, uncovered, window_floor

NOON = dt.datetime(2024, 1, 24, 12)
HOUR = dt.timedelta(hours=1)


def at(hour, minute=0, day=24):
    return dt.datetime(2024, 1, day, hour, minute)


def bills_at_45(spark, small):
    """Bills within the window: one that only sees the latter half of a window still finds its cost."""
    return tt.billing(spark, small).withColumn("UsageDate", F.col("UsageDate") + F.expr("INTERVAL 45 MINUTES"))


def key(rows):
    columns = ["TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "TokensUsed", F.round("AllocatedCost", 9)]
    return sorted(map(tuple, rows.select(columns).collect()))


def test_spans():
    span = span_of_run(at(12, 30), 6)
    assert span == Span(at(6), at(12), at(12, 30), 60)
    assert span_of_run(NOON, 6) == Span(at(6), NOON, NOON, 60)
    assert span_of_run(at(12, 30), 6, since=at(3, 20)).start == at(3)
    assert window_floor(at(12, 44), 15) == at(12, 30) and window_floor(dt.datetime(1969, 12, 31, 23, 59), 60).hour == 23


def log_of(spark, *runs):
    """runs: (name, covered from, covered to, seen to)"""
    rows = [("parquet", None, None, 1, None, None, a, b, c, 60, 1, 1, name) for name, a, b, c in runs]
    layout = runlog.LOG.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", RunKey string"
    return spark.createDataFrame(rows, layout)


def test_newest_whole_run_owns_a_window(spark):
    log = log_of(
        spark,
        ("r1", at(6), at(12), at(12)),
        ("r2", at(7), at(12), at(12, 30)),  # has 12:00 in part
        ("r3", at(13), at(14), at(14, 10)),
        ("r4", at(8), at(8), at(8)),  # covers nothing
    )
    got = {r.TimeWindow.hour: r.RunKey for r in owners(log).collect()}
    assert got == {6: "r1", 7: "r2", 8: "r2", 9: "r2", 10: "r2", 11: "r2", 12: "r2", 13: "r3", 14: "r3"}
    assert {r.TimeWindow.hour for r in owners(log, at(7, 30), at(9)).collect()} == {8}
    older = log_of(spark, ("r1", at(6), at(13), at(13)), ("r2", at(6), at(12), at(12, 30)))
    assert {r.RunKey for r in owners(older).where("hour(TimeWindow) = 12").collect()} == {"r1"}  # whole beats newer and partial
    assert [r.TimeWindow.hour for r in uncovered(log, at(5), at(16)).collect()] == [5, 12, 14, 15]


def test_a_later_run_that_begins_within_a_window_takes_nothing_from_it(spark, small):
    """The case that lost half of a window: runs half an hour apart, six hours back, bills at minute 45."""
    base = run_dir(spark, "t")
    calls, bills = tt.telemetry(spark, small), bills_at_45(spark, small)
    for moment in (NOON, at(12, 30)):
        run_once(spark, calls, bills, moment, base, lookback_hours=6, by_window=True)
    want = correlated_fact(calls, bills, tt.AS_OF).where((F.col("TimeWindow") >= F.lit(at(6))) & (F.col("TimeWindow") < F.lit(NOON)))
    columns = ["TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "TokensUsed", "AllocatedCost"]
    assert key(store.combine_files(spark, base, columns)) == key(want) != []
    assert key(store.read_windows(spark, base, at(6), NOON)) == key(want)


def test_a_truncated_window_is_not_published(spark, small):
    """A run stored by hand from the middle of a window on: its log entry starts with the next window."""
    base = run_dir(spark, "t")
    calls, bills = tt.telemetry(spark, small), bills_at_45(spark, small)
    whole = correlated_fact(calls, bills, tt.AS_OF)
    half = correlated_fact(calls.where(F.col("TimeGenerated") >= F.lit(at(6, 30))), bills, tt.AS_OF)
    half = half.where(F.col("TimeWindow") >= F.lit(at(6)))
    sinks.write_by_window(whole, base, NOON)
    sinks.write_by_window(half, base, NOON + HOUR, Span(at(7), dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31)))
    got = store.read_windows(spark, base)
    assert key(got) == key(whole)
    owned = {r.RunKey: r.n for r in owners(read_log(spark, base), at(6), at(8)).groupBy("RunKey").agg(F.count("*").alias("n")).collect()}
    assert owned == {"20240124120000": 1, "20240124130000": 1}


def test_a_run_that_breaks_off_is_not_seen(spark, small):
    base = run_dir(spark, "t")
    fact = correlated_fact(tt.telemetry(spark, small), tt.billing(spark, small), tt.AS_OF)
    n = fact.count()
    sinks.write_by_window(fact, base, NOON)
    sinks.write_by_window(fact.where("AllocatedCost > 0"), base, NOON + HOUR)
    runlog.withdraw(spark, base, NOON + HOUR, store.WINDOWS)  # as if it had not got to its last step
    assert store.read_windows(spark, base).count() == n


def test_folding_the_log_changes_no_answer(spark, small):
    base = run_dir(spark, "t")
    fact = correlated_fact(tt.telemetry(spark, small), tt.billing(spark, small), tt.AS_OF)
    for hours in range(4):
        sinks.write_by_window(fact.where(F.col("TimeWindow") >= F.lit(at(hours, day=10 + hours))), base, at(hours))
    before = sorted(map(tuple, owners(read_log(spark, base)).collect()))
    assert runlog.fold_log(spark, base, at(3)) == 3 and runlog.fold_log(spark, base, at(3)) == 0
    assert len(files.folders(spark, f"{base}/manifest/Kind=windows/Stamp=*")) == 2
    assert sorted(map(tuple, owners(read_log(spark, base)).collect())) == before
    sinks.write_by_window(fact, base, at(5))
    assert runlog.fold_log(spark, base, at(6)) == 2
    assert len(files.folders(spark, f"{base}/manifest/Kind=windows/Stamp=*")) == 1
    assert {r.RunKey for r in owners(read_log(spark, base)).select("RunKey").distinct().collect()} == {"20240124050000"}


def test_the_run_counts_rows_files_and_bytes(spark, small):
    base = run_dir(spark, "t")
    run_once(spark, tt.telemetry(spark, small), tt.billing(spark, small), NOON, base, lookback_hours=240)
    listed = {r.Format: r for r in store.read_manifest(spark, base).collect()}
    for file_format in store.FORMATS:
        said = listed[file_format]
        folder = f"{base}/{file_format}/Year=2024/Month=01/Day=24/Run=120000"
        assert (said.Files, said.Bytes) == files.size_of(spark, folder) and said.Bytes > 0
        assert said.Rows == store.read_partition(spark, base, NOON.date(), file_format).count()
    metrics = {r.TableName: r for r in sinks.storage_metrics(spark, base, NOON).collect()}
    assert metrics["total"].Bytes == sum(r.Bytes for r in listed.values()) and metrics["total"].Files == sum(r.Files for r in listed.values())
    expired = sinks.retention_report(spark, base, NOON + dt.timedelta(days=91)).collect()
    assert sum(r.BytesToFree for r in expired) == metrics["total"].Bytes


def counting(rows, counter):
    def passed(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(passed, rows.schema)


def test_a_run_reads_each_input_once(spark, small):
    calls, bills = tt.telemetry(spark, small), tt.billing(spark, small)
    n_calls, n_bills = calls.count(), bills.count()
    read = [spark.sparkContext.accumulator(0) for _ in range(2)]
    stats = run_once(spark, counting(calls, read[0]), counting(bills, read[1]), at(0, day=31), run_dir(spark, "t"), lookback_hours=24 * 60)
    assert [r.value for r in read] == [n_calls, n_bills]
    row = stats.first()
    assert row.total_api_calls == n_calls and row.records > 0 and row.unique_users > 1 and row.total_cost > 0


def test_large_days_are_written_by_several_tasks(spark):
    """The rebalance splits a day by its measured size, and small days stay one file."""
    size, merge = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(size)
    spark.conf.set(merge, "false")  # else the small test has a single task that could be split
    small = tt.telemetry(spark, "/root/testdata/sf0.01")
    fact = correlated_fact(small, tt.billing(spark, "/root/testdata/sf0.01"), tt.AS_OF)
    one_day = fact.where("to_date(TimeWindow) = DATE '2024-01-10'")
    try:
        for limit, least, most in (("64m", 1, 1), ("20k", 2, 1000)):
            spark.conf.set(size, limit)
            base = run_dir(spark, "t")
            sinks.write_by_window(one_day, base, NOON)
            n, _ = files.size_of(spark, f"{base}/windows/WindowDate=2024-01-10/RunStamp=*")
            assert least <= n <= most, (limit, n)
            assert store.read_windows(spark, base).count() == one_day.count()
    finally:
        spark.conf.set(size, old)
        spark.conf.set(merge, "true")


def test_missed_runs_are_made_up_for(spark, small):
    base, calls, bills = run_dir(spark, "t"), tt.telemetry(spark, small), bills_at_45(spark, small)
    sources = lambda: (calls, bills)
    first = at(0, day=23)
    run_due(spark, sources, at(2, 6, day=23), base, first, lookback_hours=1)
    run_due(spark, sources, at(3, 12, day=23), base, first, lookback_hours=1)
    run_due(spark, sources, at(12, 30), base, first, lookback_hours=1)  # a day later
    log = read_log(spark, base).where("Format = 'parquet'")
    assert uncovered(log, first, NOON).count() == 0
    starts = [r.CoveredFrom for r in log.orderBy("RunKey").collect()]
    assert starts == [first, at(2, day=23), at(3, day=23)]
    want = correlated_fact(calls, bills, tt.AS_OF).where((F.col("TimeWindow") >= F.lit(first)) & (F.col("TimeWindow") < F.lit(NOON)))
    columns = ["TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "TokensUsed", "AllocatedCost"]
    got = store.combine_files(spark, base, columns).where(F.col("TimeWindow") < F.lit(NOON))
    assert key(got) == key(want) != []


def test_schedule_goes_on_where_it_was_stopped(spark, small):
    base, calls, bills = run_dir(spark, "t"), tt.telemetry(spark, small), bills_at_45(spark, small)
    first = at(10)

    def until(n):
        query = start_schedule(spark, lambda: (calls, bills), f"{base}/store", f"{base}/state", first, 30 * runlog.MINUTE, pace="100 milliseconds")
        try:
            for _ in range(600):
                if len(files.folders(spark, f"{base}/store/manifest/Kind=fact/Stamp=*")) >= n or query.exception():
                    break
                time.sleep(0.1)
            assert not query.exception()
        finally:
            query.stop()

    until(1)
    until(3)
    stamps = [n.split("=")[1] for n in files.names(spark, f"{base}/store/manifest/Kind=fact/Stamp=*")]
    assert stamps[:3] == ["20240124100000", "20240124103000", "20240124110000"]  # no moment is left out or new


def test_atomic_text(spark):
    path = run_dir(spark, "t") + "/note.json"
    files.put_text(spark, path, "é1")
    assert files.read_text(spark, path) == "é1"
    with pytest.raises(FileExistsError):
        files.put_text(spark, path, "2")
    assert files.read_text(spark, path) == "é1" and files.names(spark, path + "*") == ["note.json"]
