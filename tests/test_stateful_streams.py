"""Streams with state against batch: late rows, restarts, doubled delivery, bounded state; and the merging of batches."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from costalloc.operators import dedup
from costalloc.plans.fact import windowed_usage
from costalloc.session import run_dir
from costalloc.sources import files
from costalloc.sources import testtables as tt
from costalloc.streaming import segments, stateful, usage


def rounded(rows):
    columns = ["TimeWindow", "ResourceId", "DeviceId", "StoreNumber", "TokensUsed", "ApiCalls", F.round("AvgResponseTime", 6)]
    return sorted(map(str, rows.select(columns).collect()))


def batches(spark, path, *parts):
    """Each part arrives as one file, in this order."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{path}/in")
    schema = parts[0].schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


FLUSH = "2024-03-01 00:00:00"


def with_end(rows):
    """A row far ahead, which lets the watermark pass all others."""
    last = rows.limit(1).withColumn("TimeGenerated", F.lit(FLUSH).cast("timestamp"))
    return last


def test_closed_windows_with_late_rows_equal_the_batch(spark, small):
    path = run_dir(spark, "t")
    rows = tt.telemetry(spark, small)
    day = F.dayofmonth("TimeGenerated")
    late = F.xxhash64("RequestId") % 10 == 0
    parts = [rows.where((day <= 10) & ~late), rows.where((day > 10) & (day <= 20) & ~late), rows.where(late & (day <= 20)), rows.where(day > 20)]
    stream = batches(spark, path, *parts, with_end(rows))
    query = stateful.start_closed_usage(stream, f"{path}/o", f"{path}/c")
    query.awaitTermination()
    want = rounded(windowed_usage(rows))
    assert rounded(stateful.read_closed_usage(spark, f"{path}/o").where(F.col("TimeWindow") < F.lit(FLUSH))) == want
    n_late = rows.where(late & (day <= 20)).count()
    parts_late = stateful.read_late_parts(spark, f"{path}/o").agg(F.sum("ApiCalls")).first()[0]
    assert 0 < parts_late <= n_late  # some were in time: their window was still open
    # a window that is over was emitted once
    closed = stateful.closed_store(spark, f"{path}/o").read().where("Kind = 'closed'")
    assert closed.count() == closed.select(usage.GROUP).distinct().count()
    # all that is left of the state is the window of the last row
    left = [p for p in query.recentProgress if p["stateOperators"]][-1]["stateOperators"][0]["numRowsTotal"]
    assert left <= 4


def test_closed_windows_after_a_restart(spark, small):
    """The stream stops after two files; the rest arrives later, among it rows of days long emitted."""
    path = run_dir(spark, "t")
    rows = tt.telemetry(spark, small)
    late = F.xxhash64("RequestId") % 7 == 0
    day = F.dayofmonth("TimeGenerated")
    first = batches(spark, path, rows.where(~late & (day <= 15)), rows.where(~late & (day > 15)))
    stateful.start_closed_usage(first, f"{path}/o", f"{path}/c").awaitTermination()
    seen = stateful.read_closed_usage(spark, f"{path}/o").agg(F.sum("ApiCalls")).first()[0]
    assert 0 < seen < rows.where(~late).count()  # the last windows are still open
    again = batches(spark, path, rows.where(late), with_end(rows))
    stateful.start_closed_usage(again, f"{path}/o", f"{path}/c").awaitTermination()
    got = stateful.read_closed_usage(spark, f"{path}/o").where(F.col("TimeWindow") < F.lit(FLUSH))
    assert rounded(got) == rounded(windowed_usage(rows))


def test_state_is_bounded_by_the_open_windows(spark, small):
    """Thirty days in thirty batches: the state at any time holds no more buckets than the delay has windows."""
    path = run_dir(spark, "t")
    rows = tt.telemetry(spark, small)
    parts = [rows.where(F.dayofmonth("TimeGenerated") == d) for d in range(1, 13)]
    query = stateful.start_closed_usage(batches(spark, path, *parts), f"{path}/o", f"{path}/c", delay="1 hour")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    one_day = parts[0].count()
    assert len(held) >= 12 and max(held[1:]) <= 6 * one_day and held[-1] <= one_day


def test_a_full_bucket_is_merged(spark, small):
    path = run_dir(spark, "t")
    rows = tt.telemetry(spark, small)
    parts = [rows.where(F.pmod(F.xxhash64("RequestId"), F.lit(6)) == k) for k in range(6)]
    stream = batches(spark, path, *parts, with_end(rows))
    stateful.start_closed_usage(stream, f"{path}/o", f"{path}/c", delay="29 days", merge_at=3).awaitTermination()
    got = stateful.read_closed_usage(spark, f"{path}/o").where(F.col("TimeWindow") < F.lit(FLUSH))
    assert rounded(got) == rounded(windowed_usage(rows))


@pytest.mark.parametrize("first", ["ApplicationInsights", "APIM"])
def test_changes_equal_the_batch_in_either_order(spark, small, first):
    path = run_dir(spark, "t")
    union = dedup.union_telemetry(*tt.telemetry_sources(spark, small))
    columns = [f.name for f in stateful.TELEMETRY.fields]
    union = union.select(columns)
    stream = batches(spark, path, union.where(F.col("Source") == first), union.where(F.col("Source") != first), union.where("RequestId LIKE '%7'"))
    stateful.start_dedup_changes(stream, f"{path}/o", f"{path}/c", keep_hours=24 * 60).awaitTermination()
    want = dedup.dedup_telemetry(union)
    got = stateful.read_dedup_changes(spark, f"{path}/o")
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    # what came in less what went out is the result: nobody has to choose again
    changes = stateful.changes_store(spark, f"{path}/o").read()
    assert changes.where("Sign < 0").count() == 0 and changes.count() == want.count()
    raw = stateful.changes_store(spark, f"{path}/o")._read(stateful.changes_store(spark, f"{path}/o").live())
    twice = dedup.duplicate_check(union).count()
    assert raw.where("Sign < 0").count() == (twice if first == "ApplicationInsights" else 0)
    assert raw.where("Segment = 'b000000000002'").count() == 0  # a doubled delivery changes nothing
    # sums of usage are kept up from the changes of each batch alone
    sums = usage.finished(stateful.usage_of_changes(raw))
    assert rounded(sums) == rounded(windowed_usage(want))


def test_requests_are_forgotten_after_a_while(spark, small):
    path = run_dir(spark, "t")
    union = dedup.union_telemetry(*tt.telemetry_sources(spark, small)).select([f.name for f in stateful.TELEMETRY.fields])
    day = F.dayofmonth("TimeGenerated")
    parts = [union.where((day == d) & (F.col("Source") == "ApplicationInsights")) for d in range(1, 9)]
    stream = batches(spark, path, *parts, union.where((day <= 8) & (F.col("Source") == "APIM")))
    query = stateful.start_dedup_changes(stream, f"{path}/o", f"{path}/c", keep_hours=24, delay="1 hour")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 4 * max(p.count() for p in parts)
    want = dedup.dedup_telemetry(union.where(day <= 8))
    got = stateful.read_dedup_changes(spark, f"{path}/o")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


# Merging of batches -----------------------------------------------------------------------------------------------


def numbered(spark, n):
    day = F.expr("date_add(DATE '2024-01-01', CAST(id % 3 AS INT))")
    cell = [F.lit("r").alias("ResourceId"), F.concat(F.lit("d"), F.col("id") % 5).alias("DeviceId"), F.lit("s").alias("StoreNumber")]
    ones = [F.lit(1).cast("bigint").alias("TokensUsed"), F.lit(1).cast("bigint").alias("ApiCalls"), F.lit(1.0).alias("ResponseTimeSum"), F.lit(1).cast("bigint").alias("ResponseTimeCount")]
    return spark.range(n).select(day.cast("timestamp").alias("TimeWindow"), *cell, *ones, day.alias(segments.DAY_PARTITION))


def totals(store):
    return sorted(map(tuple, store.read().groupBy("DeviceId").agg(F.sum("ApiCalls").alias("n")).collect()))


def test_files_stay_few_over_two_hundred_batches(spark):
    store = segments.Segments(spark, run_dir(spark, "t"), usage.PARTIAL, usage.merge_partials)
    rows = numbered(spark, 15)
    most = 0
    for batch in range(200):
        store.write(rows, batch)
        store.keep_small()
        most = max(most, len(store.live()))
    assert most <= 3 * (segments.FANOUT - 1) + 1
    assert totals(store) == [(f"d{k}", 600) for k in range(5)]
    there = files.names(spark, f"{store.base}/data/Segment=*")
    assert len(there) <= 5 * segments.FANOUT and len(files.names(spark, f"{store.base}/versions/*")) <= segments.VERSIONS_KEPT
    pruned = store.read("2024-01-02", "2024-01-02 12:00:00")
    assert pruned.count() == 5
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(WindowDate" in plan


def test_a_merge_that_breaks_off_changes_nothing(spark, monkeypatch):
    store = segments.Segments(spark, run_dir(spark, "t"), usage.PARTIAL, usage.merge_partials, fanout=4)
    for batch in range(4):
        store.write(numbered(spark, 10), batch)
    before, live = totals(store), store.live()

    def broken(*args):
        raise OSError("the driver is gone")

    monkeypatch.setattr(segments.files, "put_text", broken)
    with pytest.raises(OSError):
        store.compact()
    monkeypatch.undo()
    assert store.live() == live and totals(store) == before  # what was written is in no version
    assert store.compact() == 1 and totals(store) == before and len(store.live()) == 1
    # a batch that is delivered again after it was merged is left out
    assert not store.write(numbered(spark, 10), 2) and totals(store) == before
    store.write(numbered(spark, 10), 4)
    store.write(numbered(spark, 10), 4)
    assert totals(store) == [(d, 5 * n // 4) for d, n in before]
    for batch in range(5, 30):
        store.write(numbered(spark, 10), batch)
        store.keep_small()
    assert totals(store) == [(d, 30 * n // 4) for d, n in before]
    orphans = [n for n in files.names(spark, f"{store.base}/data/Segment=m*") if n.split("=")[1] not in store.live()]
    assert len(orphans) <= 6  # those of versions that are kept for readers


def test_one_merged_folder_is_not_merged_again(spark):
    store = segments.Segments(spark, run_dir(spark, "t"), usage.PARTIAL, usage.merge_partials, fanout=4)
    for batch in range(4):
        store.write(numbered(spark, 10), batch)
    before, columns = totals(store), store.read().columns
    assert store.compact() == 1
    store.write(numbered(spark, 10).limit(0), 4)  # a batch that changed nothing
    assert len(store.live()) == 2 and totals(store) == before and store.read().columns == columns
    assert "Exchange" not in store.read()._jdf.queryExecution().executedPlan().toString()
    store.write(numbered(spark, 10), 5)
    assert totals(store) == [(d, 5 * n // 4) for d, n in before]


def test_readers_of_the_version_before_still_find_their_files(spark):
    store = segments.Segments(spark, run_dir(spark, "t"), usage.PARTIAL, usage.merge_partials, fanout=3)
    for batch in range(3):
        store.write(numbered(spark, 10), batch)
    reader = store.read()  # planned before the merge
    store.keep_small()
    assert sorted(map(str, reader.collect())) == sorted(map(str, store.read().collect()))


def test_doubled_and_reordered_batches(spark, small):
    """Rows of any time in any batch, one batch delivered twice under its number: a stream and its store against batch."""
    path = run_dir(spark, "t")
    rows = tt.telemetry(spark, small)
    kept = usage.usage_store(spark, f"{path}/o")
    for batch in range(20):
        part = usage.partial_usage(rows.where(F.pmod(F.xxhash64("RequestId"), F.lit(20)) == batch))
        for _ in range(2 if batch % 5 == 0 else 1):
            kept.write(part, batch)
        kept.keep_small()
    kept.write(usage.partial_usage(rows), 3)  # long merged
    assert rounded(usage.read_stream_usage(spark, f"{path}/o")) == rounded(windowed_usage(rows))
    a, b = dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 12)
    want = windowed_usage(rows).where((F.col("TimeWindow") >= F.lit(a)) & (F.col("TimeWindow") < F.lit(b)))
    assert rounded(usage.read_stream_usage(spark, f"{path}/o", a, b)) == rounded(want)


@pytest.mark.parametrize("processor", [stateful.ClosedWindows(60), stateful.BestCopies(1)], ids=["closed", "copies"])
def test_processors_need_nothing_of_this_package_where_they_run(processor, tmp_path):
    (tmp_path / "p").write_bytes(cloudpickle.dumps(processor))
    code = "import pickle, sys; pickle.load(open('p', 'rb')); assert not any(m.startswith('costalloc') for m in sys.modules)"
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=clean, check=True, timeout=100)
