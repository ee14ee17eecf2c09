"""Stored results, sinks, the scheduled run, and streams against batch."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from costalloc.operators import dedup, sinks
from costalloc.plans import catalog
from costalloc.plans.fact import correlated_fact, windowed_usage
from costalloc.plans.run import run_once
from costalloc.schemas import EVENTS_TABLE
from costalloc.session import run_dir, shared_dir
from costalloc.sources import billing, events, files, logs, store, testtables as tt
from costalloc.streaming import ingest, late_cost, usage
from tests.helpers import bills, calls

AS_OF = dt.datetime(2024, 1, 31, 6, 30)


def _fact(spark, small, as_of=AS_OF):
    return correlated_fact(tt.telemetry(spark, small), tt.billing(spark, small), as_of)


def test_shared_folder_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_runs_replace_themselves_and_the_newest_wins(spark, small):
    base = run_dir(spark, "t")
    fact = _fact(spark, small)
    n = fact.count()
    sinks.write_fact(fact, base, AS_OF)
    sinks.write_fact(fact, base, AS_OF)
    later = AS_OF + dt.timedelta(hours=1)
    again = _fact(spark, small, later).where("TimeWindow >= TIMESTAMP '2024-01-20'")
    sinks.write_fact(again.withColumn("AllocatedCost", F.lit(1.0)), base, later)
    m = again.count()
    for file_format in store.FORMATS:
        assert store.read_stored_fact(spark, base, file_format).count() == n + m
        newest = store.read_partition(spark, base, AS_OF.date(), file_format)
        assert newest.count() == m
        assert newest.schema.simpleString() == fact.schema.simpleString()
    # overlapping runs: the newer one counts where both have a window
    combined = store.combine_files(spark, base)
    assert combined.count() == n
    assert combined.where("TimeWindow >= TIMESTAMP '2024-01-20' AND AllocatedCost = 1.0").count() == m
    assert [r.Partition for r in store.list_partitions(spark, base).collect()] == ["2024/01/31"]
    assert store.list_partitions(spark, base, start=dt.date(2024, 2, 1)).count() == 0
    assert store.list_partitions(spark, base, end=dt.date(2024, 1, 31)).count() == 1


def test_formats_hold_the_same_values(spark, small):
    base = run_dir(spark, "t")
    fact = _fact(spark, small)
    sinks.write_fact(fact, base, AS_OF)
    want = sorted(map(str, fact.collect()))
    for file_format in store.FORMATS:
        assert sorted(map(str, store.read_partition(spark, base, AS_OF.date(), file_format).collect())) == want


def test_like_rows_are_stored_side_by_side(spark):
    base = run_dir(spark, "t")
    # devices in mixed order, few different numbers of tokens: equal parts of a line must not lie apart in the files
    usage = [(f"10:00:{i:02d}", f"d{i * 37 % 60:02d}", f"s{i % 4}", 10 * (1 + i % 3)) for i in range(60)]
    told = calls(spark, usage), bills(spark, [("10:05:00", meter, 60.0) for meter in ("GPT-4o Input Tokens", "PTU Provisioned")])
    rows = correlated_fact(*[table.repartition(3) for table in told], AS_OF).coalesce(1)
    sinks.write_fact(rows, base, AS_OF)
    sinks.write_by_window(rows, base, AS_OF)
    for file_format, place in [(f, f) for f in store.FORMATS] + [("parquet", "windows")]:
        stored = spark.read.option("header", True).format(file_format).load(f"{base}/{place}")
        kept = [(int(r.TokensUsed), r.StoreNumber, r.DeviceId, r.MeterName) for r in stored.collect()]
        assert len(kept) == 120 and kept == sorted(kept)


def test_runs_are_stored_packed(spark, small, monkeypatch):
    base = run_dir(spark, "t")
    fact = _fact(spark, small)
    n = fact.count()
    monkeypatch.setattr(sinks, "TEXT_ROWS", n // 3)
    sinks.write_fact(fact, base, AS_OF)
    for file_format in ("json", "csv"):
        kept = files.names(spark, f"{base}/{file_format}/Year=2024/Month=01/Day=31/Run=063000/part-*")
        assert len(kept) >= 3 and all(name.endswith(f".{file_format}.gz") for name in kept)
        assert store.read_partition(spark, base, AS_OF.date(), file_format).count() == n
    said = {r.TableName: r for r in sinks.storage_metrics(spark, base, AS_OF).collect()}
    plain = sum(len(text) + 1 for text in fact.toJSON().collect())
    assert said["json"].Bytes < plain / 4 and said["csv"].Bytes < plain / 4


def test_metrics_and_retention(spark, small):
    base = run_dir(spark, "t")
    sinks.write_fact(_fact(spark, small), base, AS_OF)
    metrics = {r.TableName: r for r in sinks.storage_metrics(spark, base, AS_OF).collect()}
    assert set(metrics) == {*store.FORMATS, "total"}
    assert metrics["total"].Rows == sum(metrics[f].Rows for f in store.FORMATS) > 0
    later = AS_OF + dt.timedelta(days=91)
    assert sinks.retention_report(spark, base, later).count() == 3
    assert sinks.retention_report(spark, base, AS_OF + dt.timedelta(days=90)).count() == 0
    assert len(sinks.delete_expired_partitions(spark, base, later)) == 3
    assert store.list_partitions(spark, base).count() == 1
    sinks.delete_expired_partitions(spark, base, later, really=True)
    assert not sinks.delete_expired_partitions(spark, base, later)


def test_run_is_repeatable(spark, small):
    base = run_dir(spark, "t")
    args = (spark, tt.telemetry(spark, small), tt.billing(spark, small), AS_OF, base)
    first = run_once(*args, lookback_hours=240).collect()
    assert run_once(*args, lookback_hours=240).collect() == first
    assert first[0].records == store.read_partition(spark, base, AS_OF.date()).count() > 0
    assert store.read_summaries(spark, base, "device").agg(F.sum("RecordCount")).first()[0] == first[0].records


def test_export_as_one_array(spark, tmp_path):
    rows = [{"PreTaxCost": 7.155e-05, "UsageQuantity": 0.477, "UsageDate": 20251018 + i, "ResourceId": "/subscriptions/s/x",
             "ResourceType": "t", "ServiceName": "Cognitive Services", "Meter": "gpt-4o-mini-0718-Inp-glbl Tokens",
             "Currency": "USD"} for i in range(3)]
    path = tmp_path / "export.json"
    path.write_text(json.dumps(rows, indent=2))
    read = billing.read_cost_json(spark, str(path), one_array=True)
    assert read.count() == 3
    assert billing.normalize_cost(read).orderBy("UsageDate").first().UsageDate == dt.datetime(2025, 10, 18)


@pytest.mark.parametrize("body, kept", [
    ('{"eventType":"FinOpsApiCall","tokensUsed":5}', True), ('{"eventType":"FinOpsApiError"}', True),
    ('{"eventType":"FinOpsApiCall","tokensUsed":"many","extra":{"a":[1]}}', True), ('{"eventType":"Other"}', False),
    ('{"eventType":"FinOpsApiCall","tok', False), ('[{"eventType":"FinOpsApiCall"}]', False), ("{}", False),
    ("null", False), ("", False), ("7", False), (None, False)])
def test_event_bodies(spark, body, kept):
    raw = spark.createDataFrame([(body,)], "value string")
    good, bad = events.split_events(raw)
    assert (good.count(), bad.count()) == ((1, 0) if kept else (0, 1))


def test_bad_status_does_not_lose_other_rows(spark):
    lines = [('{"message":"FinOpsApiCall","customDimensions":{"status_code":"%s","device_id":"d"}}' % s,) for s in ("200", "x", "0")]
    traces = spark.createDataFrame(lines, "Message string").withColumn("TimeGenerated", F.lit("2024-01-30 23:00:00").cast("timestamp"))
    assert [r.StatusCode for r in logs.read_traces(traces, "2024-01-31 00:00:00", 24).collect()] == [200]


def _event_stream(spark, small):
    return spark.readStream.schema(EVENTS_TABLE).parquet(f"{small}/[e]vents.parquet")


def test_stream_windows_equal_batch_windows_whatever_is_late(spark, small):
    """Batches in any order of time, one of them delivered twice: open windows and late rows are all there."""
    path = run_dir(spark, "t")
    rows = tt.telemetry(spark, small)
    rows.repartition(5, "RequestId").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    usage.start_stream_usage(stream, f"{path}/o", f"{path}/c").awaitTermination()
    partial = usage.partial_usage(rows.where("RequestId IS NULL"))
    assert partial.count() == 0
    batch = windowed_usage(rows).withColumn("AvgResponseTime", F.round("AvgResponseTime", 6))
    got = usage.read_stream_usage(spark, f"{path}/o").withColumn("AvgResponseTime", F.round("AvgResponseTime", 6))
    got = got.select(batch.columns)
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_gateway_wins_in_the_stream(spark, small):
    """The request log arrives first; the gateway's copies come in later batches."""
    path = run_dir(spark, "t")
    union = dedup.union_telemetry(*tt.telemetry_sources(spark, small))
    union.where("Source = 'ApplicationInsights'").coalesce(1).write.parquet(f"{path}/in")
    union.where("Source = 'APIM'").coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(union.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    usage.start_stream_dedup(stream, f"{path}/o", f"{path}/c").awaitTermination()
    got = usage.read_stream_dedup(spark, f"{path}/o")
    want = dedup.dedup_telemetry(union)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_router_restarts_without_doubles(spark, small):
    path = run_dir(spark, "t")
    bodies = tt.raw_event_bodies(_event_stream(spark, small)).select("value")
    for _ in range(2):
        ingest.start_route_errors(bodies, f"{path}/o", f"{path}/c").awaitTermination()
    # the same batch once more, with its progress lost
    ingest.start_route_errors(bodies, f"{path}/o", f"{path}/c2").awaitTermination()
    counts = ingest.batch_counts(spark, f"{path}/o").collect()
    assert [(r.batch_size, r.processed_count, r.error_count) for r in counts] == [(1000, 940, 60)]


def test_first_source_wins(spark, small):
    union = dedup.union_telemetry(*tt.telemetry_sources(spark, small))
    kept = dedup.dedup_telemetry(union)
    assert kept.count() == 1000 and kept.columns == union.columns
    twice = dedup.duplicate_check(union).join(kept, dedup.IDENTITY)
    assert {r.Source for r in twice.select("Source").distinct().collect()} == {"APIM"}


def test_late_cost_arrives_in_pieces(spark, small):
    path = run_dir(spark, "t")
    late_cost.write_usage(windowed_usage(tt.telemetry(spark, small)), f"{path}/usage")
    # meters of the same windows in different batches
    tt.billing(spark, small).repartition(3, "cost_seq").write.parquet(f"{path}/billing")
    stream = spark.readStream.schema(tt.billing(spark, small).schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/billing")
    late_cost.start_late_cost(
        stream, f"{path}/usage", f"{path}/cost", f"{path}/fact", f"{path}/c").awaitTermination()
    key = ["TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", F.round("AllocatedCost", 9)]
    got = late_cost.read_late_fact(spark, f"{path}/fact", AS_OF).select(key)
    assert sorted(got.collect()) == sorted(_fact(spark, small).select(key).collect())


def test_redelivered_and_restated_cost(spark, small):
    """The same bills twice, then one meter restated: only the newest amounts count."""
    path = run_dir(spark, "t")
    late_cost.write_usage(windowed_usage(tt.telemetry(spark, small)), f"{path}/usage")
    bills = tt.billing(spark, small)
    restated = bills.withColumn("PreTaxCost", F.when(F.col("cost_seq") == 1, 0.0).otherwise(F.col("PreTaxCost")))
    for rows in (bills, bills, restated):
        rows.coalesce(1).write.mode("append").parquet(f"{path}/billing")
    stream = spark.readStream.schema(bills.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/billing")
    late_cost.start_late_cost(
        stream, f"{path}/usage", f"{path}/cost", f"{path}/fact", f"{path}/c").awaitTermination()
    key = ["TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", F.round("AllocatedCost", 9)]
    got = late_cost.read_late_fact(spark, f"{path}/fact", AS_OF).select(key)
    want = correlated_fact(tt.telemetry(spark, small), restated, AS_OF).select(key)
    assert sorted(got.collect()) == sorted(want.collect())


def _deliver(spark, path, schema, *parts):
    """Each part as one file; the stream takes what is new."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{path}/billing")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/billing")
    late_cost.start_late_cost(stream, f"{path}/usage", f"{path}/cost", f"{path}/fact", f"{path}/c").awaitTermination()
    return {r.Batch: r for r in late_cost.batch_notes(spark, f"{path}/fact").collect()}


def test_a_batch_costs_what_its_changed_lines_touch(spark, small):
    """Rows read per batch: those of the windows whose lines changed, after any number of batches and a restart."""
    path = run_dir(spark, "t")
    cells, bills = windowed_usage(tt.telemetry(spark, small)), tt.billing(spark, small)
    late_cost.write_usage(cells, f"{path}/usage")
    paid = billing.model_services(bills)
    two = bills.where("UsageDate < TIMESTAMP '2024-01-01 02:00:00'")
    dearer = two.withColumn("PreTaxCost", F.col("PreTaxCost") * 2)
    notes = _deliver(spark, path, bills.schema, bills, bills, dearer)
    notes = _deliver(spark, path, bills.schema, dearer, two)
    touched = paid.where("UsageDate < TIMESTAMP '2024-01-01 02:00:00'")
    near = cells.where("TimeWindow < TIMESTAMP '2024-01-01 02:00:00'").count()
    windows = touched.select("UsageDate").distinct().count()
    assert notes[0].LinesChanged == paid.count() and notes[0].UsageRowsRead > 10 * near > 0
    for batch, (lines, n, rows) in {1: (0, 0, 0), 2: (touched.count(), windows, near), 3: (0, 0, 0), 4: (touched.count(), windows, near)}.items():
        assert (notes[batch].LinesChanged, notes[batch].Windows) == (lines, n) and notes[batch].UsageRowsRead <= rows
    key = ["TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", F.round("AllocatedCost", 9), F.round("TotalCost", 9)]
    got = late_cost.read_late_fact(spark, f"{path}/fact", AS_OF).select(key)
    assert sorted(got.collect()) == sorted(_fact(spark, small).select(key).collect())


def test_late_cost_filters_folders_whatever_the_join(spark, small):
    path = run_dir(spark, "t")
    late_cost.write_usage(windowed_usage(tt.telemetry(spark, small)), f"{path}/usage")
    windows = [dt.datetime(2024, 1, 3, 4), dt.datetime(2024, 1, 5, 6)]
    rows = spark.read.parquet(f"{path}/usage").where(late_cost.of_windows(windows, hours=True))
    assert {r.TimeWindow for r in rows.select("TimeWindow").distinct().collect()} <= set(windows) and rows.count() > 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "WindowHour" in plan.split("PartitionFilters")[1]
    assert spark.read.parquet(f"{path}/usage").where(late_cost.of_windows([], hours=True)).count() == 0


def test_late_cost_over_many_batches_and_relabelled_lines(spark, small):
    """Enough batches to be merged; a line whose resource group changes moves to the new one."""
    path = run_dir(spark, "t")
    bills = tt.billing(spark, small).where("UsageDate < TIMESTAMP '2024-01-04'")
    late_cost.write_usage(windowed_usage(tt.telemetry(spark, small)), f"{path}/usage")
    moved = bills.withColumn("ResourceId", F.regexp_replace("ResourceId", "rg-1", "rg-2"))
    parts = [bills.where(F.pmod(F.xxhash64("UsageDate"), F.lit(9)) == k) for k in range(9)]
    _deliver(spark, path, bills.schema, *parts, moved)
    got = late_cost.read_late_fact(spark, f"{path}/fact", AS_OF)
    want = correlated_fact(tt.telemetry(spark, small), moved, AS_OF)
    key = ["TimeWindow", "ResourceId", "ResourceGroup", "MeterName", "DeviceId", "StoreNumber", F.round("AllocatedCost", 9)]
    assert sorted(got.select(key).collect()) == sorted(want.select(key).collect())
    assert len(late_cost.change_store(spark, f"{path}/fact").live()) < 10
    day = late_cost.read_late_fact(spark, f"{path}/fact", AS_OF, "2024-01-02", "2024-01-03")
    assert day.count() == want.where("to_date(TimeWindow) = DATE '2024-01-02'").count() > 0


def test_a_past_run_does_not_see_later_rows(spark, small):
    moment = dt.datetime(2024, 1, 20, 6)
    calls, bills = tt.telemetry(spark, small), tt.billing(spark, small)
    whole = run_once(spark, calls, bills, moment, run_dir(spark, "t"), lookback_hours=48).collect()
    known = calls.where(F.col("TimeGenerated") < F.lit(moment)), bills.where(F.col("UsageDate") < F.lit(moment))
    assert run_once(spark, *known, moment, run_dir(spark, "t"), lookback_hours=48).collect() == whole
    assert whole[0].records > 0


def test_run_and_flagship_split_the_same_cost(spark, small):
    base = run_dir(spark, "t")
    run_once(spark, tt.telemetry(spark, small), tt.billing(spark, small), AS_OF, base, lookback_hours=24 * 60)
    stored = store.read_partition(spark, base, AS_OF.date())
    assert sorted(map(str, stored.collect())) == sorted(map(str, _fact(spark, small).collect()))
    assert stored.where("MeterName LIKE 'text-embedding%'").count() == 0


def test_rows_are_dealt_by_day_before_they_are_wide(spark, small):
    telemetry, bills = tt.telemetry(spark, small), tt.billing(spark, small)
    dealt = correlated_fact(telemetry, bills, AS_OF, by_day=True)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("RebalancePartitions"):]
    assert "CostPerToken" in plan and "CostPerToken" not in moved and "TokenShare" not in moved
    want = sorted(map(str, _fact(spark, small).collect()))
    assert sorted(map(str, dealt.collect())) == want
    base = run_dir(spark, "t")
    assert sinks.write_by_window(dealt, base, AS_OF, dealt=True)["Rows"] == len(want)
    assert sorted(map(str, store.read_windows(spark, base).collect())) == want


def test_one_run_is_read_whole(spark, small):
    base, fact = run_dir(spark, "t"), _fact(spark, small)
    sinks.write_by_window(fact, base, AS_OF)
    later = AS_OF + dt.timedelta(hours=1)
    sinks.write_by_window(fact.where("TimeWindow >= TIMESTAMP '2024-01-20'"), base, later)
    first = store.read_run(spark, base, AS_OF)
    assert sorted(map(str, first.collect())) == sorted(map(str, fact.collect()))
    assert 0 < store.read_run(spark, base, later).count() < first.count()


def test_parts_of_a_stream_are_batches_of_several_files(spark):
    path = run_dir(spark, "t")
    parts = [spark.range(first, first + n, numPartitions=3).withColumn("part", F.lit(first)) for first, n in ((0, 40), (100, 70), (200, 35))]
    stream = catalog._in_pieces(spark, path, *parts, least=10)
    assert len(files.names(spark, f"{path}/part-*")) == 9
    told = []
    stream.writeStream.foreachBatch(
        lambda batch, _: told.append(sorted(tuple(r) for r in batch.groupBy("part").count().collect()))
    ).option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start().awaitTermination()
    assert told == [[(0, 40)], [(100, 70)], [(200, 35)]]
