"""Runs stored in order and packed fast: the same rows, nothing sorted twice, nothing read that does not count."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from costalloc.operators import sinks
from costalloc.operators.correlate import STORED_ORDER
from costalloc.plans.fact import correlated_fact
from costalloc.session import run_dir
from costalloc.sources import store
from tests.helpers import bills, calls
from tests.test_stored_order import _tables
from tests.test_stores_and_streams import AS_OF

LATER = AS_OF + dt.timedelta(minutes=6)


def _rows(frame):
    return sorted(map(str, frame.collect()))


def _days(spark):
    """Calls and bills of five days."""
    usage = [(f"2024-01-{10 + i % 5}T{10 + i % 3}:00:{i:02d}Z", f"d{i * 37 % 60:02d}", f"s{i % 4}", 10 * (i % 3)) for i in range(60)]
    lines = [(f"2024-01-{10 + d}T{10 + h}:05:00Z", meter, cost) for d in range(5) for h in range(3)
             for meter, cost in (("PTU Provisioned", 60.0), ("GPT-4o Input Tokens", 9.0))]
    return calls(spark, usage), bills(spark, lines)


def test_text_packed_with_zstd_is_the_same_run(spark):
    base = run_dir(spark, "t")
    fact = correlated_fact(*_tables(spark), AS_OF, in_order=True)
    sinks.write_fact(fact, base, AS_OF, in_order=True, text_codec=sinks.ZSTD_TEXT)
    want = _rows(fact)
    for file_format in store.FORMATS:
        assert _rows(store.read_partition(spark, base, AS_OF.date(), file_format)) == want != []
        names = glob.glob(f"{base}/{file_format}/*/*/*/*/part-*")
        assert names and all(name.endswith((".parquet", f".{file_format}.zstd")) for name in names)
    found = {r.TableName: r for r in sinks.storage_metrics(spark, base, AS_OF).collect()}
    assert {name: r.Rows for name, r in found.items()} == {**dict.fromkeys(store.FORMATS, len(want)), "total": 3 * len(want)}
    assert all(r.Bytes > 0 and r.Files > 0 for r in found.values())


def test_a_run_that_owns_nothing_is_not_read(spark):
    base = run_dir(spark, "t")
    fact = correlated_fact(*_tables(spark), AS_OF, in_order=True)
    for moment in (AS_OF, LATER):
        sinks.write_fact(fact, base, moment, in_order=True)
    for name in glob.glob(f"{base}/parquet/*/*/*/Run={AS_OF:%H%M%S}/part-*"):
        os.remove(os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc"))
        with open(name, "wb") as out:
            out.write(b"not a table")
    assert _rows(store.combine_files(spark, base, ["DeviceId", "AllocatedCost"])) == _rows(fact.select("DeviceId", "AllocatedCost"))


def test_a_later_run_of_what_the_first_has_stored(spark):
    base = run_dir(spark, "t")
    fact = correlated_fact(*_days(spark), AS_OF, in_order=True)
    sinks.write_fact(fact, base, AS_OF, in_order=True, text_codec=sinks.ZSTD_TEXT)
    part = store.read_partition(spark, base, AS_OF.date()).where("TimeWindow >= TIMESTAMP '2024-01-12'")
    for minutes in (6, 12):
        sinks.write_fact(part, base, AS_OF + dt.timedelta(minutes=minutes), in_order=True, text_codec=sinks.ZSTD_TEXT)
    late = _rows(fact.where("TimeWindow >= TIMESTAMP '2024-01-12'"))
    assert 0 < len(late) < fact.count()
    for file_format in store.FORMATS:
        runs = store.read_stored_fact(spark, base, file_format).groupBy("Run").count().collect()
        assert sorted(r["count"] for r in runs) == [len(late), len(late), fact.count()]
        assert _rows(store.read_partition(spark, base, AS_OF.date(), file_format)) == late
    columns = ["DeviceId", "StoreNumber", "AllocatedCost", "TimeWindow"]
    assert _rows(store.combine_files(spark, base, columns)) == _rows(fact.select(columns))


def test_windows_in_order_are_not_sorted_again(spark, monkeypatch):
    monkeypatch.setattr(sinks, "ROW_GROUP", "2048")
    plain, base = run_dir(spark, "t"), run_dir(spark, "t")
    fact = correlated_fact(*_days(spark), AS_OF, by_day=True, in_order=True)
    settings = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(name) for name in settings]
    sinks.write_by_window(correlated_fact(*_days(spark), AS_OF, by_day=True), plain, AS_OF, dealt=True)
    seen = sinks.write_by_window(fact, base, AS_OF, dealt=True, in_order=True)
    assert [spark.conf.get(name) for name in settings] == before
    assert seen["Rows"] == fact.count() > 0
    assert _rows(store.read_windows(spark, base)) == _rows(store.read_windows(spark, plain)) == _rows(fact)
    for name in glob.glob(f"{base}/windows/*/*/part-*"):
        keys = [tuple(r.values()) for r in pq.read_table(name, columns=STORED_ORDER, partitioning=None).to_pylist()]
        assert keys == sorted(keys)
    # a day is one file, as far as it is small
    assert len(glob.glob(f"{base}/windows/*/*/part-*")) == fact.select(F.to_date("TimeWindow")).distinct().count() == 5
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(_lines") < plan.index("Sort [TimeWindow") < plan.index("RebalancePartitions")


def test_days_beyond_those_kept_open_are_written_too(spark, monkeypatch):
    monkeypatch.setattr(sinks, "OPEN_DAYS", "2")
    base = run_dir(spark, "t")
    fact = correlated_fact(*_days(spark), AS_OF, by_day=True, in_order=True)
    sinks.write_by_window(fact, base, AS_OF, dealt=True, in_order=True)
    assert _rows(store.read_windows(spark, base)) == _rows(fact)
