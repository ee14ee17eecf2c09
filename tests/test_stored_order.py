"""Runs stored in order: the same rows, sorted before they are many, and no shuffle kept after a write."""

import json
import os

import pytest

from costalloc.operators import sinks
from costalloc.operators.correlate import STORED_ORDER
from costalloc.plans.fact import correlated_fact
from costalloc.session import run_dir
from costalloc.sources import store
from tests.helpers import bills, calls
from tests.test_stores_and_streams import AS_OF


def _tables(spark):
    usage = [(f"{10 + i % 3}:00:{i:02d}", f"d{i * 37 % 60:02d}", f"s{i % 4}", 10 * (1 + i % 3)) for i in range(60)]
    usage += usage[:7]
    lines = [(f"{10 + i}:05:00", meter, cost) for i in range(3) for meter, cost in (("PTU Provisioned", 60.0), ("GPT-4o Input Tokens", 9.0))]
    return calls(spark, usage), bills(spark, [*lines, lines[0]])


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for folder in folders for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("mode", ["conserving", "reference"])
def test_fact_in_order_has_the_same_rows(spark, mode):
    plain = correlated_fact(*_tables(spark), AS_OF, mode=mode)
    fact = correlated_fact(*_tables(spark), AS_OF, mode=mode, in_order=True)
    assert fact.schema == plain.schema
    assert sorted(map(str, fact.collect())) == sorted(map(str, plain.collect())) != []
    for part in fact.select(STORED_ORDER).rdd.glom().collect():
        assert [tuple(r) for r in part] == sorted(tuple(r) for r in part)
    # what is sorted is a cell, not each of its lines
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(_lines") < plan.index("Sort [TimeWindow")


def test_write_keeps_no_shuffle_and_the_order(spark):
    base, before = run_dir(spark, "t"), _shuffle_files(spark)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    fact = correlated_fact(*_tables(spark), AS_OF, in_order=True)
    sinks.write_fact(fact, base, AS_OF, in_order=True)
    sinks.write_by_window(fact, base, AS_OF)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    # of a line last, so that rows of a cell begin alike
    text = spark.read.text(f"{base}/json").first().value
    assert [name for name in json.loads(text)][-len(sinks.OF_LINE):] == sinks.OF_LINE
    want = sorted(map(str, fact.collect()))
    for file_format in store.FORMATS:
        rows = store.read_partition(spark, base, AS_OF.date(), file_format)
        assert sorted(map(str, rows.collect())) == want
        for part in rows.select(STORED_ORDER).rdd.glom().collect():
            cells = [(r.TimeWindow, r.ResourceId, r.DeviceId, r.MeterName) for r in part]
            # a cell's lines lie together, by meter
            assert all(a[3] < b[3] for a, b in zip(cells, cells[1:]) if a[:3] == b[:3])
            assert len({c[:3] for c in cells}) == sum(a[:3] != b[:3] for a, b in zip([(None,) * 4, *cells], cells))
