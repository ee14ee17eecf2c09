"""Readers of stored results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costalloc.functions.timeparts import moment
from costalloc.schemas import CORRELATED_FACT
from costalloc.sources.runlog import key_of, owners, read_log

PARTITIONS = ["Year", "Month", "Day", "Run"]
STORED_FACT = T.StructType(
    [*CORRELATED_FACT.fields, *[T.StructField(p, T.StringType()) for p in PARTITIONS]]
)
FORMATS = ["parquet", "json", "csv"]
MANIFEST = ["Format", "Date", "Run", "Rows", "FirstWindow", "LastWindow", "Files", "Bytes"]
FACT, WINDOWS = "fact", "windows"  # the two layouts a run is stored in, with a log each

# The columns reports load.
REPORT_COLUMNS = [
    "DeviceId", "StoreNumber", "AllocatedCost", "TokensUsed", "ApiCalls", "TimeWindow",
    "ModelFamily", "CostType", "ShiftCategory", "IsBusinessHours",
]


def read_stored_fact(spark: SparkSession, base: str, file_format: str = "parquet") -> DataFrame:
    """All runs of all days; partition columns keep their leading zeros."""
    reader = spark.read.schema(STORED_FACT)
    if file_format == "csv":
        reader = reader.option("header", True)
    return reader.format(file_format).load(f"{base}/{file_format}")


def read_partition(spark: SparkSession, base: str, day: dt.date, file_format: str = "parquet") -> DataFrame:
    """The newest run of one day, by the manifest: no data file is opened to find it."""
    runs = read_manifest(spark, base).where((F.col("Format") == file_format) & (F.col("Date") == F.lit(day)))
    newest = runs.agg(F.max("Run")).first()[0]
    rows = read_stored_fact(spark, base, file_format).where(
        (F.col("Year") == f"{day:%Y}") & (F.col("Month") == f"{day:%m}") & (F.col("Day") == f"{day:%d}")
    )
    return rows.where(F.col("Run") == F.lit(newest)).drop(*PARTITIONS)


WINDOW_LAYOUT = T.StructType([
    *CORRELATED_FACT.fields, T.StructField("WindowDate", T.DateType()), T.StructField("RunStamp", T.StringType())
])


def read_run(spark: SparkSession, base: str, as_of: dt.datetime) -> DataFrame:
    """All rows that one run has stored by window, whichever run counts for them."""
    rows = spark.read.schema(WINDOW_LAYOUT).parquet(f"{base}/windows")
    return rows.where(F.col("RunStamp") == key_of(as_of)).select(CORRELATED_FACT.names)


def read_windows(spark: SparkSession, base: str, start=None, end=None) -> DataFrame:
    """The stored fact of a half-open range of time windows.

    Runs overlap: each window comes from the newest run that has it whole, by the log of runs. The join with these few
    owners also leaves out the folders of runs that own nothing in the range.
    """
    rows = spark.read.schema(WINDOW_LAYOUT).parquet(f"{base}/windows")
    if start is not None:
        rows = rows.where((F.col("WindowDate") >= F.to_date(moment(start))) & (F.col("TimeWindow") >= moment(start)))
    if end is not None:
        rows = rows.where((F.col("WindowDate") <= F.to_date(moment(end))) & (F.col("TimeWindow") < moment(end)))
    log = read_log(spark, base).where(F.col("Kind") == WINDOWS)
    owned = owners(log, start, end).select(F.to_date("TimeWindow").alias("WindowDate"), "TimeWindow", F.col("RunKey").alias("RunStamp"))
    kept = rows.join(owned, ["WindowDate", "RunStamp", "TimeWindow"], "left_semi")
    return kept.select(CORRELATED_FACT.names)


def combine_files(spark: SparkSession, base: str, columns: list[str] = REPORT_COLUMNS) -> DataFrame:
    """Chosen columns of all stored runs; runs overlap, so each window is that of the newest run that has it whole."""
    log = read_log(spark, base).where((F.col("Kind") == FACT) & (F.col("Format") == FORMATS[0]))
    # by the folders of the run, so that runs that own nothing are not read
    folder = [F.substring("RunKey", at, n).alias(name) for name, at, n in zip(PARTITIONS, (1, 5, 7, 9), (4, 2, 2, 6), strict=True)]
    owned = owners(log).select("TimeWindow", *folder)
    return read_stored_fact(spark, base).join(owned, ["TimeWindow", *PARTITIONS], "left_semi").select(columns)


def read_summaries(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """All stored summaries of one kind: 'device' or 'store'."""
    return spark.read.parquet(f"{base}/summaries/{kind}-summary-*")


def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    """One row per stored run and format: when, how many rows, files and bytes, and which windows."""
    return read_log(spark, base).where(F.col("Kind") == FACT).select(MANIFEST).distinct()


def list_partitions(
    spark: SparkSession, base: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Days with stored facts, between two dates (both included)."""
    days = read_manifest(spark, base).where(F.col("Format") == FORMATS[0]).select("Date")
    if start is not None:
        days = days.where(F.col("Date") >= F.lit(start))
    if end is not None:
        days = days.where(F.col("Date") <= F.lit(end))
    path = F.date_format("Date", "yyyy/MM/dd").alias("Partition")
    return days.distinct().select(path, "Date").orderBy("Date")
