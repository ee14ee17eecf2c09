"""Writing facts, summaries and raw data; storage metrics and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from costalloc.operators.cleanse import HOUR
from costalloc.operators.correlate import STORED_ORDER
from costalloc.operators.summaries import device_summary, store_summary
from costalloc.session import DROP_SHUFFLES, set_for
from costalloc.sources.files import delete, folders, size_of
from costalloc.sources.runlog import Span, key_of, publish, withdraw
from costalloc.sources.store import FACT, FORMATS, PARTITIONS, WINDOWS, read_manifest, read_stored_fact


# How each format is packed, and the rows of one file of packed text, which readers cannot split.
PACKED = {"parquet": "zstd", "json": "gzip", "csv": "gzip"}
TEXT_ROWS = 1_000_000
# Text that is packed and read faster than gzip, and smaller. Spark's short name zstd needs libraries of the system, this codec
# has its own; Spark's readers know it by the name of a file.
ZSTD_TEXT = "org.apache.parquet.hadoop.codec.ZstandardCodec"
# A packed run has few bytes for its many rows: dealt by bytes as usual, it would be written and read by a task or two per core, of
# which the last ones are waited for. So its row groups are small (4 MB as stored), a task reads one or two, and writes are dealt wider.
ROW_GROUP, READ_BYTES = str(1 << 22), "4m"
TASKS_PER_CORE = 4
# Days of one task that are written side by side, where rows come in order; beyond that they are sorted by day.
OPEN_DAYS = "64"
# JSON has what belongs to a line last: the rest repeats the row before, in one stretch. Readers go by names.
OF_LINE = ["AllocatedCost", "TotalCost", "CostType", "ModelFamily", "MeterName", "CostPerToken", "CostPerApiCall"]


def _run_id(as_of: dt.datetime) -> str:
    return f"{as_of:%H%M%S}"


def _folder(as_of: dt.datetime) -> dict[str, str]:
    """Where a run is stored."""
    return dict(zip(PARTITIONS, [f"{as_of:%Y}", f"{as_of:%m}", f"{as_of:%d}", _run_id(as_of)], strict=True))


def _observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Count a run's rows, and note its first and last window, while it is written."""
    seen = Observation()
    return rows.observe(
        seen,
        F.count("*").alias("Rows"),
        F.min("TimeWindow").alias("FirstWindow"),
        F.max("TimeWindow").alias("LastWindow"),
        F.coalesce(F.sum("AllocatedCost"), F.lit(0.0)).alias("AllocatedCost"),
    ), seen


def _entry(seen: dict, as_of: dt.datetime, span: Span | None, window_minutes: int) -> dict:
    """What the log says of a run. Without a span the run has all windows from its first to its last one whole."""
    first, last = seen["FirstWindow"], seen["LastWindow"]
    if span is None and first is not None:
        span = Span(first, last + dt.timedelta(minutes=window_minutes), last + dt.timedelta(minutes=window_minutes), window_minutes)
    return {
        "Date": as_of.date(), "Run": _run_id(as_of), "Rows": seen["Rows"], "FirstWindow": first, "LastWindow": last,
        "CoveredFrom": span and span.start, "CoveredTo": span and span.whole_to, "SeenTo": span and span.seen_to,
        "WindowMinutes": span.minutes if span else window_minutes,
    }


def write_fact(
    fact: DataFrame, base: str, as_of: dt.datetime, span: Span | None = None, window_minutes: int = HOUR, in_order: bool = False,
    text_codec: str | None = None,
) -> dict:
    """Store one run of the fact as Parquet, JSON and CSV under its processing date, and enter it in the log of runs.

    The fact is computed once, for Parquet, and counted on the way; the other formats copy that run, packed. Writing the same run
    again takes it out of the log first and replaces it, so a retried job leaves no doubles and readers never see half of
    it. in_order: its rows come in STORED_ORDER, as of correlated_fact in order or of a store by window, and are not sorted again;
    they are all of the day of `as_of`. text_codec: how JSON and CSV are packed (default: gzip, for any reader). Returns what was
    counted: Rows, AllocatedCost, FirstWindow, LastWindow.
    """
    spark = fact.sparkSession
    day = F.lit(as_of.date()) if in_order else F.col("ProcessingDate")
    counted, observation = _observed(fact)
    rows = counted.withColumns(
        {
            "Year": F.date_format(day, "yyyy"),
            "Month": F.date_format(day, "MM"),
            "Day": F.date_format(day, "dd"),
            "Run": F.lit(_run_id(as_of)),
        }
    )

    wide = str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    while_writing = {
        DROP_SHUFFLES: "true",
        "spark.sql.adaptive.coalescePartitions.minPartitionNum": wide,
        "spark.sql.files.maxPartitionBytes": READ_BYTES,
    }

    def save(part: DataFrame, file_format: str) -> None:
        if file_format == "json":
            part = part.select(*part.drop(*OF_LINE).columns, *OF_LINE)
        writer = part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        if file_format == "parquet":
            writer = writer.option("compression", PACKED[file_format]).option("parquet.block.size", ROW_GROUP)
        else:
            writer = writer.option("compression", text_codec or PACKED[file_format]).option("maxRecordsPerFile", TEXT_ROWS)
        if file_format == "csv":
            writer = writer.option("header", True)
        with set_for(spark, while_writing):
            writer.partitionBy(*PARTITIONS).format(file_format).save(f"{base}/{file_format}")

    withdraw(spark, base, as_of, FACT)
    save(rows if in_order else rows.sortWithinPartitions(*PARTITIONS, *STORED_ORDER), "parquet")
    seen = observation.get
    stored = read_stored_fact(spark, base)
    for name, value in _folder(as_of).items():
        stored = stored.where(F.col(name) == value)
    # the folder as literals: rows that all go to one folder are not sorted by it
    copied = stored.withColumns({name: F.lit(value) for name, value in _folder(as_of).items()})
    for file_format in FORMATS[1:]:
        save(copied, file_format)
    entries = []
    for file_format in FORMATS:
        folder = "/".join(f"{name}={value}" for name, value in _folder(as_of).items())
        n_files, n_bytes = size_of(spark, f"{base}/{file_format}/{folder}")
        entries.append({**_entry(seen, as_of, span, window_minutes), "Format": file_format, "Files": n_files, "Bytes": n_bytes})
    publish(spark, base, as_of, FACT, entries)
    return seen


def write_by_window(
    fact: DataFrame, base: str, as_of: dt.datetime, span: Span | None = None, window_minutes: int = HOUR, dealt: bool = False,
    in_order: bool = False,
) -> dict:
    """Store one run of the fact under the days of its windows, for reports that ask for a range of time.

    Rows are dealt by day, and a day that is large for one task goes to several by its measured size (the rebalance hint),
    so small days are one file and large ones as many as they need. dealt: they come so already, as of correlated_fact by
    day or of a store by day, and are not shuffled again. in_order: each task's rows come in STORED_ORDER and are not sorted
    again. The same run again replaces itself; the log has it last.
    """
    spark = fact.sparkSession
    counted, observation = _observed(fact)
    dated = counted.withColumns({"WindowDate": F.to_date("TimeWindow"), "RunStamp": F.lit(key_of(as_of))})
    withdraw(spark, base, as_of, WINDOWS)
    rows = dated if dealt else dated.hint("rebalance", "WindowDate")
    if not in_order:
        rows = rows.sortWithinPartitions("WindowDate", "RunStamp", *STORED_ORDER)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", PACKED["parquet"])
    writer = writer.option("parquet.block.size", ROW_GROUP)
    with set_for(spark, {DROP_SHUFFLES: "true"} | ({"spark.sql.maxConcurrentOutputFileWriters": OPEN_DAYS} if in_order else {})):
        writer.partitionBy("WindowDate", "RunStamp").parquet(f"{base}/windows")
    seen = observation.get
    n_files, n_bytes = size_of(spark, f"{base}/windows/WindowDate=*/RunStamp={key_of(as_of)}")
    entry = _entry(seen, as_of, span, window_minutes)
    publish(spark, base, as_of, WINDOWS, [{**entry, "Format": "parquet", "Files": n_files, "Bytes": n_bytes}])
    return seen


def write_summaries(fact: DataFrame, base: str, as_of: dt.datetime) -> None:
    """Device and store summary of a run."""
    stamp = f"{as_of:%Y-%m-%d-%H%M%S}"
    for kind, table in (("device", device_summary(fact)), ("store", store_summary(fact))):
        dated = table.withColumn("ProcessingDate", F.lit(f"{as_of:%Y-%m-%d}"))
        dated.write.mode("overwrite").parquet(f"{base}/summaries/{kind}-summary-{stamp}")


def write_raw(telemetry: DataFrame, cost: DataFrame, base: str, as_of: dt.datetime) -> None:
    """Raw input of a run as JSON lines."""
    stamp = f"{as_of:%Y-%m-%d_%H%M%S}"
    telemetry.write.mode("overwrite").json(f"{base}/raw/telemetry/RunStamp={stamp}")
    cost.write.mode("overwrite").json(f"{base}/raw/cost/RunStamp={stamp}")


def storage_metrics(spark: SparkSession, base: str, as_of: dt.datetime, retention_days: int = 90) -> DataFrame:
    """Per stored table, and in total: days, runs, rows, files, bytes and expired days. From the log; no file is listed."""
    expired = F.when(F.col("Date") < _limit(as_of, retention_days), F.col("Date"))
    return (
        read_manifest(spark, base)
        .groupingSets([[F.col("Format")], []], "Format")
        .agg(
            F.countDistinct("Date").alias("Days"),
            F.count("*").alias("Runs"),
            F.sum("Rows").alias("Rows"),
            F.sum("Files").alias("Files"),
            F.sum("Bytes").alias("Bytes"),
            F.round(F.sum("Bytes") / (1 << 20), 2).alias("MegaBytes"),
            F.countDistinct(expired).alias("ExpiredDays"),
        )
        .withColumn("TableName", F.coalesce("Format", F.lit("total")))
        .drop("Format")
    )


def _limit(as_of: dt.datetime, retention_days: int) -> Column:
    return F.lit((as_of - dt.timedelta(days=retention_days)).date())


def retention_report(spark: SparkSession, base: str, as_of: dt.datetime, retention_days: int = 90) -> DataFrame:
    """Runs, rows, files and bytes per table and day that are older than the retention."""
    expired = read_manifest(spark, base).where(F.col("Date") < _limit(as_of, retention_days))
    return expired.groupBy(F.col("Format").alias("TableName"), "Date").agg(
        F.count("*").alias("RunsToDelete"),
        F.sum("Rows").alias("RowsToFree"),
        F.sum("Files").alias("FilesToDelete"),
        F.sum("Bytes").alias("BytesToFree"),
    )


def delete_expired_partitions(
    spark: SparkSession, base: str, as_of: dt.datetime, retention_days: int = 90, really: bool = False
) -> list[str]:
    """Folders of expired days; removed only if `really` is set."""
    limit = (as_of - dt.timedelta(days=retention_days)).date()
    expired, stamps = [], set()
    for file_format in FORMATS:
        for path in folders(spark, f"{base}/{file_format}/Year=*/Month=*/Day=*"):
            day = dt.date(*[int(part.split("=")[1]) for part in path.split("/")[-3:]])
            if day < limit:
                expired.append(path)
                stamps.add(f"{day:%Y%m%d}")
    if really:
        # out of the log first: readers must not look for what is gone
        for stamp in stamps:
            for entry in folders(spark, f"{base}/manifest/Kind={FACT}/Stamp={stamp}*"):
                delete(spark, entry)
        for path in expired:
            delete(spark, path)
    return expired
