"""Every operator as a named query over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costalloc.functions import scores
from costalloc.functions.ids import normalize_resource_id
from costalloc.operators import advanced, apportion, cleanse, correlate, daily_state, dedup, measures, quality, reports, sinks, summaries
from costalloc.operators.correlation_index import device_correlation_index
from costalloc.plans.fact import DECAY_HOURS as FACT_DECAY_HOURS
from costalloc.plans.fact import allocated_costs, correlated_fact, windowed_cost, windowed_usage
from costalloc.plans.run import run_once
from costalloc.schemas import EVENTS_TABLE
from costalloc.session import materialize, prepare, run_dir
from costalloc.sources.runlog import Span
from costalloc.sources import billing, events, files, logs, store, testtables
from costalloc.streaming import ingest, late_cost, stateful, usage

AS_OF = testtables.AS_OF
AS_OF_TIME = dt.datetime.fromisoformat(AS_OF)
# A moment inside the data: what comes after it must not matter.
INSIDE = "2024-01-24 12:00:00"
INSIDE_DAY, WEEK_BEFORE = "2024-01-24 00:00:00", "2024-01-17 00:00:00"
DAY_BEFORE = "2024-01-23 12:00:00"
WEEK_HOURS = 168
DECAY_HOURS = 72.0

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(make: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return at_edge(make(prepare(spark), sf_dir))

        QUERIES[name] = run
        return make

    return register


# Costs of one token, call or unit are small: they are compared to more places.
UNIT_COSTS = {"CostPerToken", "CostPerApiCall", "CostPerUnit", "avg_cost_per_token", "avg_cost_per_call"}


def at_edge(rows: DataFrame) -> DataFrame:
    """Plain comparable types: whole numbers as bigint, amounts rounded, times
    without zone, dates and lists as text. The nudge before rounding is above the
    noise of a sum and settles exact ties the same way in every engine."""
    columns = []
    for field in rows.schema.fields:
        c, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            nudge, places = ("3e-13D", 9) if field.name in UNIT_COSTS else ("3e-10D", 6)
            text = f"round(CAST({c} AS DOUBLE) + {nudge}, {places})"
        elif isinstance(kind, T.IntegralType):
            text = f"CAST({c} AS BIGINT)"
        elif isinstance(kind, T.TimestampType):
            text = f"CAST({c} AS TIMESTAMP_NTZ)"
        elif isinstance(kind, T.DateType):
            text = f"CAST({c} AS STRING)"
        elif isinstance(kind, T.ArrayType):
            text = f"array_join(CAST({c} AS ARRAY<STRING>), ',')"
        else:
            text = c
        columns.append(f"{text} AS {c}")
    return rows.selectExpr(*columns)


def _telemetry(spark: SparkSession, d: str) -> DataFrame:
    return testtables.telemetry(spark, d)


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return cleanse.preprocess_telemetry(_telemetry(spark, d))


def _billing(spark: SparkSession, d: str) -> DataFrame:
    return testtables.billing(spark, d)


def _cost(spark: SparkSession, d: str) -> DataFrame:
    return windowed_cost(_billing(spark, d))


def _usage(spark: SparkSession, d: str) -> DataFrame:
    return windowed_usage(_telemetry(spark, d))


def _fact(spark: SparkSession, d: str, **how) -> DataFrame:
    return correlated_fact(_telemetry(spark, d), _billing(spark, d), AS_OF, **how)


_reports: dict[tuple, str] = {}


def _stored_windows(spark: SparkSession, d: str) -> str:
    """Where the fact of a folder of tables is stored by window, written once per session and state of the tables' files."""
    state = [files.state_of(spark, f"{d.rstrip('/')}/{name}.parquet") for name in ("events", "lineitem")]
    key = (spark.sparkContext.applicationId, d, *state)
    if key not in _reports:
        base = run_dir(spark, "reports")
        sinks.write_by_window(_fact(spark, d, by_day=True, in_order=True), base, AS_OF_TIME, dealt=True, in_order=True)
        _reports[key] = base
    return _reports[key]


def store_report_fact(spark: SparkSession, d: str) -> None:
    """Write the fact that the reports read, unless it is there: what the first report of a session waits for."""
    _stored_windows(prepare(spark), d)


def on_report(name: str, operator: Callable[[DataFrame], DataFrame], start=None, end=None) -> None:
    """A report over the stored fact; a range of time reads only its days."""
    query(name)(lambda spark, d: operator(store.read_windows(spark, _stored_windows(spark, d), start, end)))


def _shipped(spark: SparkSession, d: str) -> DataFrame:
    return testtables.shipped_billing(spark, d)


def on_telemetry(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, d: operator(_clean(spark, d)))


def on_fact(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, d: operator(_fact(spark, d)))


_ROW = ["TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "AllocatedCost"]

# Sources ------------------------------------------------------------------


@query("src_events")
def _(spark, d):
    return events.envelope_numbers(events.parse_events(testtables.raw_events(spark, d))).select(
        "eventType", "timestamp", "correlationId", "deviceId", "storeNumber", "operationName", "statusCode",
        "tokensUsed", "promptTokens", "completionTokens", "model", "resourceRegion", "resourceId", "responseTime",
    )


@query("src_events_rejects")
def _(spark, d):
    rejects = events.split_events(testtables.raw_events(spark, d))[1]
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


@query("src_traces")
def _(spark, d):
    return logs.read_traces(testtables.traces(spark, d), INSIDE, WEEK_HOURS)


@query("src_gateway_logs")
def _(spark, d):
    return logs.read_gateway_logs(testtables.gateway_logs(spark, d), INSIDE, WEEK_HOURS)


@query("src_requests")
def _(spark, d):
    return logs.read_requests(testtables.request_rows(spark, d), INSIDE, WEEK_HOURS)


@query("src_cost_usage")
def _(spark, d):
    return billing.query_cost_usage(_billing(spark, d))


@query("src_cost_json")
def _(spark, d):
    path = run_dir(spark, "export")
    export = billing.query_cost_usage(_billing(spark, d)).withColumn(
        "UsageDate", F.date_format("UsageDate", "yyyyMMdd").cast("int")
    )
    export.write.json(path)
    return billing.read_cost_json(spark, path)


def _stored(spark: SparkSession, d: str) -> str:
    base = run_dir(spark, "store")
    sinks.write_fact(_fact(spark, d, in_order=True), base, AS_OF_TIME, in_order=True, text_codec=sinks.ZSTD_TEXT)
    return base


@query("read_partition")
def _(spark, d):
    return store.read_partition(spark, _stored(spark, d), AS_OF_TIME.date())


@query("combine_files")
def _(spark, d):
    """Three runs, of which the last ones see the latter half of the data again: nothing is counted twice."""
    base = _stored(spark, d)
    whole = store.read_partition(spark, base, AS_OF_TIME.date())  # the later runs see a part of what the first one has stored
    half = whole.where(F.col("TimeWindow") >= F.lit("2024-01-15").cast("timestamp"))
    for minutes in (6, 12):
        sinks.write_fact(half, base, AS_OF_TIME + dt.timedelta(minutes=minutes), in_order=True, text_codec=sinks.ZSTD_TEXT)
    return store.combine_files(spark, base)


def _overlapping(spark: SparkSession, d: str) -> str:
    """Two runs of the scheduled job, half an hour apart, each looking back six hours from within a window.

    Bills are stamped at minute 45, so that a window of which only the latter half was seen would still find its bill.
    """
    base = run_dir(spark, "overlap")
    bills = _billing(spark, d).withColumn("UsageDate", F.col("UsageDate") + F.expr("INTERVAL 45 MINUTES"))
    for moment in (INSIDE, "2024-01-24 12:30:00"):
        run_once(spark, _telemetry(spark, d), bills, dt.datetime.fromisoformat(moment), base, lookback_hours=6, by_window=True)
    return base


@query("combine_overlapping_runs")
def _(spark, d):
    return store.combine_files(spark, _overlapping(spark, d), _ROW)


@query("read_overlapping_windows")
def _(spark, d):
    return store.read_windows(spark, _overlapping(spark, d), "2024-01-24 06:00:00", INSIDE).select(_ROW)


@query("run_owners")
def _(spark, d):
    """Which run counts for which window, of three runs of which the last one saw only its latter windows."""
    base, fact = run_dir(spark, "owners"), _fact(spark, d, by_day=True)
    for minutes, first in ((0, "2024-01-01"), (6, "2024-01-10"), (12, "2024-01-20")):
        rows, moment = fact.where(F.col("TimeWindow") >= F.lit(first).cast("timestamp")), AS_OF_TIME + dt.timedelta(minutes=minutes)
        sinks.write_by_window(rows, base, moment, Span(dt.datetime.fromisoformat(first), AS_OF_TIME, moment), dealt=True)
        fact = store.read_run(spark, base, moment)  # each run sees a part of what the one before it has stored
    log = store.read_log(spark, base)
    owned = store.owners(log, "2024-01-05", "2024-01-25")
    return owned.groupBy("RunKey").agg(F.count("*").alias("n_windows"), F.min("TimeWindow").alias("FirstWindow"), F.max("TimeWindow").alias("LastWindow"))


@query("read_summaries")
def _(spark, d):
    base = run_dir(spark, "summaries")
    sinks.write_summaries(_fact(spark, d), base, AS_OF_TIME)
    return store.read_summaries(spark, base, "device")


# Cleansing ----------------------------------------------------------------


on_telemetry("lookback_filter", lambda t: cleanse.lookback_filter(t, "TimeGenerated", INSIDE, hours=36).drop("TimeWindow"))


@query("norm_gateway_record")
def _(spark, d):
    return logs.norm_gateway_record(logs.read_gateway_logs(testtables.gateway_logs(spark, d), None, None))


@query("norm_request_record")
def _(spark, d):
    return logs.norm_request_record(logs.read_requests(testtables.request_rows(spark, d), None, None))


on_telemetry("preprocess_telemetry", lambda t: t)


@query("preprocess_cost")
def _(spark, d):
    return _cost(spark, d).select(
        "UsageDate", "TimeWindow", "ResourceId", "MeterName", "Cost", "UsageQuantity", "CostPerUnit"
    )


@query("preprocess_cost_daily")
def _(spark, d):
    export = billing.query_cost_usage(_billing(spark, d)).withColumn(
        "UsageDate", F.date_format("UsageDate", "yyyyMMdd").cast("int")
    )
    return windowed_cost(export, cleanse.DAY).select("UsageDate", "TimeWindow", "ResourceId", "MeterName", "Cost")


@query("normalize_resource_id")
def _(spark, d):
    raw = _telemetry(spark, d).select("ResourceId")
    return raw.groupBy("ResourceId", normalize_resource_id(F.col("ResourceId")).alias("Normalized")).agg(
        F.count("*").alias("n")
    )


@query("categorize_cost")
def _(spark, d):
    rows = billing.categorize_cost(_billing(spark, d).withColumnsRenamed({"Meter": "MeterName", "PreTaxCost": "Cost"}))
    return rows.select(
        "UsageDate", "ResourceId", "MeterName", "CostType", "TokenType", "ModelFamily", "IsTokenBased", "CostPerUnit"
    )


@query("categorize_cost_extended")
def _(spark, d):
    rows = billing.normalize_cost(_billing(spark, d), extended=True)
    return rows.groupBy("MeterName", "CostType", "TokenType", "IsTokenBased").agg(F.sum("Cost").alias("Cost"))


@query("normalize_cost")
def _(spark, d):
    return billing.normalize_cost(_billing(spark, d))


@query("filter_costs_by_resources")
def _(spark, d):
    wanted = [f"{testtables.ARM_PREFIX}{i}" for i in (1, 3)]
    return billing.filter_costs_by_resources(_billing(spark, d), wanted)


@query("filter_costs_by_resource_table")
def _(spark, d):
    # resources of one region that saw an error; the telemetry names them by path, address or plain name
    regions = testtables.region_of_resource(spark, d).where("Region = 'region-1'").select("ResourceId")
    failed = _telemetry(spark, d).where(F.col("StatusCode") >= 400)
    failed = failed.withColumn("ResourceId", F.col("ResourceId")).join(
        regions.withColumnRenamed("ResourceId", "_name"),
        normalize_resource_id(F.col("ResourceId")) == F.col("_name"), "left_semi",
    )
    return billing.filter_costs_by_resources(_billing(spark, d), failed)


@query("drop_empty_dims")
def _(spark, d):
    dims = events.drop_empty_dims(events.parse_events(testtables.raw_events(spark, d)))
    names = [name for name, _, _ in events.DIMENSIONS]
    kept = F.col("customDimensions")
    return dims.select(
        F.size(kept).alias("n_dimensions"),
        *[kept[n].alias(n) for n in names if n in ("correlation_id", "device_id", "store_number", "tokens_used", "product_id", "model")],
    )


on_fact("known_only", cleanse.known_only)
on_fact("row_level_security_store", lambda f: cleanse.own_store_rows(f, "store-3").select(
    "TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "AllocatedCost"))


@query("row_level_security")
def _(spark, d):
    rows = cleanse.mapped_device_rows(_fact(spark, d), testtables.user_device_map(spark, d), "person-2")
    return rows.select("TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "AllocatedCost")


on_fact("add_period_columns", lambda f: cleanse.add_period_columns(f).select(
    "TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "CostPerToken", "Month", "Week"))
on_report("incremental_range", lambda f: f.select(_ROW), "2024-01-08", "2024-01-15")
on_report("incremental_refresh", lambda f: cleanse.refresh_range(f, INSIDE_DAY).select(_ROW), WEEK_BEFORE, INSIDE_DAY)


@query("incremental_range_recomputed")
def _(spark, d):
    """A window is split by its own usage and cost alone, so the range is cut before anything is aggregated."""
    start, end = "2024-01-08", "2024-01-15"
    calls = cleanse.between(_telemetry(spark, d), "TimeGenerated", start, end)
    bills = cleanse.between(_billing(spark, d), "UsageDate", start, end)
    return cleanse.incremental_range(correlated_fact(calls, bills, AS_OF), start, end).select(_ROW)


@query("attribute_fallback")
def _(spark, d):
    return logs.attribute_fallback(testtables.gateway_logs(spark, d)).select(
        "CorrelationId", "deviceId", "storeNumber"
    )


@query("extract_token_usage")
def _(spark, d):
    return logs.extract_token_usage(testtables.gateway_logs(spark, d)).select(
        "CorrelationId", "tokensUsed", "promptTokens", "completionTokens", "model"
    )


@query("extract_backend_resource")
def _(spark, d):
    return logs.extract_backend_resource(testtables.gateway_logs(spark, d)).select("CorrelationId", "resourceId")


# Union and duplicates -----------------------------------------------------


@query("union_telemetry")
def _(spark, d):
    return dedup.union_telemetry(*testtables.telemetry_sources(spark, d))


@query("dedup_telemetry")
def _(spark, d):
    return dedup.dedup_telemetry(dedup.union_telemetry(*testtables.telemetry_sources(spark, d)))


@query("duplicate_check")
def _(spark, d):
    return dedup.duplicate_check(dedup.union_telemetry(*testtables.telemetry_sources(spark, d)))


# Joins and allocation -----------------------------------------------------


@query("correlate_time_window")
def _(spark, d):
    return correlate.correlate_time_window(_usage(spark, d), correlate.cost_lines(_cost(spark, d)))


@query("weighted_merge")
def _(spark, d):
    return advanced.weighted_merge(
        summaries.weighted_usage(_clean(spark, d), AS_OF, DECAY_HOURS, by_resource=True),
        summaries.weighted_cost(_cost(spark, d), AS_OF, DECAY_HOURS),
    )


@query("time_weighted_correlation")
def _(spark, d):
    return advanced.time_weighted_correlation(_clean(spark, d), _cost(spark, d), AS_OF)


@query("uncorrelated_rows")
def _(spark, d):
    return correlate.uncorrelated_rows(_usage(spark, d), _cost(spark, d))


@query("star_join")
def _(spark, d):
    """Fact and dimensions come from the stored fact, which is computed once."""
    fact = store.read_windows(spark, _stored_windows(spark, d))
    # names are changed only so that the three dimensions do not collide
    devices = summaries.device_performance(fact).select(
        "DeviceId", F.col("AllocatedCost_sum").alias("DeviceCost"), F.col("StoreNumber_first").alias("HomeStore")
    )
    stores = summaries.store_summary(fact).select("StoreNumber", F.col("TotalCost").alias("StoreCost"), "UniqueDevices")
    joined = reports.star_join(fact, reports.dim_date(fact), devices, stores)
    return joined.select(
        "TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "AllocatedCost", "WeekdayName",
        "Quarter", "IsBusinessDay", "DeviceCost", "HomeStore", "StoreCost", "UniqueDevices",
    )


for _method, _key in {
    "proportional": "alloc_proportional",
    "token-based": "alloc_token_based",
    "equal": "alloc_equal",
    "usage-based": "alloc_usage_based",
    "time-weighted": "alloc_time_weighted",
}.items():
    for _mode, _suffix in ((correlate.CONSERVING, ""), (correlate.REFERENCE, "_reference")):

        @query(_key + _suffix)
        def _(spark, d, method=_method, mode=_mode):
            return allocated_costs(_telemetry(spark, d), _billing(spark, d), method, mode).select(
                "TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "AllocatedCost", "TotalCost",
                "AllocationMethod", "TokenShare", "ApiCallShare",
            )


@query("alloc_dispatch")
def _(spark, d):
    """Total allocated by every method and mode: one join per mode."""
    cells, cost = windowed_usage(_telemetry(spark, d), decay_hours=FACT_DECAY_HOURS), _cost(spark, d)
    conserving, reference = (correlate.allocated_by_all(cells, cost, m) for m in (correlate.CONSERVING, correlate.REFERENCE))
    return conserving.unionByName(reference)


@query("alloc_exact")
def _(spark, d):
    """Whole millionths of every cost line, split by largest remainders: no tolerance is needed."""
    cost = _cost(spark, d)
    return apportion.reconcile_exact(apportion.allocate_exact(_usage(spark, d), cost), cost)


on_fact("enrich_fact", lambda f: f.select(
    "TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber", "IsUnknownDevice", "IsUnknownStore",
    "HasCompleteAttribution", "CostPerToken", "CostPerApiCall", "Hour", "DayOfWeek", "IsBusinessHours", "IsWeekday",
    "ShiftCategory", "CorrelationTimestamp", "ProcessingDate"))
_SCORE_KEY = ["TimeWindow", "ResourceId", "MeterName", "DeviceId", "StoreNumber"]
on_fact("score_confidence", lambda f: f.select(*_SCORE_KEY, "CorrelationConfidence"))
on_fact("score_utilization", lambda f: f.select(*_SCORE_KEY, "DeviceUtilizationScore"))


@query("score_accuracy")
def _(spark, d):
    """Accuracy does not depend on the amounts, so one fact serves all methods."""
    by = [
        F.struct(F.lit(m).alias("AllocationMethod"), scores.accuracy(
            F.lit(m), F.col("IsUnknownDevice"), F.col("IsUnknownStore"), F.col("TokensUsed")
        ).alias("AllocationAccuracy"))
        for m in correlate.METHODS
    ]
    rows = _fact(spark, d).select("IsUnknownDevice", "IsUnknownStore", F.inline(F.array(*by)))
    return rows.groupBy("AllocationMethod", "IsUnknownDevice", "IsUnknownStore", "AllocationAccuracy").agg(
        F.count("*").alias("n")
    )


on_fact("correlated_fact", lambda f: f)


@query("correlated_fact_reference")
def _(spark, d):
    return _fact(spark, d, mode=correlate.REFERENCE)


@query("reconcile_allocation")
def _(spark, d):
    return quality.reconcile_allocation(_fact(spark, d), _cost(spark, d))


@query("reconcile_total")
def _(spark, d):
    return quality.reconcile_total(_fact(spark, d), _cost(spark, d))


on_fact("dq_rules", quality.dq_rules)


@query("unreadable_numbers")
def _(spark, d):
    read = events.parse_events(testtables.raw_events(spark, d))
    return quality.unreadable_numbers(read, ["statusCode", "tokensUsed", "promptTokens", "completionTokens", "responseTime"])




# Aggregations -------------------------------------------------------------


query("usage_by_window")(_usage)
on_telemetry("telemetry_summary", summaries.telemetry_summary)
query("cost_summary")(lambda spark, d: summaries.cost_summary(_cost(spark, d)))
on_fact("correlation_summary", summaries.correlation_summary)
on_report("cost_breakdowns", summaries.cost_breakdowns)
on_fact("device_performance", summaries.device_performance)
on_report("store_performance", summaries.store_performance)
on_report("shift_analysis", summaries.shift_analysis)
on_report("business_hours_split", summaries.business_hours_split)
on_fact("device_summary", summaries.device_summary)
on_fact("store_summary", summaries.store_summary)
query("run_stats")(lambda spark, d: summaries.run_stats(_clean(spark, d), _cost(spark, d), _fact(spark, d)))
on_telemetry("weighted_usage", lambda t: summaries.weighted_usage(t, AS_OF, DECAY_HOURS))
query("weighted_cost")(lambda spark, d: summaries.weighted_cost(_cost(spark, d), AS_OF, DECAY_HOURS))
on_telemetry("api_usage_analysis", lambda t: summaries.api_usage_analysis(t, INSIDE))
on_report("cost_by_user_store_day", lambda f: summaries.cost_by_user_store_day(f, INSIDE))
on_fact("model_usage_hourly", summaries.model_usage_hourly)


@query("resource_health")
def _(spark, d):
    return summaries.resource_health(logs.read_traces(testtables.traces(spark, d), INSIDE, WEEK_HOURS), INSIDE)


@query("resource_time_coverage")
def _(spark, d):
    return summaries.resource_time_coverage(_telemetry(spark, d))


query("trace_rate_5m")(lambda spark, d: summaries.trace_rate_5m(testtables.app_logs(spark, d)))
query("throttle_hits_10m")(lambda spark, d: summaries.throttle_hits_10m(testtables.app_logs(spark, d)))
query("invocation_outcomes")(lambda spark, d: summaries.invocation_outcomes(testtables.app_logs(spark, d)))
query("error_count")(lambda spark, d: summaries.error_count(testtables.app_logs(spark, d)))
query("date_hierarchy_rollup")(
    lambda spark, d: summaries.date_hierarchy_rollup(
        measures.daily_cost(_shipped(spark, d), "UsageDate", "PreTaxCost")
    )
)
query("store_hierarchy_rollup")(
    lambda spark, d: summaries.store_hierarchy_rollup(_fact(spark, d), testtables.region_of_resource(spark, d))
)

# Measures -----------------------------------------------------------------

on_report("device_rank", measures.device_rank)
query("usage_shares")(lambda spark, d: correlate.usage_shares(_usage(spark, d)))
on_report("model_cost_share", measures.model_cost_share)


def _monthly(spark, d):
    return measures.monthly_cost(_shipped(spark, d), "UsageDate", "PreTaxCost")


query("cost_vs_prev_month")(lambda spark, d: measures.cost_vs_prev_month(_monthly(spark, d)))
query("trailing_30d_cost")(
    lambda spark, d: measures.trailing_30d_cost(measures.daily_cost(_shipped(spark, d), "UsageDate", "PreTaxCost"))
)
query("cost_forecast")(lambda spark, d: measures.cost_forecast(_monthly(spark, d)))
on_report("cost_anomaly_2sigma", measures.cost_anomaly_2sigma)
on_telemetry("peak_hours", measures.peak_hours)
on_report("top_devices", measures.top_devices)
on_report("top_stores", measures.top_stores)
query("recent_calls")(lambda spark, d: measures.recent_calls(testtables.app_logs(spark, d)))
on_report("top_device_cost", measures.top_device_cost)

# Reports ------------------------------------------------------------------

on_report("kpi_core", reports.kpi_core)
on_report("store_cost_known", reports.store_cost_known)
on_report("gpt5_measures", reports.gpt5_measures)
on_report("model_performance_score", reports.model_performance_score)
on_report("shift_pivot", reports.shift_pivot)
query("dim_date")(lambda spark, d: reports.dim_date(_clean(spark, d), "TimeGenerated"))
on_telemetry("usage_heatmap", reports.usage_heatmap)
on_report("model_by_store", reports.model_by_store)
on_report("daily_cost_trend", reports.daily_cost_trend)
on_report("model_efficiency", reports.model_efficiency)
query("daily_usage_share")(lambda spark, d: reports.daily_usage_share(_fact(spark, d, window_minutes=cleanse.DAY)))
query("monthly_cost")(_monthly)

# Analyses -----------------------------------------------------------------


def _last_day(spark, d):
    return cleanse.lookback_filter(_clean(spark, d), "TimeGenerated", INSIDE, days=1)


def _patterns(spark, d):
    """Patterns of the seven days before the last one."""
    return advanced.device_usage_patterns(_clean(spark, d), DAY_BEFORE)


on_telemetry("device_usage_patterns", lambda t: advanced.device_usage_patterns(t, INSIDE))
on_fact("device_cost_models", advanced.device_cost_models)
query("model_lookup_join")(
    lambda spark, d: advanced.model_lookup_join(_last_day(spark, d), advanced.device_cost_models(_fact(spark, d)))
)
query("predict_cost")(
    lambda spark, d: advanced.predict_cost(_last_day(spark, d), advanced.device_cost_models(_fact(spark, d)))
)
query("pattern_lookup_join")(lambda spark, d: advanced.pattern_lookup_join(_last_day(spark, d), _patterns(spark, d)))
# Usage and cost of the given tables are even: with the limits of the operators nothing stands out, so these are lower.
query("usage_anomalies")(
    lambda spark, d: advanced.usage_anomalies(_last_day(spark, d), _patterns(spark, d), limit=0.5, severe=0.75)
)
on_fact("device_pair_join", lambda f: advanced.device_pair_join(f, 0.1))
on_fact("device_spillover", lambda f: advanced.device_spillover(f, 0.1))
on_report("device_correlation_index", lambda f: device_correlation_index(
    f, dt.datetime.fromisoformat(testtables.FIRST_DAY), AS_OF_TIME, bucket_hours=72, limit=0.5))
query("recommend_allocation")(lambda spark, d: advanced.recommend_allocation(_clean(spark, d), _cost(spark, d)))
query("recommend_allocation_no_cost")(
    lambda spark, d: advanced.recommend_allocation(_clean(spark, d), _cost(spark, d).where("Cost < 0"))
)

# States per day -----------------------------------------------------------

_states: dict[tuple, str] = {}
RANGE = dt.date(2024, 1, 8), dt.date(2024, 1, 15)


def _stored_states(spark: SparkSession, d: str) -> str:
    """Where the daily states of a folder of tables are, written once per session and state of the stored fact."""
    stored = _stored_windows(spark, d)
    key = (spark.sparkContext.applicationId, stored)
    if key not in _states:
        base = run_dir(spark, "states")
        daily_state.write_fact_states(store.read_windows(spark, stored), base)
        daily_state.write_usage_states(_clean(spark, d), base)
        _states[key] = base
    return _states[key]


for _name, _of_range in {
    "range_summary": daily_state.range_summary,
    "range_store_performance": daily_state.range_store_performance,
    "range_model_usage": daily_state.range_model_usage,
    "range_cost_models": daily_state.range_cost_models,
    "range_usage_patterns": daily_state.range_usage_patterns,
    "range_busy_hours": daily_state.range_busy_hours,
}.items():
    query(_name)(lambda spark, d, of_range=_of_range: of_range(spark, _stored_states(spark, d), *RANGE))

# Sinks --------------------------------------------------------------------


@query("write_fact")
def _(spark, d):
    """Rows and cost of the stored run, read back from each format."""
    base = _stored(spark, d)
    total = None
    for file_format in store.FORMATS:
        rows = store.read_partition(spark, base, AS_OF_TIME.date(), file_format)
        one = rows.groupBy("ModelFamily").agg(
            F.count("*").alias("n"), F.sum("AllocatedCost").alias("AllocatedCost"), F.max("TimeWindow").alias("last")
        ).select(F.lit(file_format).alias("Format"), "*")
        total = one if total is None else total.unionByName(one)
    return total


@query("write_summaries")
def _(spark, d):
    base = run_dir(spark, "summaries")
    sinks.write_summaries(_fact(spark, d), base, AS_OF_TIME)
    return store.read_summaries(spark, base, "store")


@query("write_raw")
def _(spark, d):
    base = run_dir(spark, "raw")
    sinks.write_raw(_telemetry(spark, d), _billing(spark, d), base, AS_OF_TIME)
    telemetry = spark.read.schema("TimeGenerated timestamp, TokensUsed bigint").json(f"{base}/raw/telemetry")
    cost = spark.read.schema("UsageDate timestamp, PreTaxCost double").json(f"{base}/raw/cost")
    return telemetry.agg(
        F.lit("telemetry").alias("kind"), F.count("*").alias("n"), F.sum("TokensUsed").cast("double").alias("amount")
    ).unionByName(
        cost.agg(F.lit("cost").alias("kind"), F.count("*").alias("n"), F.sum("PreTaxCost").alias("amount"))
    )


@query("list_partitions")
def _(spark, d):
    return store.list_partitions(spark, _stored(spark, d), dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def _stored_days(spark: SparkSession, d: str) -> str:
    """Runs on three days, one of them with two runs."""
    base, fact = run_dir(spark, "store"), store.read_windows(spark, _stored_windows(spark, d))
    for days, hours in ((0, 0), (1, 0), (100, 0), (100, 3)):
        moment = AS_OF_TIME + dt.timedelta(days=days, hours=hours)
        of_day = fact.withColumn("ProcessingDate", F.lit(moment.date()))
        sinks.write_fact(of_day, base, moment, in_order=True, text_codec=sinks.ZSTD_TEXT)
    return base


@query("storage_metrics")
def _(spark, d):
    kept = sinks.storage_metrics(spark, _stored_days(spark, d), AS_OF_TIME + dt.timedelta(days=120))
    # how many files and bytes a run takes is up to the cluster
    return kept.withColumn("HasFiles", (F.col("Files") >= F.col("Runs")) & (F.col("Bytes") > 0)).drop("Files", "Bytes", "MegaBytes")


@query("retention_report")
def _(spark, d):
    expired = sinks.retention_report(spark, _stored_days(spark, d), AS_OF_TIME + dt.timedelta(days=120))
    return expired.withColumn("FreesBytes", F.col("BytesToFree") > 0).drop("FilesToDelete", "BytesToFree")


# Streams ------------------------------------------------------------------


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    # A pattern, so that the table may be one file or a folder of files.
    return spark.readStream.schema(EVENTS_TABLE).parquet(f"{d.rstrip('/')}/[e]vents.parquet")


@query("stream_ingest")
def _(spark, d):
    path = run_dir(spark, "ingest")
    # bodies as an event log hands them out: one text each
    testtables.raw_events(spark, d).select("value").write.text(f"{path}/log")
    bodies = ingest.body_stream(spark, "text", path=f"{path}/log")
    ingest.start_ingest(bodies, f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out").select(
        "eventType", "timestamp", "correlationId", "deviceId", "storeNumber", "statusCode", "tokensUsed", "resourceId"
    )


def _routed(spark: SparkSession, d: str) -> str:
    path = run_dir(spark, "routes")
    bodies = testtables.raw_event_bodies(_event_stream(spark, d)).select("value")
    ingest.start_route_errors(bodies, f"{path}/out", f"{path}/state").awaitTermination()
    return f"{path}/out"


@query("stream_route_errors")
def _(spark, d):
    def dim(name: str):
        return F.get_json_object("Record", f"$.customDimensions.{name}").alias(name)

    return ingest.read_routed(spark, _routed(spark, d)).select(
        "Route", *[dim(n) for n in ("correlation_id", "device_id", "store_number", "tokens_used", "status_code")]
    )


@query("stream_batch_counts")
def _(spark, d):
    counts = ingest.batch_counts(spark, _routed(spark, d))
    return counts.agg(*[F.sum(c).alias(c) for c in ("batch_size", "processed_count", "error_count")])


@query("stream_usage_window")
def _(spark, d):
    path = run_dir(spark, "usage")
    rows = testtables.telemetry_of(_event_stream(spark, d))
    usage.start_stream_usage(rows, f"{path}/out", f"{path}/state").awaitTermination()
    return usage.read_stream_usage(spark, f"{path}/out")


PIECE_ROWS, MOST_PIECES = 100_000, 64


def _in_pieces(spark: SparkSession, path: str, *parts: DataFrame, least: int = PIECE_ROWS) -> DataFrame:
    """A stream that gets one part a batch, in this order: each is written as equally many files, more of them the larger the least part is."""
    n = max(1, min(MOST_PIECES, min(part.count() for part in parts) // least))
    for part in parts:
        # rows are dealt in turn, so that no file is left out for want of rows
        (part.coalesce(1) if n == 1 else part.repartition(n)).write.mode("append").parquet(path)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", n).parquet(path)


@query("stream_closed_usage")
def _(spark, d):
    """Three parts of the month in order, then a tenth of all calls, most of whose windows are over by then."""
    path = run_dir(spark, "closed")
    rows = _telemetry(spark, d)
    late, part = F.pmod(F.crc32(F.col("RequestId").cast("binary")), F.lit(10)) == 0, F.floor((F.dayofmonth("TimeGenerated") - 1) / 10)
    stream = _in_pieces(spark, f"{path}/in", *[rows.where(~late & (part >= k if k == 2 else part == k)) for k in range(3)], rows.where(late))
    stateful.start_closed_usage(stream, f"{path}/out", f"{path}/state").awaitTermination()
    return stateful.read_closed_usage(spark, f"{path}/out")


def _dedup_changes(spark: SparkSession, d: str) -> str:
    """The request log arrives first, then the gateway's copies, then some of them again."""
    path = run_dir(spark, "changes")
    union = dedup.union_telemetry(*testtables.telemetry_sources(spark, d))
    by_source = [union.where(F.col("Source") == source) for source in reversed(dedup.SOURCE_ORDER)]
    stream = _in_pieces(spark, f"{path}/in", *by_source, by_source[1].where("StatusCode <> 200"))
    stateful.start_dedup_changes(stream, f"{path}/out", f"{path}/state", keep_hours=24 * 60).awaitTermination()
    return f"{path}/out"


@query("stream_dedup_changes")
def _(spark, d):
    return stateful.read_dedup_changes(spark, _dedup_changes(spark, d))


@query("stream_usage_of_changes")
def _(spark, d):
    """Usage kept up from what each batch changed."""
    changes = stateful.changes_store(spark, _dedup_changes(spark, d)).read()
    return usage.finished(stateful.usage_of_changes(changes))


def _deduped(spark: SparkSession, d: str) -> DataFrame:
    """The request log arrives first, in batches of its own."""
    path = run_dir(spark, "dedup")
    gateway, requests = testtables.telemetry_sources(spark, d)
    union = dedup.union_telemetry(gateway, requests)
    for place, source in enumerate(reversed(dedup.SOURCE_ORDER)):
        union.where(F.col("Source") == source).write.parquet(f"{path}/in/{place}")
    arriving = (
        spark.readStream.schema(union.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")
    )
    usage.start_stream_dedup(arriving, f"{path}/out", f"{path}/state").awaitTermination()
    return usage.read_stream_dedup(spark, f"{path}/out")


query("stream_dedup")(_deduped)


@query("stream_dedup_usage_window")
def _(spark, d):
    return windowed_usage(_deduped(spark, d))


@query("stream_late_cost")
def _(spark, d):
    path = run_dir(spark, "late-cost")
    late_cost.write_usage(_usage(spark, d), f"{path}/usage")
    # Files in date order, one per batch: cost arriving piece by piece. Every file is delivered twice, the first time
    # with amounts that are restated later.
    bills = materialize(_billing(spark, d), "late-bills").repartitionByRange(3, "UsageDate")
    bills.withColumn("PreTaxCost", F.col("PreTaxCost") * 3).write.parquet(f"{path}/billing")
    for _ in range(2):
        bills.write.mode("append").parquet(f"{path}/billing")
    arriving = (
        spark.readStream.schema(_billing(spark, d).schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/billing")
    )
    late_cost.start_late_cost(arriving, f"{path}/usage", f"{path}/cost", f"{path}/fact", f"{path}/state").awaitTermination()
    return late_cost.read_late_fact(spark, f"{path}/fact", AS_OF)


@query("stream_late_cost_notes")
def _(spark, d):
    """All bills, then all of them again, then one meter restated: how many lines each batch has to change."""
    path = run_dir(spark, "late-notes")
    late_cost.write_usage(_usage(spark, d), f"{path}/usage")
    bills = _billing(spark, d)
    restated = bills.where("cost_seq = 2 AND UsageDate < TIMESTAMP '2024-01-02'").withColumn("PreTaxCost", F.col("PreTaxCost") * 2)
    for rows in (bills, bills, restated):
        rows.coalesce(1).write.mode("append").parquet(f"{path}/billing")
    arriving = spark.readStream.schema(bills.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/billing")
    late_cost.start_late_cost(arriving, f"{path}/usage", f"{path}/cost", f"{path}/fact", f"{path}/state").awaitTermination()
    return late_cost.batch_notes(spark, f"{path}/fact")


@query("scheduled_run")
def _(spark, d):
    """A run for a past moment."""
    moment = dt.datetime.fromisoformat(INSIDE)
    return run_once(spark, _telemetry(spark, d), _billing(spark, d), moment, run_dir(spark, "run"), lookback_hours=72)
