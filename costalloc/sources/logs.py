"""Log tables of the gateway and the application monitor, as telemetry rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costalloc.functions.ids import UNKNOWN, known_or_unknown, non_empty, url_host_label
from costalloc.functions.numbers import number_or_zero
from costalloc.operators.cleanse import lookback_filter
from costalloc.schemas import TELEMETRY, TRACE_MESSAGE

# Header, query and dimension names of the log tables.
DEVICE_KEYS = ["device-id", "device_id"]
STORE_KEYS = ["store-number", "store_number"]
TOKEN_HEADER = "x-ms-token-usage-total"
TRACE_TEXT = "FinOpsApiCall"
TRACE_TEXT_CASED = "device_id"
REQUEST_NAME_TEXT = "openai"
MODEL_HOST = ".openai.azure.com"


def or_unknown(c: Column) -> Column:
    return F.coalesce(non_empty(c), F.lit(UNKNOWN))


def _recent(rows: DataFrame, time: str, as_of, lookback_hours: int | None) -> DataFrame:
    return rows if lookback_hours is None else lookback_filter(rows, time, as_of, hours=lookback_hours)


def read_traces(traces: DataFrame, as_of, lookback_hours: int | None) -> DataFrame:
    """Forwarded trace lines to telemetry: keep matching lines with a status above 0. No lookback: the whole log."""
    wanted = F.lower("Message").contains(TRACE_TEXT.lower()) | F.col("Message").contains(TRACE_TEXT_CASED)
    dims = F.col("customDimensions")
    return (
        _recent(traces, "TimeGenerated", as_of, lookback_hours)
        .where(wanted)
        # a generator, so that the message is parsed once and not per column
        .select("TimeGenerated", F.inline(F.array(F.from_json("Message", TRACE_MESSAGE))))
        .select(
            "TimeGenerated",
            # The forwarder names the id correlation_id; older lines say request_id.
            F.coalesce(dims["request_id"], dims["correlation_id"]).alias("RequestId"),
            or_unknown(dims["device_id"]).alias("deviceId"),
            or_unknown(dims["store_number"]).alias("storeNumber"),
            dims["operation_name"].alias("ApiName"),
            dims["method"].alias("Method"),
            dims["url"].alias("Url"),
            dims["status_code"].try_cast("int").alias("StatusCode"),
            dims["response_time_ms"].try_cast("double").alias("ResponseTime"),
            dims["tokens_used"].try_cast("int").alias("TokensUsed"),
            dims["resource_id"].alias("ResourceId"),
        )
        .where(F.col("StatusCode") > 0)
    )


def read_gateway_logs(logs: DataFrame, as_of, lookback_hours: int | None) -> DataFrame:
    """Gateway log rows to telemetry: ids and tokens out of the header maps."""
    request, response = F.col("RequestHeaders"), F.col("ResponseHeaders")
    return (
        _recent(logs, "TimeGenerated", as_of, lookback_hours)
        .where(non_empty(F.col("OperationId")).isNotNull() & (F.col("ResponseCode") > 0))
        .select(
            "TimeGenerated",
            F.col("CorrelationId").alias("RequestId"),
            or_unknown(request[DEVICE_KEYS[0]]).alias("deviceId"),
            or_unknown(request[STORE_KEYS[0]]).alias("storeNumber"),
            F.col("ApiId").alias("ApiName"),
            F.col("OperationId").alias("OperationName"),
            "Method",
            "Url",
            F.col("ResponseCode").alias("StatusCode"),
            F.col("TotalTime").alias("ResponseTime"),
            "BackendTime",
            "ClientTime",
            "RequestSize",
            "ResponseSize",
            response[TOKEN_HEADER].try_cast("int").alias("TokensUsed"),
            F.coalesce(
                non_empty(F.col("BackendId")), non_empty(F.col("BackendUrl")), F.lit(UNKNOWN)
            ).alias("ResourceId"),
            "BackendUrl",
        )
    )


def read_requests(requests: DataFrame, as_of, lookback_hours: int | None) -> DataFrame:
    """Monitor request rows to telemetry; only calls of the model service."""
    dims, measures = F.col("customDimensions"), F.col("customMeasurements")
    return (
        _recent(requests, "timestamp", as_of, lookback_hours)
        .where(F.lower("name").contains(REQUEST_NAME_TEXT))
        .select(
            F.col("timestamp").alias("TimeGenerated"),
            F.col("operation_Id").alias("RequestId"),
            or_unknown(dims[DEVICE_KEYS[0]]).alias("deviceId"),
            or_unknown(dims[STORE_KEYS[0]]).alias("storeNumber"),
            F.col("name").alias("ApiName"),
            F.lit("POST").alias("Method"),
            F.col("url").alias("Url"),
            F.col("resultCode").alias("StatusCode"),
            F.col("duration").alias("ResponseTime"),
            measures["tokens_used"].cast("int").alias("TokensUsed"),
            F.col("cloud_RoleInstance").alias("ResourceId"),
        )
    )


def _normalise(rows: DataFrame, source: str, resource: Column, response_time: Column) -> DataFrame:
    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")).alias(name)

    columns = [
        F.lit(source).alias("Source"),
        F.col("TimeGenerated"),
        text("RequestId"),
        known_or_unknown(F.col("deviceId")).alias("deviceId"),
        known_or_unknown(F.col("storeNumber")).alias("storeNumber"),
        text("ApiName"),
        text("Method"),
        text("Url") if "Url" in rows.columns else F.lit("").alias("Url"),
        number_or_zero(F.col("StatusCode"), "int").alias("StatusCode"),
        response_time.alias("ResponseTime"),
        number_or_zero(F.col("TokensUsed"), "bigint").alias("TokensUsed"),
        resource.alias("ResourceId"),
    ]
    return rows.select(columns).select(TELEMETRY.names)


def norm_gateway_record(rows: DataFrame, source: str = "APIM") -> DataFrame:
    """Telemetry row of the gateway: whole milliseconds, backend URL as fallback id."""
    backend = F.col("BackendUrl") if "BackendUrl" in rows.columns else F.lit(None).cast("string")
    resource = F.coalesce(non_empty(F.col("ResourceId")), non_empty(backend), F.lit(UNKNOWN))
    whole = number_or_zero(F.col("ResponseTime"), "bigint").cast("double")
    return _normalise(rows, source, resource, whole)


def norm_request_record(rows: DataFrame, source: str = "ApplicationInsights") -> DataFrame:
    """Telemetry row of the request table: fractional milliseconds, no fallback id."""
    resource = F.coalesce(F.col("ResourceId"), F.lit(""))
    return _normalise(rows, source, resource, number_or_zero(F.col("ResponseTime"), "double"))


def attribute_fallback(requests: DataFrame) -> DataFrame:
    """Device and store from four places in turn: header, then query, hyphen before underscore."""

    def query_value(key: str) -> Column:
        return F.regexp_extract(F.col("Url"), rf"[?&]{key}=([^&#]*)", 1)

    def first_found(keys: list[str]) -> Column:
        places = [F.col("RequestHeaders")[k] for k in keys] + [query_value(k) for k in keys]
        return F.coalesce(*[non_empty(p) for p in places], F.lit(UNKNOWN))

    return requests.withColumns(
        {"deviceId": first_found(DEVICE_KEYS), "storeNumber": first_found(STORE_KEYS)}
    )


def extract_token_usage(responses: DataFrame, body: str = "ResponseBody") -> DataFrame:
    """Token counts and the model name out of the response body, which is parsed once for all of them.

    A body that is no JSON, or has no such number, gives 0 and `unknown`.
    """
    parsed = responses.withColumn("_parsed", F.try_parse_json(body))

    def found(path: str) -> Column:
        return F.try_variant_get("_parsed", path, "string")

    def usage(name: str) -> Column:
        return number_or_zero(found(f"$.usage.{name}"), "int")

    return parsed.withColumns(
        {
            "tokensUsed": usage("total_tokens"),
            "promptTokens": usage("prompt_tokens"),
            "completionTokens": usage("completion_tokens"),
            "model": F.coalesce(found("$.model"), F.lit(UNKNOWN)),
        }
    ).drop("_parsed")


def extract_backend_resource(rows: DataFrame, url: str = "ServiceUrl") -> DataFrame:
    """Resource name: first host label of a model-service URL."""
    found = F.when(F.col(url).contains(MODEL_HOST), non_empty(url_host_label(F.lower(url))))
    return rows.withColumn("resourceId", F.coalesce(found, F.lit(UNKNOWN)))
