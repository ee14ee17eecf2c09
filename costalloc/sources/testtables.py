"""The given benchmark tables, seen as gateway telemetry and billing rows.

Each function is a plain projection or one aggregate over a whole table, so
the work grows with the tables. Amounts are divided by a prime: no share of a
cost then ends exactly on a decimal rounding tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costalloc.functions.ids import UNKNOWN
from costalloc.sources.events import CALL_EVENT, ERROR_EVENT, parse_events, trace_messages

# Fixed values of the mapping.
AS_OF = "2024-01-31 00:00:00"
FIRST_DAY = "2024-01-01 00:00:00"
PRICE_DIVISOR = 99991.0
ARM_PREFIX = (
    "/subscriptions/sub-1/resourceGroups/rg-1/providers/Microsoft.CognitiveServices/accounts/OpenAI-"
)
# meter and service by line number 1..7
METERS = [
    ("GPT-5 Input Tokens", "Azure OpenAI"),
    ("GPT-5-Turbo Output Tokens", "Azure OpenAI"),
    ("GPT-4o Input Tokens", "Azure OpenAI"),
    ("gpt-4o-mini-0718-Outp-glbl Tokens", "Azure OpenAI"),
    ("GPT-35-Turbo Output Tokens", "Azure OpenAI"),
    ("PTU Provisioned", "Cognitive Services"),
    ("text-embedding-ada-002 Tokens", "Storage"),
]
STORES = 12
RESOURCES = 5
REGIONS = 3
DEVICE = f"IF(user_id % 10 = 0, '{UNKNOWN}', concat('device-', user_id))"
STORE = f"IF(user_id % 15 = 0, '{UNKNOWN}', concat('store-', user_id % {STORES}))"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _calls(events: DataFrame) -> DataFrame:
    """One gateway call per event, with helper columns for the adapters below."""
    named = events.selectExpr(
        "*",
        f"concat('openai-', user_id % {RESOURCES}) AS resource_name",
        f"concat('https://openai-', user_id % {RESOURCES}, '.openai.azure.com/openai') AS Url",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
    )
    return named.selectExpr(
        "event_id",
        "user_id",
        "k",
        "event_type",
        "CAST(ts AS TIMESTAMP) AS TimeGenerated",
        "concat('req-', event_id) AS RequestId",
        f"{DEVICE} AS deviceId",
        f"{STORE} AS storeNumber",
        "event_type AS ApiName",
        "'POST' AS Method",
        "Url",
        "IF(event_type = 'error', 500, 200) AS StatusCode",
        "CAST(floor(value * 10) AS DOUBLE) AS ResponseTime",
        "IF(event_type = 'signup', 0L, k * 20) AS TokensUsed",
        f"CASE event_id % 3 WHEN 0 THEN concat('{ARM_PREFIX}', user_id % {RESOURCES})"
        " WHEN 1 THEN Url ELSE resource_name END AS ResourceId",
        "resource_name",
        f"concat('region-', (user_id % {RESOURCES}) % {REGIONS}) AS resourceRegion",
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls(_table(spark, sf_dir, "events"))


TELEMETRY_COLUMNS = [
    "TimeGenerated", "RequestId", "deviceId", "storeNumber", "ApiName", "Method", "Url",
    "StatusCode", "ResponseTime", "TokensUsed", "ResourceId",
]


def telemetry_of(events: DataFrame) -> DataFrame:
    return _calls(events).select(TELEMETRY_COLUMNS)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_of(_table(spark, sf_dir, "events"))


def telemetry_sources_of(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Gateway rows and request rows; every twentieth event is in both."""
    rows, event = _calls(events), F.col("event_id")
    gateway = rows.where(event % 2 == 0).select(F.lit("APIM").alias("Source"), *TELEMETRY_COLUMNS)
    requests = rows.where((event % 2 == 1) | (event % 20 == 0)).select(
        F.lit("ApplicationInsights").alias("Source"), *TELEMETRY_COLUMNS
    )
    return gateway, requests


def telemetry_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return telemetry_sources_of(_table(spark, sf_dir, "events"))


def _billing(lines: DataFrame, usage_date: str) -> DataFrame:
    meters, services = (", ".join(f"'{v}'" for v in column) for column in zip(*METERS))
    return (
        lines.selectExpr(
            f"{usage_date} AS UsageDate",
            f"l_suppkey % {RESOURCES} AS _resource",
            "l_linenumber",
            "CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS _amount",
            "CAST(l_quantity AS DECIMAL(12,2)) AS _quantity",
        )
        .groupBy("UsageDate", "_resource", "l_linenumber")
        .agg(F.sum("_amount").alias("_amount"), F.sum("_quantity").alias("_quantity"))
        .selectExpr(
            f"CAST(_amount AS DOUBLE) / {PRICE_DIVISOR}D AS PreTaxCost",
            "CAST(_quantity AS DOUBLE) AS UsageQuantity",
            "UsageDate",
            f"concat('{ARM_PREFIX}', _resource) AS ResourceId",
            "'Microsoft.CognitiveServices/accounts' AS ResourceType",
            f"element_at(array({services}), l_linenumber) AS ServiceName",
            f"element_at(array({meters}), l_linenumber) AS Meter",
            "'USD' AS Currency",
            "l_linenumber AS cost_seq",
        )
    )


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly billing rows per resource and meter."""
    hour = f"TIMESTAMP '{FIRST_DAY}' + make_dt_interval(CAST(l_orderkey % 30 AS INT), CAST(l_partkey % 24 AS INT))"
    return _billing(_table(spark, sf_dir, "lineitem"), hour)


def shipped_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing rows dated by ship date: several years of days."""
    return _billing(_table(spark, sf_dir, "lineitem"), "CAST(l_shipdate AS TIMESTAMP)")


def raw_event_bodies(events: DataFrame) -> DataFrame:
    """Event bodies as JSON text, with truncated, foreign and non-object ones among them."""
    rows, event = _calls(events), F.col("event_id")
    body = F.to_json(
        F.struct(
            F.when(event % 50 == 1, "Other")
            .when(F.col("event_type") == "error", ERROR_EVENT)
            .otherwise(CALL_EVENT)
            .alias("eventType"),
            F.date_format("TimeGenerated", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
            F.col("RequestId").alias("correlationId"),
            F.col("deviceId"),
            F.col("Url").alias("url"),
            F.col("storeNumber"),
            F.lit("model-api").alias("apiName"),
            F.col("ApiName").alias("operationName"),
            F.col("Method").alias("method"),
            F.col("StatusCode").alias("statusCode"),
            F.col("TokensUsed").alias("tokensUsed"),
            F.floor(F.col("TokensUsed") / 4).alias("promptTokens"),
            (F.col("TokensUsed") - F.floor(F.col("TokensUsed") / 4)).alias("completionTokens"),
            F.concat(F.lit("gpt-"), (F.col("user_id") % 3 + 3).cast("string")).alias("model"),
            F.lit("2024-02-01").alias("apiVersion"),
            F.lit("").alias("productId"),
            F.col("resourceRegion"),
            F.col("resource_name").alias("resourceId"),
            F.col("ResponseTime").cast("bigint").cast("string").alias("responseTime"),
        )
    )
    damaged = (
        F.when(event % 50 == 0, F.substring(body, 1, 60))
        .when(event % 50 == 2, F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(body)
    )
    return _as_stored(rows.select("event_id", damaged.alias("value")), "value")


def _as_stored(rows: DataFrame, text: str) -> DataFrame:
    """`text` as if read from a table: a generator keeps the optimizer from
    copying the expression that builds it into every use."""
    others = [c for c in rows.columns if c != text]
    return rows.select(*others, F.explode(F.array(text)).alias(text))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_event_bodies(_table(spark, sf_dir, "events"))


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as the forwarder writes them."""
    return _as_stored(trace_messages(parse_events(raw_events(spark, sf_dir))), "Message")


def gateway_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gateway log rows; ids sit in a header or in the query, hyphen or underscore."""
    place = F.col("user_id") % 4
    has_ids = F.col("user_id") % 10 != 0

    def header(where: int, device_key: str, store_key: str) -> Column:
        return F.when(
            has_ids & (place == where),
            F.create_map(F.lit(device_key), F.col("deviceId"), F.lit(store_key), F.col("storeNumber")),
        )

    def query(where: int, device_key: str, store_key: str) -> Column:
        return F.when(
            has_ids & (place == where),
            F.concat(
                F.lit(f"?api-version=1&{device_key}="), F.col("deviceId"),
                F.lit(f"&{store_key}="), F.col("storeNumber"),
            ),
        )

    no_headers = F.create_map().cast("map<string,string>")
    odd = F.col("event_id") % 2 == 1
    return calls(spark, sf_dir).select(
        "TimeGenerated",
        F.col("RequestId").alias("CorrelationId"),
        F.coalesce(
            header(0, "device-id", "store-number"), header(1, "device_id", "store_number"), no_headers
        ).alias("RequestHeaders"),
        F.create_map(F.lit("x-ms-token-usage-total"), F.col("TokensUsed").cast("string")).alias("ResponseHeaders"),
        F.lit("model-api").alias("ApiId"),
        F.when(F.col("event_id") % 7 != 0, F.col("ApiName")).otherwise("").alias("OperationId"),
        "Method",
        F.concat(
            F.col("Url"),
            F.coalesce(
                query(2, "device-id", "store-number"), query(3, "device_id", "store_number"), F.lit("")
            ),
        ).alias("Url"),
        F.col("StatusCode").alias("ResponseCode"),
        F.col("ResponseTime").alias("TotalTime"),
        F.floor(F.col("ResponseTime") / 2).cast("double").alias("BackendTime"),
        F.lit(1.0).alias("ClientTime"),
        (F.col("k") + 100).alias("RequestSize"),
        (F.col("TokensUsed") + 200).alias("ResponseSize"),
        F.when(odd, F.lit(None).cast("string")).otherwise(F.concat(F.lit(ARM_PREFIX), F.col("user_id") % RESOURCES)).alias("BackendId"),
        F.col("Url").alias("BackendUrl"),
        F.when(F.col("event_id") % 5 == 0, F.lit("https://other.example.com/x")).otherwise(F.col("Url")).alias("ServiceUrl"),
        F.to_json(
            F.struct(
                F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("gpt-"), (F.col("user_id") % 3 + 3).cast("string"))).alias("model"),
                F.when(
                    F.col("event_type") != "error",
                    F.struct(
                        F.col("TokensUsed").alias("total_tokens"),
                        F.floor(F.col("TokensUsed") / 4).alias("prompt_tokens"),
                        (F.col("TokensUsed") - F.floor(F.col("TokensUsed") / 4)).alias("completion_tokens"),
                    ),
                ).alias("usage"),
            )
        ).alias("ResponseBody"),
    )


def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitor request rows."""
    return calls(spark, sf_dir).select(
        F.col("TimeGenerated").alias("timestamp"),
        F.concat(F.when(F.col("event_id") % 4 != 0, F.lit("POST /OpenAI/")).otherwise("GET /health/"), F.col("ApiName")).alias("name"),
        F.col("RequestId").alias("operation_Id"),
        F.create_map(
            F.lit("device-id"), F.when(F.col("user_id") % 10 != 0, F.col("deviceId")).otherwise(""),
            F.lit("store-number"), F.col("storeNumber"),
        ).alias("customDimensions"),
        F.create_map(F.lit("tokens_used"), F.col("TokensUsed").cast("double")).alias("customMeasurements"),
        F.col("Url").alias("url"),
        F.col("StatusCode").alias("resultCode"),
        (F.col("ResponseTime") + 0.5).alias("duration"),
        F.col("resource_name").alias("cloud_RoleInstance"),
    )


def app_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host log lines: role, severity, outcome, message."""
    failed = F.col("event_type") == "error"
    return calls(spark, sf_dir).select(
        "event_id",
        "TimeGenerated",
        F.when(F.col("event_id") % 2 == 0, "forwarder").otherwise("collector").alias("AppRoleName"),
        F.when(failed, 3).otherwise(1).alias("SeverityLevel"),
        (~failed).alias("Success"),
        F.concat(
            F.lit("FinOpsApiCall "), F.col("RequestId"), F.lit(" status "),
            F.when(F.col("k") % 10 == 0, "429").when(F.col("k") % 10 == 1, "Rate Limit").otherwise("ok"),
        ).alias("Message"),
    )


def user_device_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which devices a person may see: seven people, each with every seventh device."""
    return (
        _table(spark, sf_dir, "events")
        .select("user_id")
        .distinct()
        .selectExpr("concat('person-', user_id % 7) AS UserName", f"{DEVICE} AS DeviceId")
    )


def region_of_resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region of each resource, as the events name it."""
    return calls(spark, sf_dir).select(
        F.col("resource_name").alias("ResourceId"), F.col("resourceRegion").alias("Region")
    ).distinct()
