"""The gateway event envelope: parse, check, reshape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costalloc.functions.ids import UNKNOWN
from costalloc.functions.numbers import number_or_zero
from costalloc.schemas import EVENT_ENVELOPE

# The two event types that count, and the forwarded message text.
CALL_EVENT = "FinOpsApiCall"
ERROR_EVENT = "FinOpsApiError"

BAD_RECORD = "_bad_record"
PARSE_SCHEMA = T.StructType([*EVENT_ENVELOPE.fields, T.StructField(BAD_RECORD, T.StringType())])

# Forwarded name, envelope field, kind. A number that is 0 and a
# text that is '' or 'unknown' say nothing and are dropped when forwarding.
DIMENSIONS = [
    ("event_type", "eventType", "text"),
    ("device_id", "deviceId", "text"),
    ("store_number", "storeNumber", "text"),
    ("correlation_id", "correlationId", "text"),
    ("tokens_used", "tokensUsed", "number"),
    ("prompt_tokens", "promptTokens", "number"),
    ("completion_tokens", "completionTokens", "number"),
    ("api_name", "apiName", "text"),
    ("operation_name", "operationName", "text"),
    ("model", "model", "text"),
    ("api_version", "apiVersion", "text"),
    ("deployment_id", "deploymentId", "text"),
    ("method", "method", "text"),
    ("url", "url", "text"),
    ("status_code", "statusCode", "number"),
    ("response_time_ms", "responseTime", "text"),
    ("subscription_id", "subscriptionId", "text"),
    ("product_id", "productId", "text"),
    ("resource_region", "resourceRegion", "text"),
    ("resource_id", "resourceId", "text"),
    ("event_timestamp", "timestamp", "text"),
]


def _with_event(raw: DataFrame, body: str) -> DataFrame:
    """Body next to the envelope's columns. As a generator, inline() is a border the
    optimizer does not copy expressions over: each body is parsed exactly once."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    event = F.from_json(F.col(body), PARSE_SCHEMA, options)
    return raw.select(F.col(body).alias("_body"), F.inline(F.array(event)))


def _is_valid() -> Column:
    good = F.col(BAD_RECORD).isNull() & F.col("eventType").isin(CALL_EVENT, ERROR_EVENT)
    return F.coalesce(good, F.lit(False))


def split_events(raw: DataFrame, body: str = "value") -> tuple[DataFrame, DataFrame]:
    """Valid events (envelope columns), and the rejected bodies with the reason."""
    parsed = _with_event(raw, body)
    reason = F.when(
        F.col(BAD_RECORD).isNull() & F.col("eventType").isNotNull(), "other event type"
    ).otherwise("not a JSON object")
    return (
        parsed.where(_is_valid()).select(EVENT_ENVELOPE.names),
        parsed.where(~_is_valid()).select(F.col("_body").alias("body"), reason.alias("reason")),
    )


def parse_events(raw: DataFrame, body: str = "value") -> DataFrame:
    return split_events(raw, body)[0]


def envelope_numbers(events: DataFrame) -> DataFrame:
    """The envelope with typed numbers and time; unreadable numbers become 0."""
    numbers = ["statusCode", "tokensUsed", "promptTokens", "completionTokens"]
    return events.withColumns(
        {n: number_or_zero(F.col(n), "int") for n in numbers}
        | {
            "timestamp": F.try_to_timestamp("timestamp"),
            "responseTime": number_or_zero(F.col("responseTime"), "double"),
        }
    )


def drop_empty_dims(events: DataFrame) -> DataFrame:
    """Forwarded trace record: message, and only the dimensions that say something."""
    entries = []
    for name, field, kind in DIMENSIONS:
        value = F.col(field)
        if kind == "number":
            value = F.when(F.coalesce(value.try_cast("double"), F.lit(1.0)) != 0, value)
        entries += [F.lit(name), F.nullif(F.nullif(value, F.lit("")), F.lit(UNKNOWN))]
    kept = F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())
    return events.select(F.lit(CALL_EVENT).alias("message"), kept.alias("customDimensions"))


def trace_messages(events: DataFrame) -> DataFrame:
    """Forwarded records as log lines: time, severity and the JSON message."""
    record = drop_empty_dims(events).select(
        F.col("customDimensions"), F.to_json(F.struct("message", "customDimensions")).alias("Message")
    )
    dims = F.col("customDimensions")
    return record.select(
        F.try_to_timestamp(dims["event_timestamp"]).alias("TimeGenerated"),
        F.when(dims["event_type"] == ERROR_EVENT, 3).otherwise(1).alias("SeverityLevel"),
        "Message",
    )
