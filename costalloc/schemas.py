"""Explicit schemas of the tables that enter and leave the engine."""

from pyspark.sql import types as T

S, I, L, D, B, TS, DT = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
    T.DateType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Gateway event envelope. Every field is read as text, so that only malformed
# JSON counts as a bad record and an odd number is handled by try_cast later.
EVENT_ENVELOPE = _struct(
    eventType=S, timestamp=S, correlationId=S, deviceId=S, url=S, storeNumber=S, apiName=S,
    operationName=S, method=S, statusCode=S, tokensUsed=S, promptTokens=S, completionTokens=S,
    model=S, apiVersion=S, deploymentId=S, subscriptionId=S, productId=S, resourceRegion=S,
    resourceId=S, responseTime=S, errorMessage=S, errorSource=S,
)

TRACE_MESSAGE = _struct(message=S, customDimensions=T.MapType(S, S))

TELEMETRY = _struct(
    Source=S, TimeGenerated=TS, RequestId=S, deviceId=S, storeNumber=S, ApiName=S, Method=S,
    Url=S, StatusCode=I, ResponseTime=D, TokensUsed=L, ResourceId=S,
)

BILLING_EXPORT = _struct(
    PreTaxCost=D, UsageQuantity=D, UsageDate=I, ResourceId=S, ResourceType=S, ServiceName=S,
    Meter=S, Currency=S,
)

CORRELATED_FACT = _struct(
    TimeWindow=TS, ResourceId=S, ResourceName=S, ResourceGroup=S, DeviceId=S, StoreNumber=S,
    DeviceStoreKey=S, AllocatedCost=D, TotalCost=D, AllocationMethod=S, TokensUsed=L, ApiCalls=L,
    AvgResponseTime=D, CostType=S, ModelFamily=S, MeterName=S, Currency=S, TokenShare=D,
    ApiCallShare=D, CorrelationTimestamp=TS, ProcessingDate=DT, IsUnknownDevice=B,
    IsUnknownStore=B, HasCompleteAttribution=B, CostPerToken=D, CostPerApiCall=D, Hour=I,
    DayOfWeek=S, IsBusinessHours=B, IsWeekday=B, ShiftCategory=S, CorrelationConfidence=D,
    AllocationAccuracy=D, DeviceUtilizationScore=D,
)

EVENTS_TABLE = _struct(
    event_id=L, ts=T.TimestampNTZType(), user_id=L, event_type=S, value=D, props=S,
)
