"""Row filters, cleansing and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costalloc.functions.ids import UNKNOWN, normalize_resource_id
from costalloc.functions.numbers import number_or_zero, ratio_or_null
from costalloc.functions.timeparts import (
    billing_timestamp,
    day_name,
    moment,
    week_start_sunday,
    window_start,
)
from costalloc.operators.skew import salted_join

HOUR = 60
DAY = 1440


def lookback_filter(rows: DataFrame, time: str, as_of, hours: int = 0, days: int = 0) -> DataFrame:
    """Rows of the given span that ends at `as_of`, which is not part of it.

    A run repeated for a past moment thus sees the same rows, whatever has arrived since.
    """
    start = moment(as_of) - F.make_dt_interval(F.lit(days), F.lit(hours))
    return rows.where((F.col(time) >= start) & (F.col(time) < moment(as_of)))


def preprocess_telemetry(telemetry: DataFrame, window_minutes: int = HOUR) -> DataFrame:
    """Typed, null-free telemetry with its time window; rows without a time drop out."""
    ts = F.col("TimeGenerated")
    if telemetry.schema["TimeGenerated"].dataType != T.TimestampType():
        ts = ts.cast("timestamp")  # a cast would lose the watermark of a stream
    device = F.coalesce("deviceId", F.lit(UNKNOWN))
    store = F.coalesce("storeNumber", F.lit(UNKNOWN))
    cleaned = telemetry.withColumns(
        {
            "TimeGenerated": ts,
            "deviceId": device,
            "storeNumber": store,
            "DeviceStoreKey": F.concat_ws("_", device, store),
            "HourOfDay": F.hour(ts),
            "DayOfWeek": day_name(ts),
            "StatusCode": number_or_zero(F.col("StatusCode"), "int"),
            "ResponseTime": number_or_zero(F.col("ResponseTime"), "double"),
            "TokensUsed": number_or_zero(F.col("TokensUsed"), "bigint"),
            "ResourceId": normalize_resource_id(F.col("ResourceId")),
        }
    )
    return cleaned.withColumn("TimeWindow", window_start(F.col("TimeGenerated"), window_minutes))


def preprocess_cost(lines: DataFrame, window_minutes: int = HOUR) -> DataFrame:
    """Typed, null-free cost lines with their time window."""
    return lines.withColumns(
        {
            "UsageDate": billing_timestamp(lines, "UsageDate"),
            "Cost": number_or_zero(F.col("Cost"), "double"),
            "UsageQuantity": number_or_zero(F.col("UsageQuantity"), "double"),
            "CostPerUnit": number_or_zero(F.col("CostPerUnit"), "double"),
            "ResourceId": normalize_resource_id(F.col("ResourceId")),
        }
    ).withColumn("TimeWindow", window_start(F.col("UsageDate"), window_minutes))


def known_only(fact: DataFrame) -> DataFrame:
    return fact.where((F.col("DeviceId") != UNKNOWN) & (F.col("StoreNumber") != UNKNOWN))


def own_store_rows(fact: DataFrame, store: str) -> DataFrame:
    """What the manager of one store may see."""
    return fact.where(F.col("StoreNumber") == store)


def mapped_device_rows(fact: DataFrame, user_devices: DataFrame, user: str) -> DataFrame:
    """What a person may see: the devices mapped to them."""
    devices = user_devices.where(F.col("UserName") == user).select("DeviceId")
    return salted_join(fact, devices, ["DeviceId"], ["TimeWindow", "ResourceId", "MeterName"], "left_semi")


def add_period_columns(fact: DataFrame) -> DataFrame:
    day = F.to_date("TimeWindow")
    return fact.withColumns(
        {
            "CostPerToken": ratio_or_null(F.col("AllocatedCost"), F.col("TokensUsed")),
            "Month": F.trunc(day, "month"),
            "Week": week_start_sunday(day),
        }
    )


def between(rows: DataFrame, time: str, start, end) -> DataFrame:
    """Half-open range of a time column; reaches the scan of the rows."""
    return rows.where((F.col(time) >= moment(start)) & (F.col(time) < moment(end)))


def incremental_range(fact: DataFrame, range_start, range_end) -> DataFrame:
    """Half-open range of time windows."""
    return between(fact, "TimeWindow", range_start, range_end)


def refresh_range(fact: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The last `days` days before `as_of`, the part a refresh re-reads."""
    return lookback_filter(fact, "TimeWindow", as_of, days=days)
