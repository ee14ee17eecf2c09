"""Time windows, clock parts and ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Working hours (both ends count) and shift starts.
BUSINESS_HOURS = (9, 17)
MORNING_FROM, EVENING_FROM, NIGHT_FROM = 6, 14, 22


def moment(as_of: dt.datetime | str) -> Column:
    return F.lit(str(as_of)).cast("timestamp")


def window_start(ts: Column, minutes: int) -> Column:
    """Epoch-aligned start of the window that holds `ts`."""
    return F.window(ts, f"{minutes} minutes")["start"]


def age_hours(ts: Column, as_of: Column) -> Column:
    return (F.unix_micros(as_of) - F.unix_micros(ts)) / F.lit(3.6e9)


def recency_weight(ts: Column, as_of: Column, decay_hours: float) -> Column:
    """exp(-age/decay): 1/e after `decay_hours`."""
    return F.exp(-age_hours(ts, as_of) / F.lit(float(decay_hours)))


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def is_weekday(ts: Column) -> Column:
    return F.weekday(ts) < 5


def is_business_hour(hour: Column) -> Column:
    return hour.between(*BUSINESS_HOURS)


def shift(hour: Column) -> Column:
    return (
        F.when(hour.between(MORNING_FROM, EVENING_FROM - 1), "Morning")
        .when(hour.between(EVENING_FROM, NIGHT_FROM - 1), "Evening")
        .otherwise("Night")
    )


def week_start_sunday(day: Column) -> Column:
    return F.date_sub(F.next_day(day, "SUN"), 7)


def billing_timestamp(rows: DataFrame, name: str) -> Column:
    """A billing date as UTC time: a time, a date, ISO text, or a yyyyMMdd number."""
    c, kind = F.col(name), rows.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return c
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return c.cast("timestamp")
    text = c.cast("string")
    if isinstance(kind, T.IntegralType):
        return F.try_to_timestamp(text, F.lit("yyyyMMdd"))
    return F.when(
        text.rlike(r"^[0-9]{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd"))
    ).otherwise(F.try_to_timestamp(text))
