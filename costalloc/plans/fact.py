"""From telemetry and billing rows to the allocated fact."""

from __future__ import annotations

from pyspark.sql import DataFrame

from costalloc.operators.cleanse import HOUR, preprocess_cost, preprocess_telemetry
from costalloc.operators.correlate import CONSERVING, allocate, finish_fact, usage_by_window
from costalloc.sources.billing import model_services, normalize_cost

DECAY_HOURS = 2.0


def windowed_usage(telemetry: DataFrame, window_minutes: int = HOUR, decay_hours: float | None = None) -> DataFrame:
    return usage_by_window(preprocess_telemetry(telemetry, window_minutes), window_minutes, decay_hours)


def windowed_cost(billing: DataFrame, window_minutes: int = HOUR) -> DataFrame:
    """Cost lines of the services that are split, with their time window."""
    return preprocess_cost(normalize_cost(model_services(billing)), window_minutes)


def allocated_costs(
    telemetry: DataFrame,
    billing: DataFrame,
    method: str = "proportional",
    mode: str = CONSERVING,
    window_minutes: int = HOUR,
    by_day: bool = False,
    in_order: bool = False,
) -> DataFrame:
    decay = DECAY_HOURS if method == "time-weighted" else None
    usage = windowed_usage(telemetry, window_minutes, decay)
    return allocate(usage, windowed_cost(billing, window_minutes), method, mode, by_day, in_order)


def correlated_fact(
    telemetry: DataFrame,
    billing: DataFrame,
    as_of,
    method: str = "proportional",
    mode: str = CONSERVING,
    window_minutes: int = HOUR,
    by_day: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """The allocated fact: cost of every device and store per window, resource and meter.

    by_day: its rows come dealt by day, as a store by day wants them. in_order: each task's rows come in STORED_ORDER.
    """
    return finish_fact(allocated_costs(telemetry, billing, method, mode, window_minutes, by_day, in_order), as_of)
