"""Event-time arithmetic on whole microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def floor_div(value: Column, divisor: int) -> Column:
    """Integer division towards minus infinity, without a detour over double."""
    return F.call_function("div", value - F.pmod(value, F.lit(divisor)), F.lit(divisor))


def discretize(timestamp: Column, fps: int) -> Column:
    """The start of the 1/fps second slot, in integers because 1/15 s has no exact double."""
    slot = floor_div(F.unix_micros(timestamp) * F.lit(fps), MICROS)
    return F.timestamp_micros(floor_div(slot * F.lit(MICROS), fps))


def value_bucket(value: Column, size: float) -> Column:
    return (value / F.lit(size)).cast("int")


def sinusoid(t_millis: Column, low: float, high: float, period_millis: float, offset_millis: float) -> Column:
    """The daily curve a temperature sensor is expected to follow."""
    phase = F.lit(2.0) * F.pi() * (t_millis - F.lit(offset_millis)) / F.lit(period_millis)
    return F.lit(high - low) * (F.lit(0.5) * F.sin(phase) + F.lit(0.5)) + F.lit(low)
