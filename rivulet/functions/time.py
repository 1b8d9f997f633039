"""Durations and event-time columns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F


def micros(length: timedelta) -> int:
    return length // timedelta(microseconds=1)


def interval(length: timedelta) -> Column:
    """The duration as a day-time interval literal."""
    return F.expr(f"INTERVAL '{micros(length)}' MICROSECONDS")


def span(length: timedelta) -> str:
    """The duration as ``window()`` spells it."""
    return f"{micros(length)} microseconds"


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def millis_text(ms: Column, pattern: str = "yyyy-MM-dd HH:mm:ss.SSS") -> Column:
    """Epoch milliseconds as display text in the session's time zone."""
    return F.date_format(F.timestamp_millis(ms), pattern)


def window_start_millis(ms: Column, size: timedelta) -> Column:
    """Start of the tumbling window that holds ``ms``, by integer arithmetic."""
    return ms - F.pmod(ms, F.lit(micros(size) // 1000))
