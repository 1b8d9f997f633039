"""Counts per time window. The same functions take batch and streaming DataFrames."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.time import micros, span


def _bounds(df: DataFrame, window: str = "window") -> list[Column]:
    return [F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end")]


def tumbling(
    df: DataFrame, ts: str, size: timedelta, keys: list[str] | None = None, **aggregates: Column
) -> DataFrame:
    """Aggregates per key and tumbling window; a row count if none is named."""
    keys = keys or []
    aggregates = aggregates or {"count": F.count(F.lit(1))}
    grouped = df.groupBy(F.window(ts, span(size)), *keys).agg(*(c.alias(n) for n, c in aggregates.items()))
    return grouped.select(*keys, *_bounds(grouped), *aggregates)


def tumbling_counts_only(df: DataFrame, ts: str, size: timedelta, keys: list[str]) -> DataFrame:
    """Window counts without the window they belong to."""
    return tumbling(df, ts, size, keys).select(*keys, "count")


def sliding_counts(
    df: DataFrame, ts: str, size: timedelta, slide: timedelta, keys: list[str] | None = None
) -> DataFrame:
    """Row count per key and sliding window; windows overlap when ``slide < size``.

    In batch the rows are first counted per pane, the longest step that divides
    both size and slide. Only pane counts, not rows, are copied to the
    size/slide windows they lie in.
    """
    keys = keys or []
    if df.isStreaming:
        grouped = df.groupBy(F.window(ts, span(size), span(slide)), *keys).agg(F.count(F.lit(1)).alias("count"))
        return grouped.select(*keys, *_bounds(grouped), "count")
    pane = timedelta(microseconds=math.gcd(micros(size), micros(slide)))
    panes = df.groupBy(F.window(ts, span(pane)).alias("pane"), *keys).agg(F.count(F.lit(1)).alias("_n"))
    panes = panes.select(*keys, F.col("pane.start").alias("_at"), "_n")
    grouped = panes.groupBy(F.window("_at", span(size), span(slide)), *keys).agg(F.sum("_n").alias("count"))
    return grouped.select(*keys, *_bounds(grouped), "count")


def arrival_windows(df: DataFrame, size: timedelta, keys: list[str], arrival: str | None = None) -> DataFrame:
    """Processing-time windows: on the machine clock for a stream, on ``arrival`` in batch."""
    if arrival is None:
        if not df.isStreaming:
            raise ValueError("a batch needs the column that holds the arrival time")
        arrival, df = "_arrival", df.withColumn("_arrival", F.current_timestamp())
    return tumbling(df, arrival, size, keys)
