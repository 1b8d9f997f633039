"""Watermarks as columns, and what becomes of late rows.

A row sees the watermark of the rows that arrived before it: the largest event
time so far, less the allowed disorder, less one millisecond. Arrival order is
the unique integer column ``seq``; no watermark yet means not late.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.time import interval, span
from rivulet.operators.segments import DEFAULT, Order, Running, Skew, running

TICK = timedelta(milliseconds=1)


def with_watermark(
    df: DataFrame, ts: str, seq: str, bound: timedelta, out: str = "watermark", skew: Skew | None = DEFAULT
) -> DataFrame:
    """Bounded disorder; ``bound`` zero means ascending event times."""
    seen = running(df, [], Order(seq), [Running("_seen", "max", ts, before=True)], skew)
    return seen.withColumn(out, F.col("_seen") - interval(bound + TICK)).drop("_seen")


def with_punctuated_watermark(
    df: DataFrame, seq: str, is_mark: Column, mark: str, out: str = "watermark", skew: Skew | None = DEFAULT
) -> DataFrame:
    """Watermarks that stand in the input as rows of their own; they leave the result."""
    seen = running(
        df.withColumn("_mark", F.coalesce(is_mark, F.lit(False))),
        [],
        Order(seq),
        [Running(out, "max", F.when(F.col("_mark"), F.col(mark)), before=True)],
        skew,
    )
    return seen.where(~F.col("_mark")).drop("_mark")


def with_union_watermark(
    df: DataFrame,
    ts: str,
    seq: str,
    bound: timedelta,
    source: str,
    sources: list[str],
    out: str = "watermark",
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Watermark of united inputs: the least of theirs, none while an input has none."""
    marks = [f"_seen{i}" for i in range(len(sources))]
    seen = running(
        df,
        [],
        Order(seq),
        [Running(m, "max", F.when(F.col(source) == s, F.col(ts)), before=True) for m, s in zip(marks, sources)],
        skew,
    )
    complete = F.lit(True)
    for m in marks:
        complete = complete & F.col(m).isNotNull()
    least = F.least(*marks) if len(marks) > 1 else F.col(marks[0])
    return seen.withColumn(out, F.when(complete, least - interval(bound + TICK))).drop(*marks)


def tag_late(df: DataFrame, ts: str, watermark: str = "watermark", out: str = "late") -> DataFrame:
    """Late means strictly older than the watermark."""
    return df.withColumn(out, F.coalesce(F.col(ts) < F.col(watermark), F.lit(False)))


def route_late(df: DataFrame, ts: str, watermark: str = "watermark") -> DataFrame:
    """Rows with their output, ``main`` or ``late``; ``outputs`` splits them."""
    late = tag_late(df, ts, watermark, "_late")
    return late.withColumn("output", F.when(F.col("_late"), "late").otherwise("main")).drop("_late")


def outputs(df: DataFrame, *names: str, column: str = "output") -> list[DataFrame]:
    return [df.where(F.col(column) == name).drop(column) for name in names]


def window_arrivals(
    df: DataFrame,
    ts: str,
    size: timedelta,
    lateness: timedelta = timedelta(0),
    watermark: str = "watermark",
    out: str = "arrival",
) -> DataFrame:
    """Rows with their tumbling window and, in the column ``out``, how they met it.

    ``on_time``: the window had not fired. ``late``: it had, but was still kept
    for ``lateness``. ``dropped``: it was gone; a side output takes these.
    """
    wm, last = F.col(watermark), F.col("window_end") - interval(TICK)
    return (
        df.withColumn("_window", F.window(ts, span(size)))
        .withColumn("window_start", F.col("_window.start"))
        .withColumn("window_end", F.col("_window.end"))
        .drop("_window")
        .withColumn(
            out,
            F.when(wm.isNull() | (last > wm), "on_time")
            .when(last + interval(lateness) > wm, "late")
            .otherwise("dropped"),
        )
    )


def window_firings(
    arrivals: DataFrame, keys: list[str], seq: str, skew: Skew | None = DEFAULT
) -> DataFrame:
    """Every firing of every window: the first with all rows on time, then one per late row.

    Columns: keys, window bounds, ``firing`` (1, 2, ..), ``first``, ``count``.
    Rows on time are counted before they meet the late ones, so only late rows
    are put in order.
    """
    group = [*keys, "window_start", "window_end"]
    on_time = (
        arrivals.where(F.col("arrival") == "on_time")
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(seq).alias("_place"))
    )
    late = arrivals.where(F.col("arrival") == "late").select(
        *group, F.lit(1).cast("bigint").alias("_n"), F.col(seq).alias("_place")
    )
    fired = running(
        on_time.unionByName(late),
        group,
        Order("_place"),
        [Running("count", "sum", "_n"), Running("firing", "count")],
        skew,
    )
    return fired.select(*group, "firing", (F.col("firing") == 1).alias("first"), "count")
