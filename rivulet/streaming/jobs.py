"""Streaming forms of the windowed and joined operators."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from rivulet.functions.time import span
from rivulet.operators import distinct, joins, ranking, windows


def watermarked(df: DataFrame, ts: str, delay: timedelta = timedelta(0)) -> DataFrame:
    """Declare event time. A delay of zero says that times only ascend."""
    return df.withWatermark(ts, span(delay))


def tumbling_counts(df: DataFrame, ts: str, size: timedelta, delay: timedelta, keys: list[str]) -> DataFrame:
    return windows.tumbling(watermarked(df, ts, delay), ts, size, keys)


def sliding_counts(
    df: DataFrame, ts: str, size: timedelta, slide: timedelta, delay: timedelta, keys: list[str]
) -> DataFrame:
    return windows.sliding_counts(watermarked(df, ts, delay), ts, size, slide, keys)


def hot_items(
    df: DataFrame,
    item: str,
    ts: str,
    size: timedelta,
    slide: timedelta,
    delay: timedelta,
    write: Callable[[DataFrame, int], None],
    n: int = 3,
) -> DataStreamWriter:
    """Top items of the windows that have closed, as a job to be started: ``write`` gets those of each micro-batch.

    In append mode all items of a window come out in the one micro-batch that
    closes it, so ranking that batch ranks the window.
    """
    counts = sliding_counts(df, ts, size, slide, delay, [item])

    def each(batch: DataFrame, batch_id: int) -> None:
        write(ranking.top_n(batch, n, ["window_start", "window_end"], tie=item), batch_id)

    return counts.writeStream.outputMode("append").foreachBatch(each)


def unique_visitors(df: DataFrame, ts: str, user: str, size: timedelta, delay: timedelta) -> DataFrame:
    return distinct.unique_visitors(watermarked(df, ts, delay), ts, user, size)


def inner_join(
    left: DataFrame, right: DataFrame, on: list[str], by: tuple[str, str] | None = None, grid: tuple[int, int] = (1, 1)
) -> DataFrame:
    """All pairs of two streams with equal keys, each once both rows are there. Both sides stay in the state.

    Streams cannot be counted beforehand, so with ``by``, a column of each side, all keys are spread alike over a ``grid``:
    a left row has a row of it and is copied along that, a right row a column, and a pair meets where they cross.
    """
    if by is None or grid == (1, 1):
        return left.join(right, on)
    places = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in grid]
    own = [F.pmod(F.xxhash64(column), F.lit(n)).cast("int") for column, n in zip(by, grid)]
    left = left.withColumn("_one", own[0]).withColumn("_two", places[1])
    right = right.withColumn("_two", own[1]).withColumn("_one", places[0])
    return left.join(right, [*on, "_one", "_two"]).drop("_one", "_two")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_ts: str,
    right_ts: str,
    lower: timedelta,
    upper: timedelta,
    delay: timedelta,
) -> DataFrame:
    """Both sides have watermarks, so Spark drops rows whose partners can no longer come."""
    return joins.interval_join(
        watermarked(left, left_ts, delay), watermarked(right, right_ts, delay), on, left_ts, right_ts, lower, upper
    )


def window_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_ts: str,
    right_ts: str,
    size: timedelta,
    delay: timedelta,
) -> DataFrame:
    return joins.window_join(
        watermarked(left, left_ts, delay), watermarked(right, right_ts, delay), on, left_ts, right_ts, size
    )


def union_counts(streams: list[DataFrame], ts: str, size: timedelta, delay: timedelta) -> DataFrame:
    """Window counts over united streams. Each has its watermark; the slowest one rules, as the session must say."""
    if streams[0].sparkSession.conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min") != "min":
        raise ValueError("spark.sql.streaming.multipleWatermarkPolicy must be min: the slowest stream rules")
    united = joins.union(*(watermarked(s, ts, delay) for s in streams))
    return windows.tumbling(united, ts, size)


def group_counts(df: DataFrame, keys: list[str], counted: str) -> DataFrame:
    """``COUNT(counted) GROUP BY keys`` without windows, to be run in update mode."""
    return df.groupBy(*keys).agg(F.count(counted).alias("count"))
