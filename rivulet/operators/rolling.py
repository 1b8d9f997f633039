"""Rolling keyed aggregates: one output row per input row, holding the value so far."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.rows import ratio
from rivulet.operators.segments import DEFAULT, Order, Running, Skew, running


def rolling_count(
    df: DataFrame, keys: list[str], seq: str, out: str = "count", skew: Skew | None = DEFAULT
) -> DataFrame:
    return running(df, keys, Order(seq), [Running(out, "count")], skew)


def rolling_sum(
    df: DataFrame, keys: list[str], value: Column | str, seq: str, out: str = "sum", skew: Skew | None = DEFAULT
) -> DataFrame:
    return running(df, keys, Order(seq), [Running(out, "sum", value)], skew)


def rolling_max(
    df: DataFrame, keys: list[str], value: Column | str, seq: str, out: str = "max", skew: Skew | None = DEFAULT
) -> DataFrame:
    return running(df, keys, Order(seq), [Running(out, "max", value)], skew)


def rolling_average(
    df: DataFrame, keys: list[str], value: Column | str, seq: str, out: str = "average", skew: Skew | None = DEFAULT
) -> DataFrame:
    """Mean of all values so far, kept as (sum, count). Without keys: over the whole stream."""
    summed = running(df, keys, Order(seq), [Running("_sum", "sum", value), Running("_count", "count", value)], skew)
    return summed.withColumn(out, ratio(F.col("_sum"), F.col("_count"))).drop("_sum", "_count")


def running_mean_views(
    df: DataFrame, user: str, seq: str, by: list[str] | None = None, skew: Skew | None = DEFAULT
) -> DataFrame:
    """Rows so far / distinct users so far.

    A user's first row adds a marker just before it, so both counts are plain
    running sums and no set of users is held anywhere. ``seq`` is an integer.
    """
    by = by or []
    rows = df.select("*", F.lit(1).alias("_row"), F.lit(0).alias("_new"), (F.col(seq) * 2 + 1).alias("_place"))
    markers = (
        df.groupBy(*by, user)
        .agg(F.min(seq).alias("_first"))
        .select(*by, F.lit(0).alias("_row"), F.lit(1).alias("_new"), (F.col("_first") * 2).alias("_place"))
    )
    counted = running(
        rows.unionByName(markers, allowMissingColumns=True),
        by,
        Order("_place"),
        [Running("views", "sum", "_row"), Running("users", "sum", "_new")],
        skew,
    )
    return (
        counted.where(F.col("_row") == 1)
        .withColumn("mean_views", ratio(F.col("views"), F.col("users")))
        .select(*df.columns, "views", "users", "mean_views")
    )


def word_counts(words: DataFrame, word: str = "word") -> DataFrame:
    """Final count per word; on a stream, one updated row per word and micro-batch."""
    return words.groupBy(word).agg(F.count(F.lit(1)).alias("count"))
