"""Unique visitors per window, exact and by sketches."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from rivulet.functions.time import span
from rivulet.operators.windows import tumbling


def unique_visitors(df: DataFrame, ts: str, user: str, size: timedelta) -> DataFrame:
    """Exact. On a stream (with a watermark) users are made distinct per window, then counted."""
    if not df.isStreaming:
        return tumbling(df, ts, size, visitors=F.count_distinct(user))
    seen = df.select(F.window(ts, span(size)).alias("w"), user).dropDuplicates(["w", user])
    counted = seen.groupBy(F.window(F.window_time("w"), span(size))).agg(F.count(F.lit(1)).alias("visitors"))
    return counted.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "visitors"
    )


def approx_unique_visitors(df: DataFrame, ts: str, user: str, size: timedelta, error: float = 0.02) -> DataFrame:
    """HyperLogLog; ``error`` is the relative standard deviation."""
    return tumbling(df, ts, size, visitors=F.approx_count_distinct(user, error))


def sketch_size(error: float) -> int:
    """Logarithm of the registers that a sketch needs for a relative standard deviation of ``error``."""
    if not 0.0006 <= error <= 0.2:
        raise ValueError("error must be between 0.0006 and 0.2")
    return max(4, math.ceil(2 * math.log2(1.04 / error)))


def sketch_unique_visitors(
    df: DataFrame, ts: str, user: str, size: timedelta, slide: timedelta | None = None, error: float = 0.02
) -> DataFrame:
    """Visitors per window from sketches of a size that follows from ``error``, the relative standard deviation.

    One sketch is made per pane of ``slide``; a window's is the union of those of its panes, so rows are not copied.
    """
    lg, slide = sketch_size(error), slide or size
    panes = df.groupBy(F.window(ts, span(slide)).alias("p")).agg(F.hll_sketch_agg(user, lg).alias("sketch"))
    windows = panes.select(F.window("p.start", span(size), span(slide)).alias("w"), "sketch")
    merged = windows.groupBy("w").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("visitors"))
    return merged.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "visitors")


def bloom_size(items: int, error: float) -> tuple[int, int]:
    """Bits and hash functions of a Bloom filter for ``items`` at false-positive rate ``error``."""
    bits = int(-items * math.log(error) / math.log(2) ** 2)
    return bits, max(1, round(bits / items * math.log(2)))


def bloom_positions(df: DataFrame, value: str, bits: int, hashes: int, out: str = "position") -> DataFrame:
    """A row per bit of ``value``, by double hashing: two 32-bit parts of an MD5 digest."""
    halves = df.withColumn("_digest", F.md5(F.col(value).cast("string")))
    for name, at in (("_one", 1), ("_two", 9)):
        halves = halves.withColumn(name, F.conv(F.substring("_digest", at, 8), 16, 10).cast("bigint"))
    turns = halves.withColumn("_turn", F.explode(F.array(*(F.lit(i).cast("bigint") for i in range(hashes)))))
    position = (F.col("_one") + F.col("_turn") * F.col("_two")) % bits
    return turns.withColumn(out, position).drop("_digest", "_one", "_two", "_turn")


def bloom_unique_visitors(
    df: DataFrame, ts: str, user: str, size: timedelta, items: int = 100_000, error: float = 0.01
) -> DataFrame:
    """Visitors estimated from how full a Bloom filter of the window's users is.

    The filter is a set of bitmaps of 32768 bits, one aggregate each, so map
    tasks send at most ``bits / 8`` bytes per window and filters of different
    tasks merge by OR. ``visitors`` = -bits/hashes * ln(1 - set/bits). A window with more than ``items``
    visitors is more than the filter was made for: that is an error, not a wrong number.
    """
    bits, hashes = bloom_size(items, error)
    users = bloom_positions(df.select(F.window(ts, span(size)).alias("w"), user), user, bits, hashes, "p")
    maps = users.groupBy("w", F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("p"))).alias("ones")
    )
    filled = maps.groupBy("w").agg(F.sum("ones").alias("bits_set"))
    estimate = F.round(-F.lit(bits / hashes) * F.ln(1 - F.col("bits_set") / F.lit(bits))).cast("bigint")
    full = F.lit(f"a window has more than {items} visitors: make its filter larger")
    estimate = F.when(
        (F.col("bits_set") >= bits) | (estimate > items), F.raise_error(full).cast("bigint")
    ).otherwise(estimate)
    return filled.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "bits_set",
        estimate.alias("visitors"),
    )
