"""Unions and joins of two event streams."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.time import interval, micros, span
from rivulet.operators.segments import (
    DEFAULT,
    Order,
    Running,
    Skew,
    heavy,
    running,
    sampled,
)


def union(*streams: DataFrame) -> DataFrame:
    """All rows of streams of one type, duplicates kept."""
    return reduce(DataFrame.unionByName, streams)


def inner_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: tuple[str, str] | None = None,
    skew: Skew = DEFAULT,
    salts: int = 32,
) -> DataFrame:
    """Equi-join. With ``spread_by``, a unique column of each side, hot keys are salted.

    Rows of a key that is hot on one side are spread there over ``salts`` places
    by a hash of that column, and the other side's rows of this key, and only
    these, are copied to all places. A key may be hot on both sides.
    """
    if spread_by is None or left.isStreaming or right.isStreaming:
        return left.join(right, on)
    sides = [left.withColumn("_id", F.xxhash64(*on)), right.withColumn("_id", F.xxhash64(*on))]
    counts = [
        sampled(side, unique, skew).groupBy("_id").agg(F.count(F.lit(1)).alias("n"))
        for side, unique in zip(sides, spread_by)
    ]
    places = F.sequence(F.lit(0), F.lit(salts - 1))
    for i, unique in enumerate(spread_by):
        hot = F.broadcast(heavy(counts[i], ["_id"], skew).withColumn("_hot", F.lit(True)))
        own = F.pmod(F.xxhash64(unique), F.lit(salts)).cast("int")
        for side in (0, 1):
            at = F.array(own) if side == i else places
            flagged = sides[side].join(hot, "_id", "left")
            sides[side] = flagged.withColumn(
                f"_salt{i}", F.explode(F.when(F.col("_hot"), at).otherwise(F.array(F.lit(0))))
            ).drop("_hot")
    joined = sides[0].join(sides[1].drop("_id"), [*on, "_salt0", "_salt1"])
    return joined.drop("_id", "_salt0", "_salt1")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_ts: str,
    right_ts: str,
    lower: timedelta,
    upper: timedelta,
    inclusive: bool = True,
    spread_by: tuple[str, str] | None = None,
    skew: Skew = DEFAULT,
) -> DataFrame:
    """Pairs with equal ``on`` and right time in [left time + lower, left time + upper].

    Time columns must differ in name. In batch, time is cut into bins as long as
    the interval: a left row is in one bin, a right row is copied to the two that
    its partners can be in. So the join key is (on, bin), and a key's rows far
    apart in time never meet. ``spread_by`` salts hot (on, bin), as in ``inner_join``.
    """
    low, high = F.col(left_ts) + interval(lower), F.col(left_ts) + interval(upper)
    at = F.col(right_ts)
    near = (at >= low) & (at <= high) if inclusive else (at > low) & (at < high)
    if left.isStreaming or right.isStreaming:
        other = right.select(*(F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns))
        same = reduce(Column.__and__, [F.col(c) == F.col(f"_r_{c}") for c in on])
        return left.join(other, same & near).drop(*(f"_r_{c}" for c in on))
    width = max(micros(upper - lower), 1)

    def bin_of(us: Column) -> Column:
        return F.floor(us / F.lit(width)).cast("bigint")  # rounds down before 1970 too

    def us(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    binned = left.withColumn("_bin", bin_of(us(left_ts)))
    first, last = bin_of(us(right_ts) - micros(upper)), bin_of(us(right_ts) - micros(lower))
    copied = right.withColumn("_bin", F.explode(F.sequence(first, last)))
    return inner_join(binned, copied, [*on, "_bin"], spread_by, skew).where(near).drop("_bin")


def window_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_ts: str,
    right_ts: str,
    size: timedelta,
    spread_by: tuple[str, str] | None = None,
    skew: Skew = DEFAULT,
) -> DataFrame:
    """Pairs with equal ``on`` that lie in the same tumbling window."""
    one = left.withColumn("_window", F.window(left_ts, span(size)))
    two = right.withColumn("_window", F.window(right_ts, span(size)))
    joined = inner_join(one, two, [*on, "_window"], spread_by, skew)
    return (
        joined.withColumn("window_start", F.col("_window.start"))
        .withColumn("window_end", F.col("_window.end"))
        .drop("_window")
    )


def dynamic_filter(
    rows: DataFrame, queries: DataFrame, field: str, query: str, seq: str, skew: Skew | None = DEFAULT
) -> DataFrame:
    """Rows whose ``field`` equals the latest query at their arrival; none before the first query.

    Both inputs share the arrival order ``seq``. The latest query is a running
    value over the united rows, so neither side has to fit in memory.
    """
    asked = queries.select(F.col(seq), F.col(query).alias("_query"), F.lit(True).alias("_asks"))
    united = rows.withColumn("_asks", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    seen = running(united, [], Order(seq), [Running("_latest", "last", "_query")], skew)
    return seen.where(~F.col("_asks") & (F.col(field) == F.col("_latest"))).select(*rows.columns)


def reconcile(
    left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, limit: timedelta
) -> DataFrame:
    """Match two sides by a key that is unique on each.

    ``matched`` when the times are at most ``limit`` apart, whichever came
    first; otherwise each side present fails on its own, as ``no_right`` or
    ``no_left``, with ``limit`` gone by.
    """
    both = left.select(*on, left_ts).join(right.select(*on, right_ts), on, "full")
    a, b = F.col(left_ts), F.col(right_ts)
    close = a.isNotNull() & b.isNotNull() & (a <= b + interval(limit)) & (b <= a + interval(limit))
    alone = F.array_compact(
        F.array(F.when(a.isNotNull(), F.lit("no_right")), F.when(b.isNotNull(), F.lit("no_left")))
    )
    spread = both.withColumn("status", F.explode(F.when(close, F.array(F.lit("matched"))).otherwise(alone)))
    return spread.select(
        *on,
        "status",
        F.when(F.col("status") != "no_left", a).alias(left_ts),
        F.when(F.col("status") != "no_right", b).alias(right_ts),
    )
