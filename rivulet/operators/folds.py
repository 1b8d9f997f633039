"""User-defined aggregates, for what the built-in ones cannot say.

Spark merges partial accumulators, so ``merge`` has to be real.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from rivulet.functions.time import span
from rivulet.operators.keys import WHOLE, packed, unpacked

Accumulator = list[int]


def user_aggregate(
    df: DataFrame,
    keys: list[str],
    value: str,
    create: Callable[[], Accumulator],
    add: Callable[[Accumulator, object], Accumulator],
    merge: Callable[[Accumulator, Accumulator], Accumulator],
    held: int = 100_000,
    shares: int = 64,
    frame_rows: int = 10_000,
) -> DataFrame:
    """Fold ``value`` per key into an accumulator of integers, column ``accumulator``; a null comes to ``add`` as None.

    Map tasks fold as they read, holding at most ``held`` accumulators, so no
    group of rows is ever shuffled; then accumulators are merged, first within
    ``shares`` per key, then per key, in order of their keys: a task holds one accumulator
    and a frame of merged ones, and many small keys cost no more than their rows.
    """
    numbers = T.ArrayType(T.LongType())
    own_fields = [df.schema[k] for k in keys]
    whole = isinstance(df.schema[value].dataType, WHOLE)
    given = df.select(*keys, F.col(value).alias("_value"), F.col(value).isNull().alias("_absent"))
    if whole:  # nulls would make floats of the others
        given = given.withColumn("_value", F.coalesce("_value", F.lit(0)))
    given, keys = packed(given, keys)
    key_fields = [given.schema[k] for k in keys]
    partial_schema = T.StructType([*key_fields, T.StructField("accumulator", numbers)])

    def frame(groups: list[tuple], accumulators: list[Accumulator]) -> pd.DataFrame:
        out = pd.DataFrame(groups, columns=keys)
        out["accumulator"] = accumulators
        return out

    def groups_of(pdf: pd.DataFrame) -> Iterator[tuple]:
        return zip(*(pdf[k].tolist() for k in keys))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_keys: dict[tuple, Accumulator] = {}
        for pdf in batches:
            values = pdf["_value"].tolist()
            if pdf["_absent"].any():
                values = [None if absent else v for v, absent in zip(values, pdf["_absent"])]
            for group, v in zip(groups_of(pdf), values):
                open_keys[group] = add(open_keys[group] if group in open_keys else create(), v)
            if len(open_keys) >= held:
                yield frame(list(open_keys), list(open_keys.values()))
                open_keys = {}
        if open_keys:
            yield frame(list(open_keys), list(open_keys.values()))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups: list[tuple] = []
        merged: list[Accumulator] = []
        for pdf in batches:
            for group, numbers in zip(groups_of(pdf), pdf["accumulator"]):
                accumulator = [int(v) for v in numbers]
                if groups and all(a == b or (a != a and b != b) for a, b in zip(group, groups[-1])):  # NaN is one key
                    merged[-1] = merge(merged[-1], accumulator)
                    continue
                if len(groups) >= frame_rows:
                    yield frame(groups, merged)
                    groups, merged = [], []
                groups.append(group)
                merged.append(accumulator)
        if groups:
            yield frame(groups, merged)

    def joined(rows: DataFrame, by: list[str]) -> DataFrame:
        """Partial accumulators of equal ``by``, which lie side by side, merged."""
        return rows.repartition(*by).sortWithinPartitions(*by).select(*keys, "accumulator").mapInPandas(join, partial_schema)

    partial = given.mapInPandas(fold, partial_schema)
    partial = partial.withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(shares)))
    merged = joined(joined(partial, [*keys, "_share"]), keys)
    return merged.select(*unpacked(merged, own_fields), "accumulator")


def window_fold(
    df: DataFrame,
    ts: str,
    size: timedelta,
    keys: list[str],
    value: str,
    create: Callable[[], Accumulator],
    add: Callable[[Accumulator, object], Accumulator],
    merge: Callable[[Accumulator, Accumulator], Accumulator],
) -> DataFrame:
    """A user's function over all values of a key's tumbling window, folded instead of collected."""
    placed = df.withColumn("_window", F.window(ts, span(size))).select(
        *keys, F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), value
    )
    return user_aggregate(placed, [*keys, "window_start", "window_end"], value, create, add, merge)
