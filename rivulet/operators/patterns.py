"""Ordered event patterns per key. Rows are in order of ``ts``, ties by the unique ``seq``."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.time import interval
from rivulet.operators.segments import DEFAULT, Order, Skew, neighbours


def strict_sequence(
    df: DataFrame,
    keys: list[str],
    ts: str,
    seq: str,
    steps: dict[str, Column],
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Matches of conditions that hold on consecutive rows of a key; matches may overlap.

    ``steps`` maps a step's name to its condition. Columns: keys and, per step,
    ``<name>_ts``.
    """
    names = list(steps)
    rows = df.select(*keys, ts, seq, *(c.alias(f"_is_{n}") for n, c in steps.items()))
    wanted: dict[str, tuple[str, int]] = {}
    for i, n in enumerate(names[1:], start=1):
        wanted[f"_then_{n}"] = (f"_is_{n}", i)
        wanted[f"{n}_ts"] = (ts, i)
    near = neighbours(rows, keys, Order(seq, ts), wanted, skew) if wanted else rows
    match = F.col(f"_is_{names[0]}")
    for n in names[1:]:
        match = match & F.coalesce(f"_then_{n}", F.lit(False))
    return near.where(match).select(*keys, F.col(ts).alias(f"{names[0]}_ts"), *(f"{n}_ts" for n in names[1:]))


def repeated(
    df: DataFrame,
    keys: list[str],
    ts: str,
    seq: str,
    condition: Column,
    names: list[str],
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """``len(names)`` rows that meet one condition, other rows between them allowed."""
    chosen = df.where(condition)
    return strict_sequence(chosen, keys, ts, seq, {n: F.lit(True) for n in names}, skew)


def followed_within(
    df: DataFrame,
    keys: list[str],
    ts: str,
    seq: str,
    first: Column,
    then: Column,
    limit: timedelta,
    at_limit: bool = False,
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """``first`` directly followed by ``then`` in less than ``limit``.

    Columns: keys, ``first_ts``, ``then_ts``, ``output``: ``match``, or
    ``timeout`` if no row came in time. A first row whose next row comes in time
    but is another event gives nothing. With ``at_limit`` a row exactly at the
    limit still counts as in time.
    """
    rows = df.select(*keys, ts, seq, first.alias("_first"), then.alias("_then"))
    near = neighbours(rows, keys, Order(seq, ts), {"_next_ts": (ts, 1), "_next_is": ("_then", 1)}, skew)
    end = F.col(ts) + interval(limit)
    in_time = F.coalesce(F.col("_next_ts") <= end if at_limit else F.col("_next_ts") < end, F.lit(False))
    output = F.when(~in_time, "timeout").when(F.col("_next_is"), "match")
    return (
        near.where("_first")
        .withColumn("output", output)
        .where(F.col("output").isNotNull())
        .select(
            *keys,
            F.col(ts).alias("first_ts"),
            F.when(F.col("output") == "match", F.col("_next_ts")).alias("then_ts"),
            "output",
        )
    )
