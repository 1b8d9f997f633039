"""Explicit placement of rows. Aggregations and joins place rows by themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def by_key(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    return df.repartition(partitions, *keys) if partitions else df.repartition(*keys)


def shuffled(df: DataFrame, partitions: int, seed: int = 17) -> DataFrame:
    """Random placement: a seeded hash of the row and of its place among its task's rows, so equal rows spread too.

    The places are those after sorting by the row's hash, so a task that is run again gives its rows the same ones.
    """
    rows = df.withColumn("_hash", F.xxhash64(F.lit(seed), *df.columns)).sortWithinPartitions("_hash")
    rows = rows.withColumn("_place", F.xxhash64("_hash", F.monotonically_increasing_id()))
    return rows.repartition(partitions, "_place").select(*df.columns)


def rebalanced(df: DataFrame, partitions: int) -> DataFrame:
    """Round robin: equal shares whatever the values."""
    return df.repartition(partitions)


def copied(df: DataFrame, consumers: int, out: str = "consumer") -> DataFrame:
    """A full copy of the rows for each of ``consumers``."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(consumers - 1))))


def with_parallelism(df: DataFrame, partitions: int) -> DataFrame:
    """Just so many partitions for the next step: fewer without a shuffle, more by round robin."""
    return df.coalesce(partitions) if partitions <= df.rdd.getNumPartitions() else df.repartition(partitions)


def placed(df: DataFrame, out: str = "subtask") -> DataFrame:
    """The index of the task that handles the row."""
    return df.withColumn(out, F.spark_partition_id())
