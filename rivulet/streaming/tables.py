"""Tables that carry state from one micro-batch to the next."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.operators.upsert import latest_per_key
from rivulet.session import remove_path

BEFORE_ALL = -(2**62)  # arrival number of rows that stand for earlier micro-batches


@contextmanager
def kept(batch: DataFrame) -> Iterator[DataFrame]:
    """A micro-batch that is used several times is read and computed once."""
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def touched(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The state of the keys that a micro-batch has. Null keys are equal."""
    if not keys:
        return state
    met = batch.select(*(F.col(k).alias(f"_met_{i}") for i, k in enumerate(keys))).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_met_{i}")) for i, k in enumerate(keys)]
    return state.join(met, same, "left_semi")


class KeyedTable:
    """The last row per key, as files: a base, and the changes of at most ``every`` micro-batches since.

    A micro-batch writes only the keys that it changes, and opens ``every`` + 1 folders at most,
    however long the stream has run. Each ``every``-th one writes a new base and removes the files
    that no micro-batch can need any more. All folders bear the numbers of their
    micro-batches, so a micro-batch that is run again reads and writes the same.
    """

    def __init__(self, home: str, keys: list[str], every: int = 16, deleted: str | None = None):
        self.home, self.keys, self.every, self.deleted = home, keys, every, deleted

    def _base(self, number: int) -> str:
        return f"{self.home}/base/{number}"

    def _changes(self, batch_id: int) -> str:
        return f"{self.home}/changes/{batch_id}"

    def _merged(self, spark: SparkSession, base: int, upto: int) -> DataFrame | None:
        parts = [spark.read.parquet(self._base(base)).withColumn("_batch", F.lit(-1))] if base else []
        parts += [spark.read.parquet(self._changes(i)).withColumn("_batch", F.lit(i)) for i in range(base, upto)]
        if not parts:
            return None
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        if len(parts) > 1:
            rows = latest_per_key(rows, self.keys, "_batch")
        rows = rows.drop("_batch")
        return rows.where(~F.col(self.deleted)) if self.deleted else rows

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The table as the micro-batches before this one left it; None if there were none."""
        return self._merged(spark, batch_id // self.every * self.every, batch_id)

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """Set the rows of a micro-batch's keys; one row per key."""
        spark = changes.sparkSession
        changes.write.mode("overwrite").parquet(self._changes(batch_id))
        if (batch_id + 1) % self.every:
            return
        base = batch_id + 1 - self.every
        self._merged(spark, base, batch_id + 1).write.mode("overwrite").parquet(self._base(batch_id + 1))
        if base:
            remove_path(spark, self._base(base - self.every))
            for old in range(base - self.every, base):
                remove_path(spark, self._changes(old))
