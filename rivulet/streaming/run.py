"""Starting streams, and running one over the data that is there."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rivulet.session import ROCKSDB, scratch_path


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """RocksDB state. Its partitions are as many as ``spark.sql.shuffle.partitions`` says when a checkpoint begins."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _filler(kind: T.DataType) -> int | None:
    return -1 if isinstance(kind, T.NumericType) else None


class Ending:
    """Ends a stream whose input is used up: one last row (-1 and null) at a time far in the future lets the watermark pass all others.

    The row is written once everything before it has been read, and never comes out itself.
    """

    TIME = datetime(2200, 1, 1)  # the workers hold times as 64-bit nanoseconds

    def __init__(self, spark: SparkSession, ts: str = "ts"):
        self.spark, self.ts = spark, ts
        self.home = scratch_path(spark, "ending")
        self.rows: dict[str, DataFrame] = {}

    def after(self, stream: DataFrame) -> DataFrame:
        """The stream with its last row to come."""
        path = f"{self.home}/{len(self.rows)}"
        fields = {f.name: f.dataType for f in stream.schema.fields}
        last = [F.lit(self.TIME if n == self.ts else _filler(t)).cast(t).alias(n) for n, t in fields.items()]
        self.rows[path] = self.spark.range(1).select(*last)
        self.rows[path].limit(0).write.parquet(path)
        return stream.unionByName(self.spark.readStream.schema(stream.schema).parquet(path))

    def write(self) -> None:
        for path, row in self.rows.items():
            row.write.mode("append").parquet(path)


def start(writer: DataStreamWriter, checkpoint: str, every: str = "10 seconds") -> StreamingQuery:
    """Start a stream that keeps its progress and state in ``checkpoint``, one micro-batch per interval."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def run_available(writer: DataStreamWriter, checkpoint: str, end: Ending | None = None) -> None:
    """Run over what is there now, then stop; with ``end``, the input has ended there."""
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.start().awaitTermination()
    if end is not None:
        end.write()
        writer.start().awaitTermination()


def drained(
    df: DataFrame,
    label: str,
    mode: str = "append",
    each: Callable[[DataFrame], DataFrame] | None = None,
    end: Ending | None = None,
) -> DataFrame:
    """A stream's output over the data that is there, as a table.

    Micro-batches go to parquet files in the shared scratch folder, never
    through the driver. With ``end`` all windows and timers come out. ``each`` maps a micro-batch before it is written. In
    update mode the column ``batch_id`` tells later rows of a key from earlier.
    """
    spark = df.sparkSession
    home = scratch_path(spark, label)
    out = f"{home}/out"
    with state_settings(spark):
        if each is None and mode == "append":
            run_available(df.writeStream.format("parquet").option("path", out), f"{home}/checkpoint", end)
            return spark.read.schema(df.schema).parquet(out)

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = each(batch) if each else batch
            rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        run_available(df.writeStream.outputMode(mode).foreachBatch(write), f"{home}/checkpoint", end)
    result = spark.read.parquet(out)
    return result if mode != "append" else result.drop("batch_id")


def last_update(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The current rows of an update stream that ``drained`` wrote."""
    others = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_row"))
    return newest.select(*keys, "_row.*")
