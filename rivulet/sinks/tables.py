"""Sinks that can be run again: a keyed table, and rows written by tasks and published by a commit."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

from rivulet.operators.upsert import latest_per_key
from rivulet.streaming.tables import KeyedTable


def upserts(df: DataFrame, keys: list[str], seq: str, table: KeyedTable) -> DataStreamWriter:
    """Set the keyed table to each micro-batch's last row per key. A micro-batch that is run again changes nothing.

    ``table.before(spark, last micro-batch + 1)`` reads it; that opens a bounded number of folders, not the history.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        table.write(latest_per_key(batch, keys, seq), batch_id)

    return df.writeStream.foreachBatch(each)


@dataclass(frozen=True)
class Context:
    """What a row sink may ask for: the row's event time, the machine's time, the watermark that the row met."""

    event_time: datetime | None
    processing_time: datetime
    watermark: datetime | None


@dataclass
class _Written(WriterCommitMessage):
    result: Any


class _Writer(DataSourceStreamWriter):
    def __init__(self, sink: RowSink):
        self.sink = sink

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        sink = self.sink
        resource = sink.connect()
        try:
            for row in iterator:
                times = [row[c] if c else None for c in (sink.ts, sink.watermark)]
                sink.invoke(resource, row, Context(times[0], datetime.now(timezone.utc), times[1]))
        except BaseException:
            sink.close(resource)
            raise
        return _Written(sink.close(resource))

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.sink.commit([m.result for m in messages if m is not None], batchId)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.sink.abort([m.result for m in messages if m is not None], batchId)


@dataclass(frozen=True)
class RowSink:
    """A sink for single rows. Each task opens a resource, hands every row with its context to ``invoke`` and closes it.

    What ``close`` gives, one result per task, goes to ``commit`` with the number of the micro-batch, on the driver,
    once all tasks have written; a failed micro-batch goes to ``abort``. A sink that only stages rows in its tasks and publishes
    them in ``commit`` under the micro-batch's number has the same content after a micro-batch was run twice.
    """

    connect: Callable[[], Any]
    invoke: Callable[[Any, Row, Context], None]
    close: Callable[[Any], Any]
    commit: Callable[[list[Any], int], None]
    abort: Callable[[list[Any], int], None] = lambda results, batch_id: None
    ts: str | None = None
    watermark: str | None = None

    def writer(self, df: DataFrame) -> DataStreamWriter:
        """The stream's writer, to be started with a checkpoint."""
        sink, label = self, f"rows_{uuid.uuid4().hex}"

        class Source(DataSource):
            @classmethod
            def name(cls) -> str:
                return label

            def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamWriter:
                return _Writer(sink)

        spark: SparkSession = df.sparkSession
        spark.dataSource.register(Source)
        return df.writeStream.format(label)
