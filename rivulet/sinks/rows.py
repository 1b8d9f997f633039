"""Sinks written row by row, printing, and sinks with two outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rivulet.functions.rows import labelled


def printed(df: DataFrame, label: str | None = None, mode: str = "append") -> DataStreamWriter:
    """A stream's rows on the console, with a prefix column if wanted."""
    shown = labelled(df, label) if label else df
    return shown.writeStream.format("console").option("truncate", "false").outputMode(mode)


def with_context(batch: DataFrame, query: StreamingQuery | None, ts: str | None = None) -> DataFrame:
    """A micro-batch with what a row sink may ask for: its event time, the machine time, the watermark."""
    progress = query.lastProgress if query is not None else None
    watermark = ((progress or {}).get("eventTime") or {}).get("watermark")
    return batch.select(
        "*",
        (F.col(ts) if ts else F.lit(None).cast("timestamp")).alias("event_time"),
        F.current_timestamp().alias("processing_time"),
        F.lit(watermark).cast("timestamp").alias("watermark"),
    )


def partition_writer(
    connect: Callable[[], Any], invoke: Callable[[Any, Row], None], close: Callable[[Any], None]
) -> Callable[[Iterable[Row]], None]:
    """For ``foreachPartition``: one resource per task, closed whatever happens."""

    def write(rows: Iterable[Row]) -> None:
        resource = connect()
        try:
            for row in rows:
                invoke(resource, row)
        finally:
            close(resource)

    return write


def two_outputs(
    df: DataFrame, main: Callable[[DataFrame, int], None], side: Callable[[DataFrame, int], None], tag: str = "output"
) -> DataStreamWriter:
    """One stream, two sinks: rows tagged ``main``, and all others. A micro-batch is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            main(batch.where(F.col(tag) == "main"), batch_id)
            side(batch.where(F.col(tag) != "main"), batch_id)
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(write)
