"""Kafka producer. The connector package has to be on the class path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def kafka_rows(df: DataFrame, value: Column | str | None = None, key: str | None = None) -> DataFrame:
    """Rows as the connector takes them: text ``value``, all columns as JSON unless one is named."""
    if value is None:
        value = F.to_json(F.struct(*df.columns))
    elif isinstance(value, str):
        value = F.col(value)
    columns = [value.cast("string").alias("value")]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*columns)


def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Write a batch at once, or return the writer of a stream to be started."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if not df.isStreaming:
        return df.write.format("kafka").options(**options).save()
    writer = df.writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer
