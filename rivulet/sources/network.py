"""Sources that need a peer: a line socket and Kafka. The Kafka connector package has to be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket as column ``line``. Not replayable, so for trials only."""
    raw = spark.readStream.format("socket").option("host", host).option("port", port).load()
    return raw.select(F.col("value").alias("line"))


def kafka_options(servers: str, topic: str, group: str | None = None, starting: str = "latest") -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_strings(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    starting: str = "latest",
    offsets_per_trigger: int | None = None,
) -> DataFrame:
    """A topic's values as text column ``value``, with the broker's ``timestamp``."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, group, starting))
    if offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), "timestamp")
