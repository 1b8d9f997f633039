"""The given tables, with the columns the queries use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivulet.sources import files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shaped(raw: DataFrame) -> DataFrame:
    """Events with an absolute time, the value in cents, the item, and an arrival number.

    ``arrival`` is a disordered copy of the event order, unique per row.
    """
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item"),
        ((F.col("event_id") + (F.col("event_id") * 37) % 50) * 64 + F.col("event_id") % 64).alias("arrival"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    return shaped(files.table_stream(spark, sf_dir, schema, glob="events.parquet"))


def of_type(*names: str) -> Column:
    return F.col("event_type").isin(*names)


# The same shape in SQL, as the head of the oracle queries.
EVENTS_SQL = """
WITH RECURSIVE e AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS item,
         (event_id + (event_id * 37) % 50) * 64 + event_id % 64 AS arrival
  FROM events
)
"""
