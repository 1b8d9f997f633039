"""Files of lines and of user behaviour, as tables or as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rivulet import schemas


def _reader(spark: SparkSession, stream: bool, files_per_trigger: int | None):
    if not stream:
        return spark.read
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as they come. ``files_per_trigger`` bounds a micro-batch. ``glob``: tables of ``path``, files or folders of files.

    A path with a pattern is not taken for the base of partition columns, so it may be a single file.
    """
    reader = _reader(spark, True, files_per_trigger).schema(schema)
    return reader.parquet(f"{path}/[{glob[0]}]{glob[1:]}" if glob else path)


def text_lines(
    spark: SparkSession, path: str, stream: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    return _reader(spark, stream, files_per_trigger).schema(schemas.LINE).text(path)


def user_behavior(
    spark: SparkSession, path: str, stream: bool = False, files_per_trigger: int | None = None
) -> DataFrame:
    """``userId,itemId,categoryId,behavior,seconds`` lines; adds event time ``ts``, and milliseconds as ``timestamp``."""
    raw = _reader(spark, stream, files_per_trigger).schema(schemas.USER_BEHAVIOR).csv(path)
    return raw.withColumn("ts", F.timestamp_seconds("timestamp")).withColumn("timestamp", F.col("timestamp") * 1000)
