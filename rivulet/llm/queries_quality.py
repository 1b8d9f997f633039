"""op6: quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import quality
from rivulet.llm.registry import query, table


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score."""
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
