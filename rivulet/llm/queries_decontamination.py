"""op10: benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import decontamination
from rivulet.llm.registry import query, table


@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place where a document repeats a benchmark item."""
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
