"""op7: suffix-array dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import windows
from rivulet.llm.registry import query, table


@query("op7_windows")
def op7_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte windows that a smaller document has."""
    return windows.deduplicated(table(spark, sf_dir, "documents"))
