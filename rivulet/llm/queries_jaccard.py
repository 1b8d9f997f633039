"""op9: n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import jaccard
from rivulet.llm.registry import query, table


@query("op9_jaccard")
def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of near copies."""
    return jaccard.joined(table(spark, sf_dir, "documents"))
