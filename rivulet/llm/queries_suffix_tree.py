"""op8: LM scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import suffix_tree
from rivulet.llm.registry import query, table


@query("op8_suffix_tree")
def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its log10 probability."""
    return suffix_tree.scored(table(spark, sf_dir, "documents"))
