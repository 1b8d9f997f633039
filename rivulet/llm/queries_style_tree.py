"""op2: HTML extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import style_tree
from rivulet.llm.registry import query, table


@query("op2_style_tree")
def op2_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return style_tree.extracted(table(spark, sf_dir, "pages"))
