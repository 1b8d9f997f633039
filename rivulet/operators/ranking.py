"""Top-N per window."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rivulet.operators.windows import sliding_counts


def top_n(counts: DataFrame, n: int, group: list[str], count: str = "count", tie: str = "item") -> DataFrame:
    """The ``n`` largest per group, all of them if there are fewer; ties by ``tie``."""
    order = Window.partitionBy(*group).orderBy(F.desc(count), F.asc(tie))
    return counts.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= n)


def hot_items(
    df: DataFrame, item: str, ts: str, size: timedelta, slide: timedelta, n: int = 3
) -> DataFrame:
    """Most counted items of each sliding window."""
    return top_n(sliding_counts(df, ts, size, slide, [item]), n, ["window_start", "window_end"], tie=item)


def hot_items_sql(spark: SparkSession, view: str, item: str, ts: str, size: str, slide: str, n: int = 3) -> DataFrame:
    """The same in SQL over a registered view. ``window`` takes size, then slide."""
    return spark.sql(
        f"""
        SELECT * FROM (
          SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY window_end ORDER BY cnt DESC, {item}) AS BIGINT) AS row_num
          FROM (
            SELECT {item}, COUNT({item}) AS cnt, window.end AS window_end
            FROM {view} GROUP BY {item}, window({ts}, '{size}', '{slide}')
          )
        ) WHERE row_num <= {int(n)}
        """
    )


def by_count(counts: DataFrame, count: str = "count", tie: str = "item") -> DataFrame:
    return counts.orderBy(F.desc(count), F.asc(tie))
