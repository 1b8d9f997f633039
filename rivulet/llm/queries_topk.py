"""op4: exact top-k search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import topk
from rivulet.llm.registry import query, table


@query(
    "op4_topk",
    """
    WITH v AS (
      SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (
      SELECT q.r, q.vec_id AS query_id, c.vec_id,
             coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.r <> q.r AND len(q.e) = len(c.e)
    )
    SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
    FROM s QUALIFY rank <= 10
    """,
)
def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows of every query."""
    return topk.nearest(table(spark, sf_dir, "embeddings"))
