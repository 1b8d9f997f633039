"""op5: mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import mixing
from rivulet.llm.registry import query, table

#: From a relation ``docs`` with doc_id, text and source to the rows of ``mixing.mixed``.
MIXED_SQL = r"""
sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix') AS key
  FROM docs
),
totals AS (SELECT source, sum(size)::BIGINT AS words FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         (sum(words) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
  FROM totals
),
filled AS (
  SELECT *, coalesce(sum(words * 2.0::DOUBLE) OVER (ORDER BY words / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         (sum(weight) OVER (ORDER BY words / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS weights_on
  FROM weighed
),
stops AS (SELECT *, words * 2.0::DOUBLE * weights_on <= weight * (budget - before) AS stopped FROM filled),
targets AS (
  SELECT source, words,
         CASE WHEN stopped THEN words * 2.0::DOUBLE
              ELSE (budget - sum(CASE WHEN stopped THEN words * 2.0::DOUBLE ELSE 0 END) OVER ())
                   / (sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER ())::DOUBLE * weight END AS target
  FROM stops
),
placed AS (
  SELECT s.doc_id, s.source, s.size, t.words AS source_size, t.target,
         CASE WHEN t.words > 0 THEN floor(t.target / t.words)::BIGINT ELSE 0 END AS epochs,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
mixed AS (
  SELECT doc_id, source, size, source_size, target,
         (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - start)))::BIGINT AS taken
  FROM placed
)
"""


@query(
    "op5_mixing",
    "WITH docs AS (SELECT doc_id, text, source FROM documents)," + MIXED_SQL
    + "SELECT doc_id, size, source_size, target, taken FROM mixed",
)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes from it."""
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
