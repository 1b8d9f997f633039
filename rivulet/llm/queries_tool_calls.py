"""op1: chat formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import tool_calls
from rivulet.llm.registry import query, table

SCHEMAS = {
    "reply": {
        "text": {"type": "string", "required": True, "least": 1, "most": 400},
        "turn": {"type": "integer", "required": True, "least": 0},
    }
}


@query(
    "op1_tool_calls",
    """
    WITH users AS (
      SELECT conv_id, turn, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
      FROM (SELECT DISTINCT conv_id, turn FROM conversations WHERE role = 'user')
    ),
    calls AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) AS depth FROM users),
    answers AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE role = 'assistant')
    SELECT c.conv_id, c.turn, c.role,
           CASE c.role WHEN 'user' THEN c.conv_id || ':' || c.turn WHEN 'assistant' THEN c.conv_id || ':' || (c.turn - 1) END AS call_id,
           CASE c.role WHEN 'user' THEN k.depth * 2 - 1 WHEN 'assistant' THEN k.depth * 2 ELSE 0 END::BIGINT AS level,
           CASE c.role WHEN 'user' THEN a.turn IS NOT NULL WHEN 'assistant' THEN k.turn IS NOT NULL END AS linked,
           CASE WHEN c.role <> 'user' THEN NULL
                ELSE array_to_string(list_filter([
                  CASE WHEN c.text IS NULL THEN 'text: missing' WHEN len(c.text) < 1 THEN 'text: below 1' WHEN len(c.text) > 400 THEN 'text: above 400' END,
                  CASE WHEN c.turn < 0 THEN 'turn: below 0' END], lambda x: x IS NOT NULL), '; ') END AS problems,
           CASE c.role
             WHEN 'user' THEN '{"arguments":{"text":' || coalesce(to_json(c.text)::VARCHAR, 'null') || ',"turn":' || c.turn || '},"id":"' || c.conv_id || ':' || c.turn || '","name":"reply","role":"user"}'
             WHEN 'assistant' THEN '{"content":' || coalesce(to_json(c.text)::VARCHAR, 'null') || ',"role":"assistant","tool_call_id":"' || c.conv_id || ':' || (c.turn - 1) || '"}'
             ELSE '{"content":' || coalesce(to_json(c.text)::VARCHAR, 'null') || ',"role":' || coalesce(to_json(c.role)::VARCHAR, 'null') || '}' END AS json
    FROM conversations c
    LEFT JOIN calls k ON k.conv_id = c.conv_id AND k.turn = CASE c.role WHEN 'user' THEN c.turn WHEN 'assistant' THEN c.turn - 1 END
    LEFT JOIN answers a ON c.role = 'user' AND a.conv_id = c.conv_id AND a.turn = c.turn + 1
    """,
)
def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn, with users' turns as calls and assistants' as results."""
    return tool_calls.linked(tool_calls.from_turns(table(spark, sf_dir, "conversations")), SCHEMAS)
