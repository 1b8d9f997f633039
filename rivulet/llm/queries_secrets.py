"""op3: secret scans."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import secrets
from rivulet.llm.registry import query, table


def _either_case(pattern: str) -> str:
    """Letters of ``(?i:...)`` as classes: the other engine's folding would let in letters beyond ASCII."""
    return re.sub(r"\(\?i:([^)]*)\)", lambda m: re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", "(?:" + m[1] + ")"), pattern)


def found_sql(relation: str, rules=secrets.BASE + secrets.MORE) -> str:
    """CTEs from ``relation`` (doc_id, text and more) to ``found``: its columns and a sorted list ``found`` of structs."""
    lists, spans = [], []
    for n, r in enumerate(rules):
        pattern = _either_case(r.pattern).replace("'", "''")
        lists += [
            f"regexp_extract_all(body, '{pattern}', 0) AS all{n}",
            f"regexp_extract_all(body, '{pattern}', {r.group}) AS group{n}",
            f"string_split_regex(body, '{pattern}') AS gap{n}",
        ]
        start = f"(coalesce(list_sum(list_transform(gap{n}[1:i], lambda x: len(x))), 0) + coalesce(list_sum(list_transform(all{n}[1:i-1], lambda x: len(x))), 0))::BIGINT"
        spans.append(
            f"list_transform(list_filter(range(1, len(all{n}) + 1), lambda i: len(group{n}[i]) >= {r.least}), lambda i: "
            f"{{'start': {start}, 'rule': {n}, 'stop': {start} + len(all{n}[i]), 'kind': '{r.kind}'}})"
        )
    return (
        f"bodies AS (SELECT *, coalesce(text, '') AS body FROM {relation}), "
        f"lists AS (SELECT *, {', '.join(lists)} FROM bodies), "
        f"found AS (SELECT * EXCLUDE ({', '.join(x.split(' AS ')[-1] for x in lists)}), list_sort(flatten([{', '.join(spans)}])) AS found FROM lists)"
    )


_NAME = "lambda x: concat(x.kind, ':', x.start, ':', x.stop)"
_BASE = f"list_filter(found, lambda x: x.rule < {len(secrets.BASE)})"


@query(
    "op3_secrets",
    "WITH " + found_sql("documents") + f"""
    SELECT doc_id, {', '.join(f"len(list_filter(found, lambda x: x.rule = {i}))::BIGINT AS n_{r.kind}" for i, r in enumerate(secrets.BASE))},
           sha256(array_to_string(list_transform({_BASE}, {_NAME}), ',')) AS base_sha256,
           array_to_string(list_transform(found, {_NAME}), ',') AS spans
    FROM found""",
)
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document: counts, a digest and all spans."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))
