"""Operators for training-data pipelines. Nothing outside this folder imports it but the entry module."""

from rivulet.llm import queries_decontamination, queries_jaccard, queries_mixing, queries_quality, queries_repetitions, queries_secrets, queries_sentencepieces, queries_spelling, queries_style_tree, queries_suffix_tree, queries_tool_calls, queries_topk, queries_windows  # noqa: F401
from rivulet.llm.registry import QUERIES, SQL  # noqa: F401
