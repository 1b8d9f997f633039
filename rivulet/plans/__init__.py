"""Registered queries over the given tables."""

from rivulet.plans import joins, late_streams, patterns, rows, stream_sql, streams, windows  # noqa: F401
from rivulet.plans.registry import QUERIES, SQL  # noqa: F401
