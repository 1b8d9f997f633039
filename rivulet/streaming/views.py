"""SQL text over live streams: a stream is registered as a view, and queries on it are streams again."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame

from rivulet.streaming.jobs import watermarked
from rivulet.streaming.run import Ending, drained


def register(df: DataFrame, name: str, ts: str | None = None, delay: timedelta = timedelta(0)) -> None:
    """Make a stream known to SQL by a name; ``ts`` is its event time, with windows that close ``delay`` after their end."""
    (watermarked(df, ts, delay) if ts else df).createOrReplaceTempView(name)


def ranked(counts: DataFrame, text: str, label: str, end: Ending | None = None) -> DataFrame:
    """A query with a ranking, which streams cannot have, over windows that have closed.

    In append mode all groups of a window come out in the micro-batch that closes it, so
    ``text``, a query on ``{closed}``, sees whole windows there.
    """
    return drained(counts, label, each=lambda batch: batch.sparkSession.sql(text, closed=batch), end=end)
