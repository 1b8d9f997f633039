"""SQL text over streaming views; the streams are ended, so they give what the batch queries give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.plans.registry import SQL, query
from rivulet.plans.streams import DELAY
from rivulet.plans.tables import event_stream, of_type
from rivulet.streaming import run, views


@query("stream_group_counts_sql", SQL["stream_group_counts"])
def stream_group_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grouping without windows: the counts change as rows come."""
    views.register(event_stream(spark, sf_dir), "live_events")
    counts = spark.sql("SELECT user_id, COUNT(item) AS count FROM live_events GROUP BY user_id")
    return run.last_update(run.drained(counts, "group-counts-sql", "update"), ["user_id"])


@query("stream_tumble_sql", SQL["tumble_sql"])
def stream_tumble_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    views.register(end.after(event_stream(spark, sf_dir)), "live_days", "ts", DELAY)
    counts = spark.sql(
        """SELECT user_id, COUNT(item) AS cnt, window.end AS end_t
        FROM live_days GROUP BY user_id, window(ts, '1 day')"""
    )
    return run.drained(counts, "tumble-sql", end=end)


@query("stream_hop_sql", SQL["hop_sql"])
def stream_hop_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    views.register(end.after(event_stream(spark, sf_dir)), "live_hops", "ts", DELAY)
    counts = spark.sql(
        """SELECT event_type, COUNT(item) AS cnt, window.end AS end_t
        FROM live_hops GROUP BY event_type, window(ts, '1 day', '6 hours')"""
    )
    return run.drained(counts, "hop-sql", end=end)


@query("stream_hot_items_sql", SQL["hot_items_sql"])
def stream_hot_items_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counting on the stream, ranking over the windows that a micro-batch has closed; both in SQL."""
    end = run.Ending(spark)
    views.register(end.after(event_stream(spark, sf_dir).where(of_type("view"))), "live_views", "ts", DELAY)
    counts = spark.sql(
        """SELECT item, COUNT(item) AS cnt, window.end AS window_end
        FROM live_views GROUP BY item, window(ts, '1 day', '6 hours')"""
    )
    best = """SELECT * FROM (
      SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY window_end ORDER BY cnt DESC, item) AS BIGINT) AS row_num FROM {closed}
    ) WHERE row_num <= 3"""
    return views.ranked(counts, best, "hot-items-sql", end)
