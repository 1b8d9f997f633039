"""Streams whose rows arrive in slices: late rows and changelogs over several micro-batches.

Slices ascend by arrival, so the SQL is that of the whole table in arrival order, late rows included.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from rivulet.functions.time import interval
from rivulet.operators import watermarks
from rivulet.plans.registry import SQL, query
from rivulet.plans.tables import EVENTS_SQL, events, of_type
from rivulet.plans.windows import ARRIVALS_SQL, BOUND, DAY, LATENESS, WINDOW
from rivulet.session import scratch_path
from rivulet.streaming import changes, late
from rivulet.streaming.arrivals import Arrivals

BOUNDED = late.bounded("ts", "arrival", BOUND)


class _Fed:
    """Events fed to a stream, and the tables that its micro-batches write."""

    def __init__(self, spark: SparkSession, rows: DataFrame, label: str):
        self.spark, self.home = spark, scratch_path(spark, label)
        self.arrivals = Arrivals(rows, "arrival", slices=3)
        self.stream = self.arrivals.stream()

    def into(self, name: str):
        return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{self.home}/{name}/batch_id={batch_id}")

    def run(self, writer: DataStreamWriter) -> None:
        self.arrivals.run(writer, f"{self.home}/checkpoint")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.home}/{name}").drop("batch_id")


def _fed(spark: SparkSession, sf_dir: str, label: str) -> _Fed:
    return _Fed(spark, events(spark, sf_dir), label)


def _watermarked(fed: _Fed, marks: late.Marks, write) -> None:
    fed.run(late.with_watermark(fed.stream, "arrival", marks, f"{fed.home}/state", write))


@query("stream_late_tagged", SQL["late_tagged"])
def stream_late_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    fed = _fed(spark, sf_dir, "late-tagged")
    out = fed.into("out")
    _watermarked(fed, BOUNDED, lambda rows, i: out(watermarks.tag_late(rows, "ts").select("event_id", "late"), i))
    return fed.table("out")


@query("stream_late_routed", SQL["late_routed"])
def stream_late_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in time to one table, late ones to another."""
    fed = _fed(spark, sf_dir, "late-routed")

    def write(rows: DataFrame, batch_id: int) -> None:
        parts = watermarks.outputs(watermarks.route_late(rows, "ts"), "main", "late")
        for name, part in zip(("main", "late"), parts):
            fed.into(name)(part.select("event_id"), batch_id)

    _watermarked(fed, BOUNDED, write)
    parts = [fed.table(name).withColumn("output", F.lit(name)) for name in ("main", "late")]
    return parts[0].unionByName(parts[1])


@query("stream_watermark_union", SQL["watermark_union"])
def stream_watermark_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark of clicks united with views: the slower one's."""
    fed = _Fed(spark, events(spark, sf_dir).where(of_type("click", "view")), "watermark-union")
    out = fed.into("out")
    marks = late.united("ts", "arrival", timedelta(0), "event_type", ["click", "view"])
    _watermarked(fed, marks, lambda rows, i: out(rows.select("event_id", "watermark"), i))
    return fed.table("out")


@query("stream_punctuated", SQL["watermark_punctuated"])
def stream_punctuated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups travel in the stream as watermarks."""
    data = events(spark, sf_dir).withColumn("mark", F.col("ts") - interval(timedelta(milliseconds=1)))
    fed = _Fed(spark, data, "punctuated")
    out = fed.into("out")
    marks = late.punctuated("arrival", of_type("signup"), "mark")

    def write(rows: DataFrame, batch_id: int) -> None:
        out(watermarks.tag_late(rows, "ts").select("event_id", "watermark", "late"), batch_id)

    _watermarked(fed, marks, write)
    return fed.table("out")


def _firings(spark: SparkSession, sf_dir: str, label: str, size: timedelta, lateness: timedelta) -> _Fed:
    fed = _fed(spark, sf_dir, label)
    firings = late.Firings(
        ["event_type"], "ts", "arrival", size, lateness, BOUNDED, f"{fed.home}/state", fed.into("fired"), fed.into("dropped")
    )
    fed.run(firings.writer(fed.stream))
    firings.finish(spark)
    return fed


@query("stream_late_window", SQL["late_window"])
def stream_late_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that drop rows which come after they fired."""
    fired = _firings(spark, sf_dir, "late-window", WINDOW, timedelta(0)).table("fired")
    return fired.select("event_type", "window_start", "window_end", "count")


@query("stream_late_window_side", SQL["late_window_side"])
def stream_late_window_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that such windows drop."""
    return _firings(spark, sf_dir, "late-side", WINDOW, timedelta(0)).table("dropped").select("event_id", "window_start")


@query("stream_lateness_firings", SQL["lateness_firings"])
def stream_lateness_firings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _firings(spark, sf_dir, "lateness-firings", WINDOW, LATENESS).table("fired")


def _daily(sql: str) -> str:
    return sql.replace("INTERVAL 3 HOURS", "INTERVAL 1 DAY").replace("INTERVAL 90 MINUTES", "INTERVAL 6 HOURS")


@query("stream_lateness_windows", _daily(SQL["lateness_firings"]))
def stream_lateness_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firings of daily windows that are kept six hours for late rows."""
    return _firings(spark, sf_dir, "lateness-windows", DAY, timedelta(hours=6)).table("fired")


@query("stream_lateness_dropped", SQL["lateness_dropped"])
def stream_lateness_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _firings(spark, sf_dir, "lateness-dropped", WINDOW, LATENESS).table("dropped").select("event_id", "window_start")


@query(
    "stream_changelog_counts",
    EVENTS_SQL
    + """, c AS (SELECT user_id, arrival, event_type, count(CASE WHEN event_type <> 'error' THEN 1 END) OVER w AS after,
      row_number() OVER w AS number FROM e WINDOW w AS (PARTITION BY user_id ORDER BY arrival))
    SELECT user_id, arrival AS change_seq, '+I' AS row_kind, after AS count FROM c WHERE number = 1
    UNION ALL SELECT user_id, arrival, '-U', after - 1 FROM c WHERE number > 1 AND event_type <> 'error'
    UNION ALL SELECT user_id, arrival, '+U', after FROM c WHERE number > 1 AND event_type <> 'error'""",
)
def stream_changelog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the number of each user's events changes; errors do not count."""
    data = events(spark, sf_dir)
    fed = _Fed(spark, data.withColumn("counted", F.when(~of_type("error"), 1)), "changelog-counts")
    fed.run(changes.count_changes(fed.stream, ["user_id"], "arrival", f"{fed.home}/state", fed.into("out"), "counted"))
    return fed.table("out")


@query(
    "stream_changelog_upserts",
    EVENTS_SQL
    + """, p AS (SELECT user_id, arrival, CASE WHEN event_type <> 'error' THEN cents END AS new, event_type <> 'error' AS sets,
      lag(CASE WHEN event_type <> 'error' THEN cents END) OVER w AS old,
      coalesce(lag(event_type <> 'error') OVER w, false) AS was FROM e WINDOW w AS (PARTITION BY user_id ORDER BY arrival))
    SELECT user_id, arrival AS change_seq, '+I' AS row_kind, new AS cents FROM p WHERE NOT was AND sets
    UNION ALL SELECT user_id, arrival, '-D', old FROM p WHERE was AND NOT sets
    UNION ALL SELECT user_id, arrival, '-U', old FROM p WHERE was AND sets AND old IS DISTINCT FROM new
    UNION ALL SELECT user_id, arrival, '+U', new FROM p WHERE was AND sets AND old IS DISTINCT FROM new""",
)
def stream_changelog_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the last value per user, which errors remove: its changes."""
    fed = _fed(spark, sf_dir, "changelog-upserts")
    fed.run(
        changes.upsert_changes(
            fed.stream, ["user_id"], "cents", "arrival", of_type("error"), f"{fed.home}/state", fed.into("out")
        )
    )
    return fed.table("out")
