"""Time windows, watermarks, late rows, ranking and distinct counts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.functions.rows import window_message
from rivulet.functions.time import interval, window_start_millis
from rivulet.operators import distinct, ranking, watermarks, windows
from rivulet.plans.registry import query
from rivulet.plans.tables import EVENTS_SQL, events, of_type

HOUR, DAY = timedelta(hours=1), timedelta(days=1)
BOUND = timedelta(hours=2)

DAILY_SQL = "date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end"
# Every 1 day window, sliding by 6 hours, that holds a row.
SLIDING_SQL = """time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 6 HOURS * s AS window_start,
    time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 6 HOURS * s + INTERVAL 1 DAY AS window_end"""
WATERMARK_SQL = """SELECT *, max(ts) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 2 HOURS - INTERVAL 1 MILLISECOND AS watermark FROM e"""


@query("window_count_only", EVENTS_SQL + "SELECT user_id, count(*) AS count FROM e GROUP BY user_id, date_trunc('day', ts)")
def window_count_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_counts_only(events(spark, sf_dir), "ts", DAY, ["user_id"])


@query("tumbling_counts", EVENTS_SQL + f"SELECT user_id, {DAILY_SQL}, count(*) AS count FROM e GROUP BY ALL")
def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling(events(spark, sf_dir), "ts", DAY, ["user_id"])


@query("tumbling_by_arrival", EVENTS_SQL + f"SELECT event_type, {DAILY_SQL}, count(*) AS count FROM e GROUP BY ALL")
def tumbling_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.arrival_windows(events(spark, sf_dir), DAY, ["event_type"], arrival="ts")


@query(
    "tumbling_by_hand",
    EVENTS_SQL
    + """SELECT user_id, epoch_ms(date_trunc('day', ts)) AS window_start,
    epoch_ms(date_trunc('day', ts)) + 86400000 AS window_end, count(*) AS count FROM e GROUP BY ALL""",
)
def tumbling_by_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = window_start_millis(F.unix_millis("ts"), DAY)
    counts = events(spark, sf_dir).groupBy("user_id", start.alias("window_start")).count()
    return counts.select("user_id", "window_start", (F.col("window_start") + 86_400_000).alias("window_end"), "count")


@query("tumbling_global", EVENTS_SQL + f"SELECT {DAILY_SQL}, count(*) AS count FROM e GROUP BY ALL")
def tumbling_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling(events(spark, sf_dir), "ts", DAY)


@query(
    "window_messages",
    EVENTS_SQL
    + """SELECT 'key ' || user_id || ' window ' || strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') || ' ~ '
    || strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') || ' count ' || count(*) AS message
    FROM e GROUP BY user_id, date_trunc('day', ts)""",
)
def window_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = windows.tumbling(events(spark, sf_dir), "ts", DAY, ["user_id"])
    message = window_message(*(F.col(c) for c in ("user_id", "window_start", "window_end", "count")))
    return counts.select(message.alias("message"))


@query(
    "window_elements",
    EVENTS_SQL
    + f"""SELECT user_id, {DAILY_SQL}, count(*) AS count, CAST(sum(cents) AS BIGINT) AS total,
    min(cents) AS least, max(cents) AS largest FROM e GROUP BY ALL""",
)
def window_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-window results, as aggregates instead of a list of the window's rows."""
    return windows.tumbling(
        events(spark, sf_dir),
        "ts",
        DAY,
        ["user_id"],
        count=F.count(F.lit(1)),
        total=F.sum("cents"),
        least=F.min("cents"),
        largest=F.max("cents"),
    )


@query(
    "sliding_counts",
    EVENTS_SQL + f"SELECT item, {SLIDING_SQL}, count(*) AS count FROM e, range(4) AS r(s) GROUP BY ALL",
)
def sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_counts(events(spark, sf_dir), "ts", DAY, timedelta(hours=6), ["item"])


@query(
    "sliding_global",
    EVENTS_SQL + f"SELECT {SLIDING_SQL}, count(*) AS count FROM e, range(4) AS r(s) GROUP BY ALL",
)
def sliding_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding_counts(events(spark, sf_dir), "ts", DAY, timedelta(hours=6))


HOT_ITEMS_SQL = EVENTS_SQL + f"""
SELECT item, window_start, window_end, count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY count DESC, item) AS rank FROM (
    SELECT item, {SLIDING_SQL}, count(*) AS count
    FROM e, range(4) AS r(s) WHERE event_type = 'view' GROUP BY ALL))
WHERE rank <= 3"""


@query("hot_items", HOT_ITEMS_SQL)
def hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = events(spark, sf_dir).where(of_type("view"))
    return ranking.hot_items(views, "item", "ts", DAY, timedelta(hours=6), 3)


@query("hot_items_whole_window", HOT_ITEMS_SQL)
def hot_items_whole_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From one window over the whole stream: counts of the window's items, then the first three."""
    views = events(spark, sf_dir).where(of_type("view"))
    spread = views.groupBy(F.window("ts", "1 day", "6 hours").alias("w"), "item").agg(F.count("item").alias("count"))
    counts = spread.select("item", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count")
    return ranking.top_n(counts, 3, ["window_end"])


@query(
    "hot_items_sql",
    EVENTS_SQL
    + f"""SELECT item, cnt, window_end, row_num FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item) AS row_num FROM (
    SELECT item, {SLIDING_SQL}, count(*) AS cnt
    FROM e, range(4) AS r(s) WHERE event_type = 'view' GROUP BY ALL))
WHERE row_num <= 3""",
)
def hot_items_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    events(spark, sf_dir).where(of_type("view")).createOrReplaceTempView("item_views")
    return ranking.hot_items_sql(spark, "item_views", "item", "ts", "1 day", "6 hours")


@query("items_by_count", EVENTS_SQL + "SELECT item, count(*) AS count FROM e GROUP BY item ORDER BY count DESC, item")
def items_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.by_count(events(spark, sf_dir).groupBy("item").count())


@query("uv_exact", EVENTS_SQL + f"SELECT {DAILY_SQL}, count(DISTINCT user_id) AS visitors FROM e GROUP BY ALL")
def uv_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.unique_visitors(events(spark, sf_dir), "ts", "user_id", DAY)


@query("uv_approx")
def uv_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.approx_unique_visitors(events(spark, sf_dir), "ts", "user_id", DAY)


@query(
    "uv_sketch",
    EVENTS_SQL
    + f"""SELECT {SLIDING_SQL}, count(DISTINCT user_id) AS exact, true AS within
    FROM e, range(4) AS r(s) GROUP BY window_start, window_end""",
)
def uv_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding visitors by merged sketches, next to the exact ones and whether they are within four standard deviations."""
    data, slide, error = events(spark, sf_dir), timedelta(hours=6), 0.02
    near = distinct.sketch_unique_visitors(data, "ts", "user_id", DAY, slide, error)
    exact = data.groupBy(F.window("ts", "1 day", "6 hours").alias("w")).agg(F.count_distinct("user_id").alias("exact"))
    exact = exact.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "exact")
    within = F.abs(F.col("visitors") - F.col("exact")) <= 4 * error * F.col("exact")
    return exact.join(near, ["window_start", "window_end"], "left").select("window_start", "window_end", "exact", F.coalesce(within, F.lit(False)).alias("within"))


@query(
    "uv_bloom",
    EVENTS_SQL
    + f""", users AS (SELECT DISTINCT {DAILY_SQL}, md5(CAST(user_id AS VARCHAR)) AS digest FROM e),
    halves AS (SELECT window_start, window_end, CAST('0x' || digest[1:8] AS BIGINT) AS one,
      CAST('0x' || digest[9:16] AS BIGINT) AS two FROM users),
    filled AS (SELECT window_start, window_end, count(DISTINCT (one + i * two) % 958505) AS bits_set
      FROM halves, range(7) AS r(i) GROUP BY window_start, window_end)
    SELECT *, CAST(round(-958505 / 7.0 * ln(1 - bits_set / 958505.0)) AS BIGINT) AS visitors FROM filled""",
)
def uv_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.bloom_unique_visitors(events(spark, sf_dir), "ts", "user_id", DAY)


def _watermarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks.with_watermark(events(spark, sf_dir), "ts", "arrival", BOUND)


@query("watermark_bounded", EVENTS_SQL + f"SELECT event_id, watermark FROM ({WATERMARK_SQL})")
def watermark_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _watermarked(spark, sf_dir).select("event_id", "watermark")


@query(
    "watermark_ascending",
    EVENTS_SQL
    + """SELECT event_id, max(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL 1 MILLISECOND AS watermark FROM e""",
)
def watermark_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = watermarks.with_watermark(events(spark, sf_dir), "ts", "event_id", timedelta(0))
    return marked.select("event_id", "watermark")


@query(
    "watermark_union",
    EVENTS_SQL
    + """SELECT event_id, CASE WHEN a IS NOT NULL AND b IS NOT NULL
      THEN least(a, b) - INTERVAL 1 MILLISECOND END AS watermark
    FROM (SELECT event_id, max(ts) FILTER (event_type = 'click') OVER w AS a,
      max(ts) FILTER (event_type = 'view') OVER w AS b FROM e WHERE event_type IN ('click', 'view')
      WINDOW w AS (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
)
def watermark_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = events(spark, sf_dir).where(of_type("click", "view"))
    marked = watermarks.with_union_watermark(
        both, "ts", "arrival", timedelta(0), "event_type", ["click", "view"]
    )
    return marked.select("event_id", "watermark")


@query(
    "watermark_punctuated",
    EVENTS_SQL
    + """SELECT event_id, watermark, coalesce(ts < watermark, false) AS late FROM (
      SELECT *, max(CASE WHEN event_type = 'signup' THEN ts - INTERVAL 1 MILLISECOND END) OVER (
        ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark FROM e)
    WHERE event_type <> 'signup'""",
)
def watermark_punctuated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups stand in for watermark rows."""
    data = events(spark, sf_dir).withColumn("mark", F.col("ts") - interval(timedelta(milliseconds=1)))
    marked = watermarks.with_punctuated_watermark(data, "arrival", of_type("signup"), "mark")
    return watermarks.tag_late(marked, "ts").select("event_id", "watermark", "late")


@query("late_tagged", EVENTS_SQL + f"SELECT event_id, coalesce(ts < watermark, false) AS late FROM ({WATERMARK_SQL})")
def late_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks.tag_late(_watermarked(spark, sf_dir), "ts").select("event_id", "late")


@query(
    "late_routed",
    EVENTS_SQL
    + f"SELECT event_id, CASE WHEN ts < watermark THEN 'late' ELSE 'main' END AS output FROM ({WATERMARK_SQL})",
)
def late_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks.route_late(_watermarked(spark, sf_dir), "ts").select("event_id", "output")


ARRIVALS_SQL = EVENTS_SQL + f""", w AS ({WATERMARK_SQL}),
b AS (SELECT *, time_bucket(INTERVAL 3 HOURS, ts) AS window_start,
  time_bucket(INTERVAL 3 HOURS, ts) + INTERVAL 3 HOURS AS window_end FROM w),
a AS (SELECT *, CASE WHEN watermark IS NULL OR window_end - INTERVAL 1 MILLISECOND > watermark THEN 'on_time'
  WHEN window_end - INTERVAL 1 MILLISECOND + INTERVAL 90 MINUTES > watermark THEN 'late'
  ELSE 'dropped' END AS arrival_kind FROM b)
"""
WINDOW, LATENESS = timedelta(hours=3), timedelta(minutes=90)


@query(
    "late_window",
    ARRIVALS_SQL
    + "SELECT event_type, window_start, window_end, count(*) AS count FROM a WHERE arrival_kind = 'on_time' GROUP BY ALL",
)
def late_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that drop rows which come after they fired."""
    arrivals = watermarks.window_arrivals(_watermarked(spark, sf_dir), "ts", WINDOW)
    return (
        arrivals.where(F.col("arrival") == "on_time").groupBy("event_type", "window_start", "window_end").count()
    )


@query("late_window_side", ARRIVALS_SQL + "SELECT event_id, window_start FROM a WHERE arrival_kind <> 'on_time'")
def late_window_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that such windows drop."""
    arrivals = watermarks.window_arrivals(_watermarked(spark, sf_dir), "ts", WINDOW)
    return arrivals.where(F.col("arrival") == "dropped").select("event_id", "window_start")


def _kept_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = _watermarked(spark, sf_dir).withColumnRenamed("arrival", "place")
    return watermarks.window_arrivals(marked, "ts", WINDOW, LATENESS)


@query(
    "lateness_firings",
    ARRIVALS_SQL
    + """, n AS (SELECT event_type, window_start, window_end, arrival_kind, arrival,
      count(*) OVER w AS seen, count(*) FILTER (arrival_kind = 'on_time') OVER w AS on_time
      FROM a WHERE arrival_kind <> 'dropped'
      WINDOW w AS (PARTITION BY event_type, window_start ORDER BY arrival)),
    f AS (SELECT event_type, window_start, window_end, 1 AS firing, max(on_time) AS count FROM n
      WHERE on_time > 0 GROUP BY ALL
      UNION ALL SELECT event_type, window_start, window_end, seen - on_time + least(on_time, 1), seen FROM n
      WHERE arrival_kind = 'late')
    SELECT event_type, window_start, window_end, CAST(firing AS BIGINT) AS firing, firing = 1 AS first, count FROM f""",
)
def lateness_firings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks.window_firings(_kept_arrivals(spark, sf_dir), ["event_type"], "place")


@query("lateness_dropped", ARRIVALS_SQL + "SELECT event_id, window_start FROM a WHERE arrival_kind = 'dropped'")
def lateness_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_arrivals(spark, sf_dir).where(F.col("arrival") == "dropped").select("event_id", "window_start")
