"""Unions, joins, reconciliation, upserts and changelogs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.operators import changelog, joins, upsert
from rivulet.plans.registry import query
from rivulet.plans.tables import EVENTS_SQL, events, of_type, table

HOURS = lambda n: timedelta(hours=n)


@query(
    "union_all",
    EVENTS_SQL
    + """SELECT event_id, event_type FROM e WHERE event_type = 'click'
    UNION ALL SELECT event_id, event_type FROM e WHERE event_type = 'view'
    UNION ALL SELECT event_id, event_type FROM e WHERE event_type IN ('view', 'error')""",
)
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = events(spark, sf_dir).select("event_id", "event_type")
    return joins.union(
        data.where(of_type("click")), data.where(of_type("view")), data.where(of_type("view", "error"))
    )


@query(
    "inner_join",
    """SELECT o_orderkey, o_custkey AS custkey, c_name, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return joins.inner_join(orders, customers, ["custkey"], spread_by=("o_orderkey", "custkey"))


def _side(spark: SparkSession, sf_dir: str, kind: str, name: str) -> DataFrame:
    return events(spark, sf_dir).where(of_type(kind)).select(
        "user_id", F.col("event_id").alias(f"{name}_id"), F.col("ts").alias(f"{name}_ts")
    )


@query(
    "interval_join",
    EVENTS_SQL
    + """SELECT p.user_id, p.event_id AS purchase_id, p.ts AS purchase_ts, v.event_id AS view_id, v.ts AS view_ts
    FROM e p JOIN e v ON p.user_id = v.user_id AND v.ts BETWEEN p.ts - INTERVAL 10 HOURS AND p.ts + INTERVAL 5 HOURS
    WHERE p.event_type = 'purchase' AND v.event_type = 'view'""",
)
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.interval_join(
        _side(spark, sf_dir, "purchase", "purchase"),
        _side(spark, sf_dir, "view", "view"),
        ["user_id"],
        "purchase_ts",
        "view_ts",
        HOURS(-10),
        HOURS(5),
        spread_by=("purchase_id", "view_id"),
    )


@query(
    "interval_join_mirrored",
    EVENTS_SQL
    + """SELECT p.user_id, p.event_id AS purchase_id, p.ts AS purchase_ts, v.event_id AS view_id, v.ts AS view_ts
    FROM e p JOIN e v ON p.user_id = v.user_id AND p.ts BETWEEN v.ts - INTERVAL 5 HOURS AND v.ts + INTERVAL 10 HOURS
    WHERE p.event_type = 'purchase' AND v.event_type = 'view'""",
)
def interval_join_mirrored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.interval_join(
        _side(spark, sf_dir, "view", "view"),
        _side(spark, sf_dir, "purchase", "purchase"),
        ["user_id"],
        "view_ts",
        "purchase_ts",
        HOURS(-5),
        HOURS(10),
        spread_by=("view_id", "purchase_id"),
    )


@query(
    "window_join",
    EVENTS_SQL
    + """SELECT p.user_id, p.event_id AS purchase_id, v.event_id AS view_id,
    time_bucket(INTERVAL 6 HOURS, p.ts) AS window_start FROM e p JOIN e v ON p.user_id = v.user_id
      AND time_bucket(INTERVAL 6 HOURS, p.ts) = time_bucket(INTERVAL 6 HOURS, v.ts)
    WHERE p.event_type = 'purchase' AND v.event_type = 'view'""",
)
def window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.window_join(
        _side(spark, sf_dir, "purchase", "purchase"),
        _side(spark, sf_dir, "view", "view"),
        ["user_id"],
        "purchase_ts",
        "view_ts",
        HOURS(6),
        spread_by=("purchase_id", "view_id"),
    )
    return joined.select("user_id", "purchase_id", "view_id", "window_start")


@query(
    "dynamic_filter",
    EVENTS_SQL
    + """SELECT event_id, item FROM (
      SELECT *, last_value(CASE WHEN event_type = 'error' THEN item % 10 END IGNORE NULLS) OVER (
        ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS wanted FROM e)
    WHERE event_type = 'click' AND item % 10 = wanted""",
)
def dynamic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors set the wanted last digit of the item; clicks pass if theirs is it."""
    data = events(spark, sf_dir).select("event_id", "event_type", "item", (F.col("item") % 10).alias("digit"))
    clicks = data.where(of_type("click")).select("event_id", "item", "digit")
    queries = data.where(of_type("error")).select("event_id", F.col("digit").alias("wanted"))
    return joins.dynamic_filter(clicks, queries, "digit", "wanted", "event_id").select("event_id", "item")


@query(
    "reconcile",
    EVENTS_SQL
    + """, s AS (SELECT user_id, date_trunc('day', ts) AS day, min(ts) AS signup_ts FROM e
      WHERE event_type = 'signup' GROUP BY ALL),
    p AS (SELECT user_id, date_trunc('day', ts) AS day, min(ts) AS purchase_ts FROM e
      WHERE event_type = 'purchase' GROUP BY ALL),
    j AS (SELECT user_id, day, signup_ts, purchase_ts,
      coalesce(signup_ts <= purchase_ts + INTERVAL 6 HOURS AND purchase_ts <= signup_ts + INTERVAL 6 HOURS, false) AS ok
      FROM s FULL JOIN p USING (user_id, day))
    SELECT user_id, day, 'matched' AS status, signup_ts, purchase_ts FROM j WHERE ok
    UNION ALL SELECT user_id, day, 'no_right', signup_ts, NULL FROM j WHERE NOT ok AND signup_ts IS NOT NULL
    UNION ALL SELECT user_id, day, 'no_left', NULL, purchase_ts FROM j WHERE NOT ok AND purchase_ts IS NOT NULL""",
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First sign-up and first purchase of a user and day, at most six hours apart."""

    def first(kind: str) -> DataFrame:
        rows = events(spark, sf_dir).where(of_type(kind))
        return rows.groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(F.min("ts").alias(f"{kind}_ts"))

    return joins.reconcile(
        first("signup"), first("purchase"), ["user_id", "day"], "signup_ts", "purchase_ts", HOURS(6)
    )


@query(
    "group_counts_sql",
    "SELECT user_id, count(props) AS cnt FROM events GROUP BY user_id",
)
def group_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("clicks")
    return spark.sql("SELECT user_id, COUNT(props) AS cnt FROM clicks GROUP BY user_id")


@query(
    "tumble_sql",
    EVENTS_SQL
    + """SELECT user_id, count(item) AS cnt, date_trunc('day', ts) + INTERVAL 1 DAY AS end_t
    FROM e GROUP BY user_id, date_trunc('day', ts)""",
)
def tumble_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    events(spark, sf_dir).createOrReplaceTempView("shaped_events")
    return spark.sql(
        """SELECT user_id, COUNT(item) AS cnt, window.end AS end_t
        FROM shaped_events GROUP BY user_id, window(ts, '1 day')"""
    )


@query(
    "hop_sql",
    EVENTS_SQL
    + """SELECT event_type, count(item) AS cnt,
    time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 6 HOURS * s + INTERVAL 1 DAY AS end_t
    FROM e, range(4) AS r(s) GROUP BY ALL""",
)
def hop_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    events(spark, sf_dir).createOrReplaceTempView("shaped_events")
    return spark.sql(
        """SELECT event_type, COUNT(item) AS cnt, window.end AS end_t
        FROM shaped_events GROUP BY event_type, window(ts, '1 day', '6 hours')"""
    )


@query(
    "changelog_counts",
    EVENTS_SQL
    + """, n AS (SELECT user_id, event_id AS change_seq, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS c FROM e)
    SELECT user_id, change_seq, '+I' AS row_kind, c AS count FROM n WHERE c = 1
    UNION ALL SELECT user_id, change_seq, '-U', c - 1 FROM n WHERE c > 1
    UNION ALL SELECT user_id, change_seq, '+U', c FROM n WHERE c > 1""",
)
def changelog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.rolling_changelog(events(spark, sf_dir), ["user_id"], "event_id", counted="item")


@query(
    "changelog_between",
    EVENTS_SQL
    + """, old AS (SELECT user_id, item, count(*) AS cnt FROM e WHERE ts < TIMESTAMP '2024-01-15' GROUP BY ALL),
    new AS (SELECT user_id, item, count(*) AS cnt FROM e WHERE ts >= TIMESTAMP '2024-01-08' GROUP BY ALL),
    j AS (SELECT user_id, item, old.cnt AS a, new.cnt AS b FROM old FULL JOIN new USING (user_id, item))
    SELECT user_id, item, '+I' AS row_kind, b AS cnt FROM j WHERE a IS NULL
    UNION ALL SELECT user_id, item, '-D', a FROM j WHERE b IS NULL
    UNION ALL SELECT user_id, item, '-U', a FROM j WHERE a <> b
    UNION ALL SELECT user_id, item, '+U', b FROM j WHERE a <> b""",
)
def changelog_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the counts before 15 January to those since 8 January."""
    data = events(spark, sf_dir)

    def counts(condition) -> DataFrame:
        return data.where(condition).groupBy("user_id", "item").agg(F.count(F.lit(1)).alias("cnt"))

    return changelog.changelog_between(
        counts(F.col("ts") < F.lit("2024-01-15").cast("timestamp")),
        counts(F.col("ts") >= F.lit("2024-01-08").cast("timestamp")),
        ["user_id", "item"],
        ["cnt"],
    )


def _writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(F.col("user_id").alias("k"), F.col("cents").alias("v"), "arrival")


@query("upsert_latest", EVENTS_SQL + "SELECT user_id AS k, arg_max(cents, arrival) AS v FROM e GROUP BY user_id")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.latest_per_key(_writes(spark, sf_dir), ["k"], "arrival").select("k", "v")


BATCHES_SQL = EVENTS_SQL + """,
t AS (SELECT user_id AS k, arg_max(cents, arrival) AS v FROM e WHERE event_type = 'view' AND user_id % 3 > 0 GROUP BY ALL),
b AS (SELECT user_id AS k, arg_max(cents, arrival) AS v FROM e WHERE event_type = 'click' GROUP BY ALL)
"""


def _target_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    data = events(spark, sf_dir)
    views = data.where(of_type("view") & (F.col("user_id") % 3 > 0))
    target = upsert.latest_per_key(
        views.select(F.col("user_id").alias("k"), F.col("cents").alias("v"), "arrival"), ["k"], "arrival"
    )
    batch = data.where(of_type("click")).select(F.col("user_id").alias("k"), F.col("cents").alias("v"), "arrival")
    return target.select("k", "v"), batch


@query(
    "upsert_split",
    BATCHES_SQL
    + """SELECT 'update' AS action, k, v FROM b WHERE k IN (SELECT k FROM t)
    UNION ALL SELECT 'insert', k, v FROM b WHERE k NOT IN (SELECT k FROM t)""",
)
def upsert_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates, inserts = upsert.split_upsert(*reversed(_target_and_batch(spark, sf_dir)), ["k"], "arrival")
    both = (d.select(F.lit(name).alias("action"), "k", "v") for name, d in (("update", updates), ("insert", inserts)))
    return joins.union(*both)


@query("upserted_table", BATCHES_SQL + "SELECT k, v FROM b UNION ALL SELECT k, v FROM t WHERE k NOT IN (SELECT k FROM b)")
def upserted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _target_and_batch(spark, sf_dir)
    return upsert.upserted(target, batch, ["k"], "arrival")
