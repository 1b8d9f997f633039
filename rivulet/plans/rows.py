"""Row functions, redistribution and rolling aggregates."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.functions import lifecycle, rows, time
from rivulet.operators import folds, redistribute, rolling
from rivulet.plans.registry import query
from rivulet.plans.tables import EVENTS_SQL, events, of_type, table


@query("map_pair", EVENTS_SQL + 'SELECT item AS "left", item AS "right" FROM e')
def map_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.duplicated(events(spark, sf_dir), "item")


@query("map_square", EVENTS_SQL + "SELECT event_id, item, item * item AS square FROM e")
def map_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.squared(events(spark, sf_dir).select("event_id", "item"), "item")


@query("map_square_with_setup", EVENTS_SQL + "SELECT event_id, item * item AS square FROM e")
def map_square_with_setup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.map_with_setup(
        events(spark, sf_dir).select("event_id", "item"),
        setup=lambda: 2,
        apply=lambda power, pdf: pd.DataFrame({"event_id": pdf["event_id"], "square": pdf["item"] ** power}),
        schema="event_id bigint, square bigint",
    )


@query("udf_scalar", EVENTS_SQL + "SELECT event_id, item * item + cents AS mixed FROM e")
def udf_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = lifecycle.scalar(lambda item, cents: item * item + cents, "bigint")
    return events(spark, sf_dir).select("event_id", mix("item", "cents").alias("mixed"))


@query(
    "udf_flat_map",
    EVENTS_SQL + "SELECT event_id, CAST(i AS BIGINT) AS digit FROM e, unnest(range(item % 4)) AS r(i)",
)
def udf_flat_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows 0 .. item % 4 - 1 for each event."""

    def spread(pdf: pd.DataFrame) -> pd.DataFrame:
        digits = [[] if pd.isna(i) else list(range(int(i) % 4)) for i in pdf["item"]]
        return pd.DataFrame({"event_id": pdf["event_id"], "digit": digits}).explode("digit").dropna()

    return lifecycle.flat_map(
        events(spark, sf_dir).select("event_id", "item"), spread, "event_id bigint, digit bigint"
    )


@query("filter_user", EVENTS_SQL + "SELECT event_id, user_id, event_type FROM e WHERE user_id = 8")
def filter_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("user_id") == 8).select("event_id", "user_id", "event_type")


@query("filter_views", EVENTS_SQL + "SELECT event_id, item, ts FROM e WHERE event_type = 'view'")
def filter_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(of_type("view")).select("event_id", "item", "ts")


@query(
    "replicate",
    EVENTS_SQL
    + """SELECT event_id, event_type FROM e,
    unnest(range(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 0 END)) AS c(i)""",
)
def replicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.replicate(
        events(spark, sf_dir).select("event_id", "event_type"), "event_type", {"view": 1, "click": 2}
    )


@query(
    "parse_pairs",
    EVENTS_SQL + "SELECT CAST(user_id AS VARCHAR) AS key, epoch_ms(date_trunc('second', ts)) AS ts FROM e",
)
def parse_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = events(spark, sf_dir).select(F.concat_ws(" ", "user_id", F.unix_seconds("ts")).alias("line"))
    return rows.parse_pairs(lines, "line", unit="s")


@query("time_text", EVENTS_SQL + "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS text FROM e")
def time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", time.millis_text(F.unix_millis("ts")).alias("text"))


@query(
    "window_start_by_modulo",
    EVENTS_SQL + "SELECT event_id, epoch_ms(ts) - epoch_ms(ts) % 3600000 AS window_start FROM e",
)
def window_start_by_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = time.window_start_millis(F.unix_millis("ts"), timedelta(hours=1))
    return events(spark, sf_dir).select("event_id", start.alias("window_start"))


@query(
    "word_count",
    """SELECT word, count(*) AS count
    FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents) GROUP BY word""",
)
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.word_counts(rows.tokenize(table(spark, sf_dir, "documents"), "text"))


@query(
    "rolling_word_count",
    """WITH d AS (SELECT doc_id, string_split(rtrim(text, ' '), ' ') AS words FROM documents),
    p AS (SELECT doc_id, words, coalesce(sum(len(words)) OVER (
      ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
    t AS (SELECT CAST(before + i - 1 AS BIGINT) AS word_seq, words[i] AS word
      FROM p, unnest(range(1, len(words) + 1)) AS r(i))
    SELECT word_seq, word, count(*) OVER (PARTITION BY word ORDER BY word_seq) AS count FROM t""",
)
def rolling_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = rows.tokenize_in_order(table(spark, sf_dir, "documents"), "text", "doc_id")
    return rolling.rolling_count(words.select("word_seq", "word"), ["word"], "word_seq")


@query(
    "rolling_sum",
    EVENTS_SQL
    + "SELECT event_id, user_id, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS sum FROM e",
)
def rolling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = events(spark, sf_dir).select("event_id", "user_id", "cents")
    return rolling.rolling_sum(data, ["user_id"], "cents", "event_id").drop("cents")


@query(
    "rolling_sum_by_parity",
    EVENTS_SQL
    + """SELECT event_id, item % 2 AS parity,
    CAST(sum(item) OVER (PARTITION BY item % 2 ORDER BY event_id) AS BIGINT) AS sum FROM e""",
)
def rolling_sum_by_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = events(spark, sf_dir).select("event_id", "item", (F.col("item") % 2).alias("parity"))
    return rolling.rolling_sum(data, ["parity"], "item", "event_id").drop("item")


@query(
    "rolling_max",
    EVENTS_SQL
    + "SELECT event_id, user_id, max(cents) OVER (PARTITION BY user_id ORDER BY event_id) AS max FROM e",
)
def rolling_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = events(spark, sf_dir).select("event_id", "user_id", "cents")
    return rolling.rolling_max(data, ["user_id"], "cents", "event_id").drop("cents")


@query(
    "rolling_average_by_user",
    EVENTS_SQL
    + """SELECT event_id, user_id, CAST(sum(cents) OVER w AS DOUBLE) / count(*) OVER w AS average
    FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
)
def rolling_average_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = events(spark, sf_dir).select("event_id", "user_id", "cents")
    return rolling.rolling_average(data, ["user_id"], "cents", "event_id").drop("cents")


@query(
    "rolling_average_global",
    EVENTS_SQL
    + """SELECT event_id, CAST(sum(cents) OVER w AS DOUBLE) / count(*) OVER w AS average
    FROM e WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
)
def rolling_average_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = events(spark, sf_dir).select("event_id", "cents")
    return rolling.rolling_average(data, [], "cents", "event_id").drop("cents")


@query(
    "running_mean_views",
    EVENTS_SQL
    + """SELECT event_id, event_type, CAST(count(*) OVER w AS DOUBLE) / sum(fresh) OVER w AS mean_views
    FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) = 1
      THEN 1 ELSE 0 END AS fresh FROM e)
    WINDOW w AS (PARTITION BY event_type ORDER BY event_id)""",
)
def running_mean_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = events(spark, sf_dir).select("event_id", "user_id", "event_type")
    means = rolling.running_mean_views(data, "user_id", "event_id", ["event_type"])
    return means.select("event_id", "event_type", "mean_views")


@query(
    "user_aggregate",
    EVENTS_SQL
    + """SELECT user_id, CAST(sum(cents) AS BIGINT) AS total, count(*) AS count, max(cents) AS largest
    FROM e GROUP BY user_id""",
)
def user_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = folds.user_aggregate(
        events(spark, sf_dir),
        ["user_id"],
        "cents",
        create=lambda: [0, 0, 0],
        add=lambda a, v: [a[0] + v, a[1] + 1, max(a[2], v)],
        merge=lambda a, b: [a[0] + b[0], a[1] + b[1], max(a[2], b[2])],
    )
    names = ("total", "count", "largest")
    return folded.select("user_id", *(F.col("accumulator")[i].alias(n) for i, n in enumerate(names)))


@query(
    "window_fold",
    EVENTS_SQL
    + """SELECT event_type, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
    count(*) AS count, max(cents) - min(cents) AS spread FROM e GROUP BY ALL""",
)
def window_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = folds.window_fold(
        events(spark, sf_dir),
        "ts",
        timedelta(days=1),
        ["event_type"],
        "cents",
        create=lambda: [],
        add=lambda a, v: [a[0] + 1, min(a[1], v), max(a[2], v)] if a else [1, v, v],
        merge=lambda a, b: [a[0] + b[0], min(a[1], b[1]), max(a[2], b[2])],
    )
    a = F.col("accumulator")
    return folded.select(
        "event_type", "window_start", "window_end", a[0].alias("count"), (a[2] - a[1]).alias("spread")
    )


@query("redistribute_by_key", "SELECT event_id, user_id FROM events")
def redistribute_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redistribute.by_key(events(spark, sf_dir).select("event_id", "user_id"), ["user_id"])


@query("redistribute_shuffle", "SELECT event_id, user_id FROM events")
def redistribute_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = events(spark, sf_dir).select("event_id", "user_id")
    return redistribute.shuffled(data, spark.sparkContext.defaultParallelism)


@query("redistribute_rebalance", "SELECT event_id, user_id FROM events")
def redistribute_rebalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = events(spark, sf_dir).select("event_id", "user_id")
    return redistribute.rebalanced(data, spark.sparkContext.defaultParallelism)


@query("redistribute_parallelism", "SELECT event_id, user_id FROM events")
def redistribute_parallelism(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More tasks for one step, then fewer for the next."""
    data = redistribute.with_parallelism(events(spark, sf_dir).select("event_id", "user_id"), 12)
    return redistribute.with_parallelism(data, 3)


@query("redistribute_copies", "SELECT event_id, CAST(c AS INTEGER) AS consumer FROM events, range(2) AS r(c)")
def redistribute_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redistribute.copied(events(spark, sf_dir).select("event_id"), 2)
