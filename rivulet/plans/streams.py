"""Streaming twins: the same tables read as file streams until they are used up.

When the tables are used up the streams are ended, so they give what the batch queries give.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.functions import rows
from rivulet.operators import machine
from rivulet.plans.registry import query
from rivulet.plans.tables import EVENTS_SQL, event_stream, events, of_type, table
from rivulet.plans.windows import DAILY_SQL, SLIDING_SQL
from rivulet.session import scratch_path
from rivulet.sinks import keyed
from rivulet.sinks.rows import two_outputs
from rivulet.sources import files, modulo as modulo_source
from rivulet.streaming import carried, jobs, run, sessions, steps

DAY, DELAY = timedelta(days=1), timedelta(hours=2)


def _stream(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    stream = event_stream(spark, sf_dir)
    return stream.where(of_type(*kinds)) if kinds else stream


@query(
    "stream_tumbling_counts",
    EVENTS_SQL
    + f"SELECT user_id, {DAILY_SQL}, count(*) AS count FROM e GROUP BY ALL",
)
def stream_tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    counts = jobs.tumbling_counts(end.after(_stream(spark, sf_dir)), "ts", DAY, DELAY, ["user_id"])
    return run.drained(counts, "tumbling", end=end)


@query(
    "stream_sliding_global",
    EVENTS_SQL
    + f"SELECT {SLIDING_SQL}, count(*) AS count FROM e, range(4) AS r(s) GROUP BY ALL",
)
def stream_sliding_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    counts = jobs.sliding_counts(end.after(_stream(spark, sf_dir)), "ts", DAY, timedelta(hours=6), DELAY, [])
    return run.drained(counts, "sliding", end=end)


@query(
    "stream_hot_items",
    EVENTS_SQL
    + f"""SELECT item, window_start, window_end, count, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY count DESC, item) AS rank FROM (
        SELECT item, {SLIDING_SQL}, count(*) AS count
        FROM e, range(4) AS r(s) WHERE event_type = 'view' GROUP BY ALL))
    WHERE rank <= 3""",
)
def stream_hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    end, home = run.Ending(spark), scratch_path(spark, "hot-items")

    def write(best: DataFrame, batch_id: int) -> None:
        best.write.mode("overwrite").parquet(f"{home}/out/batch_id={batch_id}")

    views = end.after(_stream(spark, sf_dir, "view"))
    with run.state_settings(spark):
        job = jobs.hot_items(views, "item", "ts", DAY, timedelta(hours=6), DELAY, write)
        run.run_available(job, f"{home}/checkpoint", end)
    return spark.read.parquet(f"{home}/out").drop("batch_id")


@query(
    "stream_uv_exact",
    EVENTS_SQL
    + f"SELECT {DAILY_SQL}, count(DISTINCT user_id) AS visitors FROM e GROUP BY ALL",
)
def stream_uv_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    visitors = jobs.unique_visitors(end.after(_stream(spark, sf_dir)), "ts", "user_id", DAY, DELAY)
    return run.drained(visitors, "visitors", end=end)


@query(
    "stream_union_counts",
    EVENTS_SQL
    + f"SELECT {DAILY_SQL}, count(*) AS count FROM e WHERE event_type IN ('click', 'view') GROUP BY ALL",
)
def stream_union_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    both = [end.after(_stream(spark, sf_dir, kind).select("ts")) for kind in ("click", "view")]
    return run.drained(jobs.union_counts(both, "ts", DAY, DELAY), "union", end=end)


def _side(spark: SparkSession, sf_dir: str, kind: str, name: str) -> DataFrame:
    return _stream(spark, sf_dir, kind).select(
        "user_id", F.col("event_id").alias(f"{name}_id"), F.col("ts").alias(f"{name}_ts")
    )


@query(
    "stream_interval_join",
    EVENTS_SQL
    + """SELECT p.user_id, p.event_id AS purchase_id, p.ts AS purchase_ts, v.event_id AS view_id, v.ts AS view_ts
    FROM e p JOIN e v ON p.user_id = v.user_id AND v.ts BETWEEN p.ts - INTERVAL 10 HOURS AND p.ts + INTERVAL 5 HOURS
    WHERE p.event_type = 'purchase' AND v.event_type = 'view'""",
)
def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jobs.interval_join(
        _side(spark, sf_dir, "purchase", "purchase"),
        _side(spark, sf_dir, "view", "view"),
        ["user_id"],
        "purchase_ts",
        "view_ts",
        timedelta(hours=-10),
        timedelta(hours=5),
        DELAY,
    )
    return run.drained(joined, "interval-join")


@query(
    "stream_window_join",
    EVENTS_SQL
    + """SELECT p.user_id, p.event_id AS purchase_id, v.event_id AS view_id,
    time_bucket(INTERVAL 6 HOURS, p.ts) AS window_start FROM e p JOIN e v ON p.user_id = v.user_id
      AND time_bucket(INTERVAL 6 HOURS, p.ts) = time_bucket(INTERVAL 6 HOURS, v.ts)
    WHERE p.event_type = 'purchase' AND v.event_type = 'view'""",
)
def stream_window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jobs.window_join(
        _side(spark, sf_dir, "purchase", "purchase"),
        _side(spark, sf_dir, "view", "view"),
        ["user_id"],
        "purchase_ts",
        "view_ts",
        timedelta(hours=6),
        DELAY,
    )
    return run.drained(joined.select("user_id", "purchase_id", "view_id", "window_start"), "window-join")


@query("stream_group_counts", EVENTS_SQL + "SELECT user_id, count(item) AS count FROM e GROUP BY user_id")
def stream_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = run.drained(jobs.group_counts(_stream(spark, sf_dir), ["user_id"], "item"), "counts", "update")
    return run.last_update(updates, ["user_id"])


@query(
    "stream_word_count",
    """SELECT word, count(*) AS count
    FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents) GROUP BY word""",
)
def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "documents").schema
    lines = files.table_stream(spark, sf_dir, schema, glob="documents.parquet")
    counts = rows.tokenize(lines, "text").groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return run.last_update(run.drained(counts, "words", "update"), ["word"])


@query(
    "stream_rolling_totals",
    EVENTS_SQL
    + """SELECT event_id, user_id, CAST(sum(cents) OVER w AS BIGINT) AS sum, count(*) OVER w AS count,
    max(cents) OVER w AS max, CAST(sum(cents) OVER w AS DOUBLE) / count(*) OVER w AS average
    FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
)
def stream_rolling_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = scratch_path(spark, "rolling")
    data = _stream(spark, sf_dir).select("event_id", "user_id", "cents")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.drop("cents").write.mode("overwrite").parquet(f"{home}/out/batch_id={batch_id}")

    with run.state_settings(spark):
        writer = carried.rolling_totals(data, ["user_id"], "cents", "event_id", f"{home}/state", write)
        run.run_available(writer, f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/out").drop("batch_id")


@query(
    "stream_mean_views",
    EVENTS_SQL
    + """SELECT event_id, event_type, CAST(count(*) OVER w AS DOUBLE) / sum(fresh) OVER w AS mean_views
    FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) = 1
      THEN 1 ELSE 0 END AS fresh FROM e)
    WINDOW w AS (PARTITION BY event_type ORDER BY event_id)""",
)
def stream_mean_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = scratch_path(spark, "mean-views")
    data = _stream(spark, sf_dir).select("event_id", "user_id", "event_type")

    def write(batch: DataFrame, batch_id: int) -> None:
        means = batch.select("event_id", "event_type", "mean_views")
        means.write.mode("overwrite").parquet(f"{home}/out/batch_id={batch_id}")

    with run.state_settings(spark):
        writer = carried.mean_views(data, "user_id", "event_id", f"{home}/state", write, ["event_type"])
        run.run_available(writer, f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/out").drop("batch_id")


@query(
    "stream_dynamic_filter",
    EVENTS_SQL
    + """SELECT event_id, item FROM (
      SELECT *, last_value(CASE WHEN event_type = 'error' THEN item % 10 END IGNORE NULLS) OVER (
        ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS wanted FROM e)
    WHERE event_type = 'click' AND item % 10 = wanted""",
)
def stream_dynamic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = scratch_path(spark, "filter")
    data = _stream(spark, sf_dir).select("event_id", "event_type", "item", (F.col("item") % 10).alias("digit"))
    clicks = data.where(of_type("click")).select("event_id", "item", "digit")
    queries = data.where(of_type("error")).select("event_id", F.col("digit").alias("wanted"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("event_id", "item").write.mode("overwrite").parquet(f"{home}/out/batch_id={batch_id}")

    with run.state_settings(spark):
        writer = carried.filtered_by_latest(clicks, queries, "digit", "wanted", "event_id", f"{home}/state", write)
        run.run_available(writer, f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/out").drop("batch_id")


@query(
    "stream_running_totals",
    EVENTS_SQL
    + """SELECT event_id, user_id, CAST(sum(cents) OVER w AS BIGINT) AS sum, count(*) OVER w AS count,
    max(cents) OVER w AS max, CAST(sum(cents) OVER w AS DOUBLE) / count(*) OVER w AS average
    FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    totals = steps.running_totals(end.after(_stream(spark, sf_dir)), ["user_id"], "ts", "event_id", "cents", DELAY)
    return run.drained(totals, "totals", end=end)


@query(
    "stream_timer_average",
    EVENTS_SQL
    + """, nxt AS (SELECT user_id, ts, min(ts) OVER (PARTITION BY user_id ORDER BY ts
        RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM e),
    chain(user_id, ts) AS (SELECT user_id, min(ts) FROM e GROUP BY user_id
      UNION ALL SELECT chain.user_id, nxt.after FROM chain JOIN nxt ON chain.user_id = nxt.user_id AND chain.ts = nxt.ts
      WHERE nxt.after IS NOT NULL)
    SELECT c.user_id, c.ts + INTERVAL 1 DAY AS fire_ts, CAST(sum(e.cents) AS BIGINT) AS sum, count(*) AS count,
      CAST(sum(e.cents) AS DOUBLE) / count(*) AS average
    FROM chain c JOIN e ON c.user_id = e.user_id AND e.ts < c.ts + INTERVAL 1 DAY
    GROUP BY c.user_id, c.ts""",
)
def stream_timer_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    data = end.after(_stream(spark, sf_dir))
    fired = steps.timer_average(data, ["user_id"], "ts", "event_id", "cents", DAY, DELAY)
    return run.drained(fired, "timer-average", end=end)


@query(
    "stream_delay_timers",
    EVENTS_SQL
    + "SELECT DISTINCT user_id, ts + INTERVAL 5 HOURS AS fire_ts FROM e",
)
def stream_delay_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    fired = steps.delay_timers(
        end.after(_stream(spark, sf_dir)), ["user_id"], "ts", "event_id", timedelta(hours=5), DELAY
    )
    return run.drained(fired, "delay-timers", end=end)


@query(
    "stream_rising_alert",
    EVENTS_SQL
    + """, v AS (SELECT user_id, ts, event_id, cents, lag(cents) OVER w AS previous FROM e
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    r AS (SELECT *, sum(CASE WHEN previous IS NULL OR cents < previous THEN 1 ELSE 0 END) OVER (
        PARTITION BY user_id ORDER BY ts, event_id) AS run FROM v),
    falls AS (SELECT user_id, run, min(ts) AS until FROM r GROUP BY user_id, run),
    rises AS (SELECT user_id, run, ts FROM r WHERE cents > previous),
    nxt AS (SELECT *, min(ts) OVER (PARTITION BY user_id, run ORDER BY ts
      RANGE BETWEEN INTERVAL 6 HOURS FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM rises),
    chain(user_id, run, ts) AS (SELECT user_id, run, min(ts) FROM rises GROUP BY user_id, run
      UNION ALL SELECT nxt.user_id, nxt.run, nxt.after FROM chain JOIN nxt
        ON chain.user_id = nxt.user_id AND chain.run = nxt.run AND chain.ts = nxt.ts WHERE nxt.after IS NOT NULL)
    SELECT c.user_id, c.ts + INTERVAL 6 HOURS AS fire_ts FROM chain c
    LEFT JOIN falls f ON c.user_id = f.user_id AND f.run = c.run + 1
    WHERE (f.until IS NULL OR c.ts + INTERVAL 6 HOURS <= f.until)""",
)
def stream_rising_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    fired = steps.rising_alert(
        end.after(_stream(spark, sf_dir)), ["user_id"], "ts", "event_id", "cents", timedelta(hours=6), DELAY
    )
    return run.drained(fired, "rising-alert", end=end)


STRICT_SQL = EVENTS_SQL + """, near AS (SELECT *, lead(event_type, 1) OVER w AS type2, lead(event_type, 2) OVER w AS type3,
  lead(ts, 1) OVER w AS ts2, lead(ts, 2) OVER w AS ts3, lead(event_id, 2) OVER w AS id3 FROM e
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
matched AS (SELECT * FROM near WHERE event_type = 'error' AND type2 = 'error' AND type3 = 'error')
"""


@query("stream_fails_strict", STRICT_SQL + "SELECT user_id, ts AS first_ts, ts2 AS second_ts, ts3 AS third_ts FROM matched")
def stream_fails_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    fail = {name: of_type("error") for name in ("first", "second", "third")}
    end = run.Ending(spark)
    matches = steps.strict_sequence(end.after(_stream(spark, sf_dir)), ["user_id"], "ts", "event_id", fail, DELAY)
    return run.drained(matches, "fails-strict", end=end)


@query(
    "stream_fails_times",
    EVENTS_SQL
    + """SELECT * FROM (SELECT user_id, ts AS first_ts, lead(ts, 1) OVER w AS second_ts, lead(ts, 2) OVER w AS third_ts
    FROM e WHERE event_type = 'error' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE third_ts IS NOT NULL""",
)
def stream_fails_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["first", "second", "third"]
    end = run.Ending(spark)
    errors = end.after(_stream(spark, sf_dir, "error"))
    matches = steps.repeated(errors, ["user_id"], "ts", "event_id", F.lit(True), names, DELAY)
    return run.drained(matches, "fails-times", end=end)


@query("stream_fails_machine", STRICT_SQL + "SELECT user_id, id3 AS event_id, 'S2' AS state FROM matched")
def stream_fails_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.when(of_type("error"), "fail").otherwise("success")
    end = run.Ending(spark)
    alerts = steps.run_machine(
        end.after(_stream(spark, sf_dir)), ["user_id"], "ts", "event_id", event, machine.LOGIN_FAILURES, DELAY
    )
    return run.drained(alerts, "fails-machine", end=end)


PAY_SQL = EVENTS_SQL + """, near AS (SELECT *, lead(ts) OVER w AS ts2, lead(event_type) OVER w AS type2,
  coalesce(lead(ts) OVER w < ts + INTERVAL 12 HOURS, false) AS in_time FROM e
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
paid AS (SELECT user_id, ts AS first_ts, CASE WHEN in_time THEN ts2 END AS then_ts,
  CASE WHEN in_time THEN 'match' ELSE 'timeout' END AS output
  FROM near WHERE event_type = 'signup' AND (NOT in_time OR type2 = 'purchase'))
"""


def _payments(spark: SparkSession, sf_dir: str, end: run.Ending) -> DataFrame:
    return steps.followed_within(
        end.after(_stream(spark, sf_dir)),
        ["user_id"],
        "ts",
        "event_id",
        of_type("signup"),
        of_type("purchase"),
        timedelta(hours=12),
        DELAY,
    )


@query("stream_pay_within", PAY_SQL + "SELECT * FROM paid")
def stream_pay_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = run.Ending(spark)
    return run.drained(_payments(spark, sf_dir, end), "pay-within", end=end)


@query(
    "stream_two_outputs",
    PAY_SQL + "SELECT CASE output WHEN 'match' THEN 'main' ELSE 'side' END AS sink, user_id, first_ts FROM paid",
)
def stream_two_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches to one table, time-outs to another, from one stream."""
    home = scratch_path(spark, "two-outputs")

    def into(name: str):
        return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{home}/{name}/batch_id={batch_id}")

    end = run.Ending(spark)
    tagged = _payments(spark, sf_dir, end).withColumn("output", F.when(F.col("output") == "match", "main").otherwise("side"))
    with run.state_settings(spark):
        run.run_available(two_outputs(tagged, into("main"), into("side")), f"{home}/checkpoint", end)
    parts = [spark.read.parquet(f"{home}/{name}").withColumn("sink", F.lit(name)) for name in ("main", "side")]
    return parts[0].unionByName(parts[1]).select("sink", "user_id", "first_ts")


@query(
    "stream_inner_join",
    EVENTS_SQL
    + """SELECT p.user_id, p.event_id AS purchase_id, s.event_id AS signup_id FROM e p JOIN e s ON p.user_id = s.user_id
    WHERE p.event_type = 'purchase' AND s.event_type = 'signup'""",
)
def stream_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with every sign-up of its user."""
    joined = jobs.inner_join(
        _side(spark, sf_dir, "purchase", "purchase"),
        _side(spark, sf_dir, "signup", "signup"),
        ["user_id"],
        ("purchase_id", "signup_id"),
        (2, 2),
    )
    return run.drained(joined.select("user_id", "purchase_id", "signup_id"), "inner-join")


@query(
    "stream_reconcile",
    EVENTS_SQL
    + """, r AS (SELECT user_id, ts, CASE event_type WHEN 'signup' THEN 0 ELSE 1 END AS side,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, CASE event_type WHEN 'signup' THEN 0 ELSE 1 END) AS n
      FROM e WHERE event_type IN ('signup', 'purchase')),
    q AS (
      SELECT user_id, n, ts, side, [ts] AS waiting, side AS waits, CAST([] AS TIMESTAMP[]) AS gone,
        CAST(NULL AS TIMESTAMP) AS partner, side AS waited FROM r WHERE n = 1
      UNION ALL
      SELECT user_id, n, ts, side,
        CASE WHEN len(live) = 0 THEN [ts] WHEN waits = side THEN list_append(live, ts) ELSE live[2:] END,
        CASE WHEN len(live) = 0 THEN side ELSE waits END,
        gone, CASE WHEN len(live) > 0 AND waits <> side THEN live[1] END, waits
      FROM (SELECT r.user_id, r.n, r.ts, r.side, q.waits,
          list_filter(q.waiting, lambda w: w >= r.ts - INTERVAL 100 HOURS) AS live,
          list_filter(q.waiting, lambda w: w < r.ts - INTERVAL 100 HOURS) AS gone
        FROM q JOIN r ON r.user_id = q.user_id AND r.n = q.n + 1)),
    alone AS (SELECT user_id, waited AS side, unnest(gone) AS ts FROM q
      UNION ALL SELECT user_id, waits, unnest(waiting) FROM q
      WHERE (user_id, n) IN (SELECT (user_id, max(n)) FROM r GROUP BY user_id))
    SELECT user_id, 'matched' AS status, CASE side WHEN 0 THEN ts ELSE partner END AS signup_ts,
      CASE side WHEN 0 THEN partner ELSE ts END AS purchase_ts FROM q WHERE partner IS NOT NULL
    UNION ALL SELECT user_id, CASE side WHEN 0 THEN 'no_right' ELSE 'no_left' END,
      CASE side WHEN 0 THEN ts END, CASE side WHEN 1 THEN ts END FROM alone""",
)
def stream_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sign-ups against all purchases of a user, one to one, at most 100 hours apart."""
    end = run.Ending(spark)
    matched = steps.reconcile(
        end.after(_stream(spark, sf_dir, "signup").select("user_id", "ts")).withColumnRenamed("ts", "signup_ts"),
        end.after(_stream(spark, sf_dir, "purchase").select("user_id", "ts")).withColumnRenamed("ts", "purchase_ts"),
        ["user_id"],
        "signup_ts",
        "purchase_ts",
        timedelta(hours=100),
        DELAY,
    )
    return run.drained(matched, "reconcile", end=end)


@query(
    "stream_sessions",
    EVENTS_SQL
    + """, g AS (SELECT user_id, ts, cents, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS fresh FROM e
      WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM g)
    SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS count, CAST(sum(cents) AS BIGINT) AS sum
    FROM n GROUP BY user_id, session""",
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' sessions, rows in list state until six hours have passed without another."""
    end = run.Ending(spark)
    data = end.after(_stream(spark, sf_dir))
    closed = sessions.sessions(data, ["user_id"], "ts", F.col("cents"), timedelta(hours=6), DELAY)
    return run.drained(closed, "sessions", end=end)


@query("stream_upsert", EVENTS_SQL + "SELECT user_id AS k, arg_max(cents, arrival) AS v FROM e GROUP BY user_id")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last value per user through the keyed table sink."""
    home = scratch_path(spark, "upsert")
    writes = _stream(spark, sf_dir).select(F.col("user_id").alias("k"), F.col("cents").alias("v"), "arrival")
    with run.state_settings(spark):
        writer = writes.writeStream.foreachBatch(
            lambda batch, batch_id: keyed.append_batch(batch, batch_id, f"{home}/out", ["k"], "arrival")
        )
        run.run_available(writer, f"{home}/checkpoint")
    return keyed.read_upserted(spark, f"{home}/out", ["k"], "arrival").select("k", "v")


@query(
    "csv_user_behavior",
    EVENTS_SQL
    + """SELECT CAST(user_id AS VARCHAR) AS "userId", CAST(item AS VARCHAR) AS "itemId",
    epoch_ms(date_trunc('second', ts)) AS timestamp, date_trunc('second', ts) AS ts FROM e WHERE event_type = 'view'""",
)
def csv_user_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as behaviour lines, read back through the CSV source, views only."""
    home = scratch_path(spark, "behavior")
    behavior = F.when(of_type("view"), "pv").otherwise(F.col("event_type"))
    events(spark, sf_dir).select(
        "user_id", "item", F.lit("c").alias("category"), behavior.alias("behavior"), F.unix_seconds("ts").alias("seconds")
    ).write.csv(home)
    views = files.user_behavior(spark, home).where(F.col("behavior") == "pv")
    return views.select("userId", "itemId", "timestamp", "ts")


@query(
    "stream_lines",
    EVENTS_SQL + "SELECT CAST(user_id AS VARCHAR) AS key, epoch_ms(date_trunc('second', ts)) AS ts FROM e",
)
def stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``"key n"`` lines as a line stream, parsed."""
    home = scratch_path(spark, "lines")
    events(spark, sf_dir).select(F.concat_ws(" ", "user_id", F.unix_seconds("ts"))).write.text(home)
    return run.drained(rows.parse_pairs(files.text_lines(spark, home, stream=True), "line"), "pairs")


@query(
    "modulo_source",
    EVENTS_SQL
    + """SELECT CAST(event_id % 3 AS INTEGER) AS subtask, event_type, count(*) AS count FROM e GROUP BY ALL""",
)
def modulo_source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition-aware source, as long as the event table, joined to it by number."""
    data = events(spark, sf_dir).select("event_id", "event_type")
    upper = data.agg(F.max("event_id")).first()[0] + 1
    numbers = modulo_source.modulo(spark, upper, 3)
    joined = numbers.join(data, F.col("v") == F.col("event_id"))
    return joined.groupBy("subtask", "event_type").agg(F.count(F.lit(1)).alias("count"))
