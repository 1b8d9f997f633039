"""Event patterns, state machines and timers."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.operators import machine, patterns, timers
from rivulet.plans.registry import query
from rivulet.plans.tables import EVENTS_SQL, events, of_type

FAIL = "error"
BY_USER_SQL = "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"
STRICT_SQL = EVENTS_SQL + f""", near AS (SELECT *, lead(event_type, 1) OVER w AS type2, lead(event_type, 2) OVER w AS type3,
  lead(ts, 1) OVER w AS ts2, lead(ts, 2) OVER w AS ts3, lead(event_id, 2) OVER w AS id3 FROM e {BY_USER_SQL}),
matched AS (SELECT * FROM near WHERE event_type = 'error' AND type2 = 'error' AND type3 = 'error')
"""


@query("fails_strict", STRICT_SQL + "SELECT user_id, ts AS first_ts, ts2 AS second_ts, ts3 AS third_ts FROM matched")
def fails_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = {name: of_type(FAIL) for name in ("first", "second", "third")}
    return patterns.strict_sequence(events(spark, sf_dir), ["user_id"], "ts", "event_id", steps)


@query(
    "fails_times",
    EVENTS_SQL
    + f"""SELECT * FROM (SELECT user_id, ts AS first_ts, lead(ts, 1) OVER w AS second_ts, lead(ts, 2) OVER w AS third_ts
    FROM e WHERE event_type = 'error' {BY_USER_SQL}) WHERE third_ts IS NOT NULL""",
)
def fails_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.repeated(
        events(spark, sf_dir), ["user_id"], "ts", "event_id", of_type(FAIL), ["first", "second", "third"]
    )


@query("fails_machine", STRICT_SQL + "SELECT user_id, id3 AS event_id, 'S2' AS state FROM matched")
def fails_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.when(of_type(FAIL), "fail").otherwise("success")
    return machine.run_machine(
        events(spark, sf_dir), ["user_id"], "ts", "event_id", event, machine.LOGIN_FAILURES
    )


@query(
    "pay_within",
    EVENTS_SQL
    + f""", near AS (SELECT *, lead(ts) OVER w AS ts2, lead(event_type) OVER w AS type2,
      coalesce(lead(ts) OVER w < ts + INTERVAL 12 HOURS, false) AS in_time FROM e {BY_USER_SQL})
    SELECT user_id, ts AS first_ts, CASE WHEN in_time THEN ts2 END AS then_ts,
      CASE WHEN in_time THEN 'match' ELSE 'timeout' END AS output
    FROM near WHERE event_type = 'signup' AND (NOT in_time OR type2 = 'purchase')""",
)
def pay_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.followed_within(
        events(spark, sf_dir),
        ["user_id"],
        "ts",
        "event_id",
        of_type("signup"),
        of_type("purchase"),
        timedelta(hours=12),
    )


@query("delay_timers", EVENTS_SQL + "SELECT DISTINCT user_id, ts + INTERVAL 5 SECONDS AS fire_ts FROM e")
def delay_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timers.delay_timers(events(spark, sf_dir), ["user_id"], "ts", timedelta(seconds=5))


@query(
    "timer_average",
    EVENTS_SQL
    + """, nxt AS (SELECT user_id, ts, min(ts) OVER (PARTITION BY user_id ORDER BY ts
        RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM e),
    chain(user_id, ts) AS (SELECT user_id, min(ts) FROM e GROUP BY user_id
      UNION ALL SELECT chain.user_id, nxt.after FROM chain JOIN nxt ON chain.user_id = nxt.user_id AND chain.ts = nxt.ts
      WHERE nxt.after IS NOT NULL)
    SELECT c.user_id, c.ts + INTERVAL 1 DAY AS fire_ts, CAST(sum(e.cents) AS BIGINT) AS sum, count(*) AS count,
      CAST(sum(e.cents) AS DOUBLE) / count(*) AS average
    FROM chain c JOIN e ON c.user_id = e.user_id AND e.ts < c.ts + INTERVAL 1 DAY GROUP BY c.user_id, c.ts""",
)
def timer_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timers.timer_average(
        events(spark, sf_dir), ["user_id"], "ts", "event_id", "cents", timedelta(days=1)
    )


@query(
    "rising_alert",
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
    WHERE f.until IS NULL OR c.ts + INTERVAL 6 HOURS <= f.until""",
)
def rising_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timers.rising_alert(
        events(spark, sf_dir), ["user_id"], "ts", "event_id", "cents", timedelta(hours=6)
    )
