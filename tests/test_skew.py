"""Cut keys give what uncut keys give, on one very hot key, one cold one, ties and bursts."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import ordered, values
from rivulet.operators import machine, patterns, rolling, segments, timers
from rivulet.operators.segments import Order, Running

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(5)
    data, at = [], 0
    for seq in range(400):
        at += rng.choice([0, 0, 0, 200, 700, 1500, 9000])
        user = None if seq % 9 == 0 else ("hot" if seq % 3 else f"u{seq % 5}")
        data.append((seq, START + timedelta(milliseconds=at), user, rng.choice(["fail", "fail", "ok"]), rng.randint(0, 9)))
    for seq in range(400, 440):
        data.append((seq, START + timedelta(milliseconds=at), "hot", "fail", 3))
    return spark.createDataFrame(data, "seq long, ts timestamp, user string, kind string, v long").repartition(3).cache()


def test_the_hot_key_is_cut(events, tiny):
    parts = segments.cut(events, ["user"], Order("seq", "ts"), tiny)
    sizes = parts.where("user = 'hot'").groupBy(*segments.PIECES).count()
    assert sizes.count() > 10
    assert sizes.agg(F.max("count")).first()[0] <= tiny.hot_rows


@pytest.mark.parametrize("ts", [None, "ts"])
@pytest.mark.parametrize("keys", [[], ["user"], ["user", "kind"]])
def test_running(events, tiny, keys, ts):
    measures = [
        Running("total", "sum", "v"),
        Running("n", "count"),
        Running("seen", "max", "ts", before=True),
        Running("least", "min", "v"),
        Running("lastfail", "last", F.when(F.col("kind") == "fail", F.col("v"))),
    ]
    order = Order("seq", ts)
    plain = segments.running(events, keys, order, measures, None)
    cut = segments.running(events, keys, order, measures, tiny)
    assert values(cut) == values(plain)


def test_a_key_far_apart_gets_segments_of_its_own_rows(spark):
    """12,000 rows of one key among numbers up to 10^12, some of them in a burst."""
    skew = segments.Skew(hot_rows=1000, segment_rows=500)
    apart = spark.range(9000).select((F.col("id") * 100_000_000).alias("seq"), F.lit("apart").alias("k"))
    burst = spark.range(3000).select((F.col("id") + 5_000_000_001).alias("seq"), F.lit("apart").alias("k"))
    few = spark.range(200).select((F.col("id") * 7_000_000 + 3).alias("seq"), F.lit("few").alias("k"))
    rows = apart.union(burst).union(few).repartition(4)
    parts = segments.cut(rows, ["k"], Order("seq"), skew)
    sizes = [r["count"] for r in parts.where("k = 'apart'").groupBy(*segments.PIECES).count().collect()]
    # 24 cells, two of which hold the burst, at most; there the parts, the finer parts, and blocks of 500 numbers.
    assert 12 < len(sizes) <= 24 + 2 * 2 * segments.FAN + 3000 / 500 + 2 and max(sizes) <= skew.hot_rows
    assert parts.where("k = 'few'").select(*segments.PIECES).distinct().count() == 1
    counted = segments.running(rows, ["k"], Order("seq"), [Running("n", "count")], skew)
    assert values(counted) == values(segments.running(rows, ["k"], Order("seq"), [Running("n", "count")], None))


def test_no_task_orders_all_segments(events, tiny, monkeypatch):
    """With groups of two blocks, totals still add up over all groups."""
    monkeypatch.setattr(segments, "GROUP", 2)
    for keys in ([], ["user"]):
        measures = [Running("total", "sum", "v"), Running("last", "last", "v", before=True), Running("top", "max", "v")]
        plain = segments.running(events, keys, Order("seq"), measures, None)
        assert values(segments.running(events, keys, Order("seq"), measures, tiny)) == values(plain)


@pytest.mark.parametrize("step", [1, -1])
@pytest.mark.parametrize("keys", [[], ["user"]])
def test_neighbours(events, tiny, keys, step):
    wanted = {"a": ("v", step), "b": ("ts", 3 * step)}
    plain = segments.neighbours(events, keys, Order("seq", "ts"), wanted, None)
    cut = segments.neighbours(events, keys, Order("seq", "ts"), wanted, tiny)
    assert values(cut) == values(plain)


def _timer_brute(rows, period, act):
    fired, due, seen = [], None, []
    previous = None
    for ts, _, v in rows:
        if due is not None and due <= ts:
            fired.append((due, sum(seen), len(seen)))
            due = None
        kind = act(previous, v)
        if kind == "arm" and due is None:
            due = ts + period
        elif kind == "cancel":
            due = None
        seen.append(v)
        previous = v
    if due is not None:
        fired.append((due, sum(seen), len(seen)))
    return fired


def _by_user(events):
    users = {}
    for r in events.orderBy("ts", "seq").collect():
        users.setdefault(r.user, []).append((r.ts, r.seq, r.v))
    return users


@pytest.mark.parametrize("seconds", [0.5, 2, 10, 60])
def test_timer_average(events, tiny, seconds):
    period = timedelta(seconds=seconds)
    expected = ordered(
        (
            (user, *f)
            for user, rows in _by_user(events).items()
            for f in _timer_brute(rows, period, lambda p, v: "arm")
        )
    )
    for skew in (tiny, None):
        got = timers.timer_average(events, ["user"], "ts", "seq", "v", period, skew)
        assert values(got, "user", "fire_ts", "sum", "count") == expected


@pytest.mark.parametrize("seconds", [0.5, 1, 10])
def test_rising_alert(events, tiny, seconds):
    period = timedelta(seconds=seconds)

    def act(previous, v):
        if previous is None or v < previous:
            return "cancel"
        return "arm" if v > previous else None

    expected = ordered((user, f[0]) for user, rows in _by_user(events).items() for f in _timer_brute(rows, period, act))
    for skew in (tiny, None):
        assert values(timers.rising_alert(events, ["user"], "ts", "seq", "v", period, skew)) == expected


def test_machine_equals_strict_sequence(events, tiny):
    fail = F.col("kind") == "fail"
    event = F.when(fail, "fail").otherwise("success")
    got = machine.run_machine(events, ["user"], "ts", "seq", event, machine.LOGIN_FAILURES, tiny)
    same = machine.run_machine(events, ["user"], "ts", "seq", event, machine.LOGIN_FAILURES, None)
    assert values(got) == values(same)
    steps = {"first": fail, "second": fail, "third": fail}
    strict = patterns.strict_sequence(events, ["user"], "ts", "seq", steps, tiny)
    assert values(strict) == values(patterns.strict_sequence(events, ["user"], "ts", "seq", steps, None))
    third = got.join(events.select("seq", "ts"), "seq").groupBy("user", "ts").count()
    assert values(third) == values(strict.groupBy("user", F.col("third_ts").alias("ts")).count())


def test_running_mean_views(events, tiny):
    got = rolling.running_mean_views(events, "user", "seq", ["kind"], tiny)
    users, views, expected = {}, {}, []
    for r in events.orderBy("seq").collect():
        users.setdefault(r.kind, set()).add(r.user)
        views[r.kind] = views.get(r.kind, 0) + 1
        expected.append((r.seq, views[r.kind] / len(users[r.kind])))
    assert values(got, "seq", "mean_views") == ordered(expected)
