"""Small literal inputs whose results follow from the rules of each operator."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import ordered, values
from rivulet import schemas
from rivulet.functions import rows, time
from rivulet.functions.lifecycle import map_with_setup
from rivulet.operators import (
    changelog,
    distinct,
    folds,
    joins,
    machine,
    patterns,
    ranking,
    redistribute,
    rolling,
    timers,
    upsert,
    watermarks,
    windows,
)

SECOND = timedelta(seconds=1)
EPOCH = datetime(1970, 1, 1)


def at(seconds):
    return EPOCH + timedelta(seconds=seconds)


def timed(df, column="timestamp"):
    return df.withColumn("ts", F.timestamp_millis(column)).withColumn("seq", F.monotonically_increasing_id())


def test_word_count_rolls(spark):
    lines = spark.createDataFrame([(0, "hello world"), (1, "hello world")], "seq long, line string")
    words = rows.tokenize_in_order(lines, "line", "seq")
    counted = rolling.rolling_count(words, ["word"], "word_seq").orderBy("word_seq")
    assert [(r["word"], r["count"]) for r in counted.collect()] == [
        ("hello", 1),
        ("world", 1),
        ("hello", 2),
        ("world", 2),
    ]


@pytest.mark.parametrize(
    "line, expected",
    [("a b", ["a", "b"]), ("a  b", ["a", "", "b"]), ("a b  ", ["a", "b"]), (" a", ["", "a"]), ("", [""])],
)
def test_tokens(spark, line, expected):
    words = rows.tokenize(spark.createDataFrame([(line,)], schemas.LINE), "line")
    assert [r.word for r in words.collect()] == expected


def test_rolling_sum_and_max(spark):
    pairs = spark.createDataFrame([(0, 1, 2), (1, 1, 3), (2, 2, 4), (3, 2, 5)], "seq long, k int, v int")
    assert values(rolling.rolling_sum(pairs, ["k"], "v", "seq"), "k", "sum") == [(1, 2), (1, 5), (2, 4), (2, 9)]
    assert values(rolling.rolling_max(pairs, ["k"], "v", "seq"), "k", "max") == [(1, 2), (1, 3), (2, 4), (2, 5)]


def test_sum_by_parity(spark):
    ints = spark.createDataFrame([(i, i, i % 2) for i in range(1, 6)], "seq long, v int, k int")
    assert values(rolling.rolling_sum(ints, ["k"], "v", "seq"), "k", "sum") == [
        (0, 2),
        (0, 6),
        (1, 1),
        (1, 4),
        (1, 9),
    ]


def test_copies(spark):
    colors = spark.createDataFrame([("white",), ("black",), ("gray",)], "c string")
    assert values(rows.replicate(colors, "c", {"white": 1, "black": 2})) == [("black",), ("black",), ("white",)]
    four = spark.createDataFrame([(i,) for i in range(1, 5)], "v int")
    assert redistribute.copied(four, 2).count() == 8
    for placed in (redistribute.rebalanced(four, 2), redistribute.shuffled(four, 2), redistribute.by_key(four, ["v"], 2)):
        assert values(placed) == [(1,), (2,), (3,), (4,)]
        assert placed.rdd.getNumPartitions() == 2
    assert redistribute.with_parallelism(redistribute.rebalanced(four, 4), 1).rdd.getNumPartitions() == 1


def test_squares_with_setup(spark):
    ints = spark.createDataFrame([(1,), (2,), (3,)], "v long")
    assert values(rows.squared(ints, "v"), "square") == [(1,), (4,), (9,)]
    mapped = map_with_setup(ints, lambda: {"power": 2}, lambda r, pdf: pdf ** r["power"], "v long", lambda r: r.clear())
    assert values(mapped) == [(1,), (4,), (9,)]


def test_union_keeps_duplicates(spark):
    a, b, c = (spark.createDataFrame([(i,) for i in v], "v int") for v in ([1, 2], [3, 9], [5, 6]))
    assert values(joins.union(a, b, c)) == [(i,) for i in (1, 2, 3, 5, 6, 9)]
    assert joins.union(a, a).count() == 4


PUNCTUATED = "seq long, kind string, word string, ms long, wm long"


def punctuated(spark, data):
    df = spark.createDataFrame(data, PUNCTUATED)
    df = df.withColumn("ts", F.timestamp_millis("ms")).withColumn("mark", F.timestamp_millis("wm"))
    return watermarks.with_punctuated_watermark(df, "seq", F.col("kind") == "watermark", "mark")


def test_late_rows_to_side_output(spark):
    marked = punctuated(
        spark,
        [
            (0, "data", "hello world", 1000, None),
            (1, "watermark", None, None, 999),
            (2, "data", "hello flow", 2000, None),
            (3, "watermark", None, None, 1999),
            (4, "data", "hello late", 1000, None),
        ],
    )
    main, late = watermarks.outputs(watermarks.route_late(marked, "ts"), "main", "late")
    assert values(main, "word") == [("hello flow",), ("hello world",)]
    assert values(late, "word") == [("hello late",)]


def test_window_drops_late_rows(spark):
    marked = punctuated(
        spark,
        [
            (0, "data", "a", 1000, None),
            (1, "watermark", None, None, 999),
            (2, "data", "b", 2000, None),
            (3, "watermark", None, None, 1999),
            (4, "data", "c", 4000, None),
            (5, "watermark", None, None, 4999),
            (6, "data", "d", 3000, None),
        ],
    )
    arrivals = watermarks.window_arrivals(marked, "ts", 5 * SECOND)
    on_time = arrivals.where("arrival = 'on_time'").groupBy("window_start").count()
    assert values(on_time) == [(at(0), 3)]
    assert values(arrivals.where("arrival = 'dropped'"), "word") == [("d",)]


def test_lateness_is_strict(spark):
    data = [(0, 10_000), (1, 9_999), (2, 9_998), (3, 10_000)]
    df = spark.createDataFrame(data, "seq long, ms long").withColumn("ts", F.timestamp_millis("ms"))
    tagged = watermarks.tag_late(watermarks.with_watermark(df, "ts", "seq", timedelta(0)), "ts")
    assert values(tagged, "seq", "late") == [(0, False), (1, False), (2, True), (3, False)]


def test_allowed_lateness_fires_again(spark, tiny):
    seconds = [1, 2, 10, 3, 4, 15, 4, 11, 30]
    df = spark.createDataFrame([(i, "a", s * 1000) for i, s in enumerate(seconds)], "seq long, k string, ms long")
    marked = watermarks.with_watermark(df.withColumn("ts", F.timestamp_millis("ms")), "ts", "seq", 5 * SECOND)
    arrivals = watermarks.window_arrivals(marked, "ts", 5 * SECOND, 5 * SECOND)
    # After 10 the watermark is 4.999: window [0, 5) has fired. After 15 it is 9.999: that window is gone.
    assert values(arrivals.where("arrival = 'dropped'"), "seq") == [(6,)]
    for skew in (tiny, None):
        fired = watermarks.window_firings(arrivals, ["k"], "seq", skew)
        assert values(fired, "window_start", "firing", "first", "count") == [
            (at(0), 1, True, 2),
            (at(0), 2, False, 3),
            (at(0), 3, False, 4),
            (at(10), 1, True, 2),
            (at(15), 1, True, 1),
            (at(30), 1, True, 1),
        ]


def test_union_watermark_is_the_least(spark):
    data = [(0, "a", 5), (1, "a", 9), (2, "b", 3), (3, "b", 20), (4, "a", 9)]
    df = spark.createDataFrame(data, "seq long, src string, s long").withColumn("ts", F.timestamp_seconds("s"))
    marked = watermarks.with_union_watermark(df, "ts", "seq", timedelta(0), "src", ["a", "b"])
    ms = timedelta(milliseconds=1)
    assert values(marked, "seq", "watermark") == [
        (0, None),
        (1, None),
        (2, None),
        (3, at(3) - ms),
        (4, at(9) - ms),
    ]


def test_inner_join(spark, tiny):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("a", 2)], "id string, n int")
    right = spark.createDataFrame([("a", "a"), ("b", "b"), ("a", "aaa"), ("c", "ccc")], "id string, s string")
    expected = [("a", 1, "a"), ("a", 1, "aaa"), ("a", 2, "a"), ("a", 2, "aaa"), ("b", 2, "b")]
    assert values(joins.inner_join(left, right, ["id"])) == expected
    assert values(joins.inner_join(left, right, ["id"], spread_by=("n", "s"), skew=tiny)) == expected


@pytest.mark.parametrize("hot", ["left", "right", "both"])
def test_inner_join_of_hot_keys(spark, tiny, hot):
    def side(name, is_hot):
        data = [(i, "h" if is_hot and i % 3 else f"k{i % 7}") for i in range(90)] + [(90, "h"), (91, None)]
        return spark.createDataFrame(data, f"{name} long, k string")

    left, right = side("a", hot != "right"), side("b", hot != "left")
    salted = joins.inner_join(left, right, ["k"], spread_by=("a", "b"), skew=tiny, salts=4)
    assert values(salted) == values(left.join(right, ["k"]))


def minutes(spark, data, name):
    df = spark.createDataFrame(data, f"userId string, {name}_min long")
    return df.select("userId", F.timestamp_seconds(F.col(f"{name}_min") * 60).alias(f"{name}_ts"))


def test_interval_join(spark, tiny):
    order = minutes(spark, [("user-1", 20)], "order")
    views = minutes(spark, [("user-1", m) for m in (5, 10, 12, 22, 25, 26)], "view")
    low, high = timedelta(minutes=-10), timedelta(minutes=5)
    forward = joins.interval_join(order, views, ["userId"], "order_ts", "view_ts", low, high)
    assert values(forward, "view_ts") == [(at(60 * m),) for m in (10, 12, 22, 25)]
    backward = joins.interval_join(views, order, ["userId"], "view_ts", "order_ts", -high, -low)
    assert values(backward, "view_ts") == values(forward, "view_ts")
    open_ends = joins.interval_join(order, views, ["userId"], "order_ts", "view_ts", low, high, inclusive=False)
    assert values(open_ends, "view_ts") == [(at(60 * m),) for m in (12, 22)]


def test_window_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 1)], "id string, l long")
    right = spark.createDataFrame([("a", 2), ("b", 2), ("b", 4999), ("b", 5000)], "id string, r long")
    left, right = (
        df.withColumn(f"{c}_ts", F.timestamp_millis(c)) for df, c in ((left, "l"), (right, "r"))
    )
    joined = joins.window_join(left, right, ["id"], "l_ts", "r_ts", 5 * SECOND)
    assert values(joined, "id", "l", "r") == [("a", 1, 2), ("b", 1, 2), ("b", 1, 4999)]


def test_dynamic_filter(spark, tiny):
    clicks = spark.createDataFrame(
        [(0, "./home"), (2, "./home"), (3, "./cart"), (5, "./home"), (6, "./cart")], "seq long, url string"
    )
    queries = spark.createDataFrame([(1, "./home"), (4, "./cart")], "seq long, query string")
    for skew in (tiny, None):
        assert values(joins.dynamic_filter(clicks, queries, "url", "query", "seq", skew)) == [
            (2, "./home"),
            (6, "./cart"),
        ]


def test_reconcile(spark):
    orders = spark.createDataFrame([("o1", 1), ("o2", 2), ("o4", 1)], "id string, o long")
    pays = spark.createDataFrame([("o1", 3), ("o3", 4), ("o4", 6), ("o5", 1)], "id string, p long")
    orders, pays = (
        df.select("id", F.timestamp_seconds(c).alias(f"{c}_ts")) for df, c in ((orders, "o"), (pays, "p"))
    )
    got = joins.reconcile(orders, pays, ["id"], "o_ts", "p_ts", 5 * SECOND)
    assert values(got, "id", "status") == [
        ("o1", "matched"),
        ("o2", "no_right"),
        ("o3", "no_left"),
        ("o4", "matched"),
        ("o5", "no_left"),
    ]
    late = joins.reconcile(orders, pays, ["id"], "o_ts", "p_ts", 4 * SECOND).where("id = 'o4'")
    assert values(late, "status", "o_ts", "p_ts") == [("no_left", None, at(6)), ("no_right", at(1), None)]


LOGINS = [
    ("user-1", "fail", 1000),
    ("user-1", "fail", 2000),
    ("user-1", "fail", 3000),
    ("user-2", "success", 3000),
    ("user-1", "fail", 4000),
    ("user-3", "fail", 1000),
    ("user-3", "success", 2000),
    ("user-3", "fail", 3000),
    ("user-3", "fail", 4000),
]


def test_failed_logins(spark):
    logins = timed(spark.createDataFrame(LOGINS, schemas.LOGIN_EVENT))
    fail = F.col("eventType") == "fail"
    steps = {n: fail for n in ("first", "second", "third")}
    strict = patterns.strict_sequence(logins, ["user"], "ts", "seq", steps)
    both = [("user-1", at(1), at(2), at(3)), ("user-1", at(2), at(3), at(4))]
    assert values(strict) == both
    times = patterns.repeated(logins, ["user"], "ts", "seq", fail, list(steps))
    assert values(times) == [*both, ("user-3", at(1), at(3), at(4))]
    alerts = machine.run_machine(logins, ["user"], "ts", "seq", F.col("eventType"), machine.LOGIN_FAILURES)
    assert values(alerts.groupBy("user").count()) == [("user-1", 2)]


def test_pay_within(spark):
    data = [
        ("order-1", "create", 1000),
        ("order-2", "create", 2000),
        ("order-1", "pay", 3000),
        ("order-3", "create", 1000),
        ("order-3", "pay", 6000),
        ("order-4", "create", 1000),
        ("order-4", "other", 2000),
        ("order-4", "pay", 3000),
        ("order-5", "create", 1000),
        ("order-5", "create", 2000),
        ("order-5", "pay", 3000),
    ]
    events = timed(spark.createDataFrame(data, schemas.ORDER_EVENT))
    kind = F.col("eventType")

    def run(at_limit):
        return patterns.followed_within(
            events, ["orderId"], "ts", "seq", kind == "create", kind == "pay", 5 * SECOND, at_limit
        )

    assert values(run(False), "orderId", "output") == [
        ("order-1", "match"),
        ("order-2", "timeout"),
        ("order-3", "timeout"),
        ("order-5", "match"),
    ]
    assert ("order-3", "match") in values(run(True), "orderId", "output")


def test_group_count_changelog(spark):
    users = ["Mary", "Bob", "Mary", "Liz", "Bob", "Mary"]
    clicks = spark.createDataFrame([(i, u) for i, u in enumerate(users)], "seq long, user string")
    changes = changelog.rolling_changelog(clicks, ["user"], "seq").orderBy("change_seq", F.desc("row_kind"))
    assert [(r.user, r.change_seq, r.row_kind, r["count"]) for r in changes.collect()] == [
        ("Mary", 0, "+I", 1),
        ("Bob", 1, "+I", 1),
        ("Mary", 2, "-U", 1),
        ("Mary", 2, "+U", 2),
        ("Liz", 3, "+I", 1),
        ("Bob", 4, "-U", 1),
        ("Bob", 4, "+U", 2),
        ("Mary", 5, "-U", 2),
        ("Mary", 5, "+U", 3),
    ]


def test_changelog_skips_nulls(spark):
    clicks = spark.createDataFrame([(0, "a", None), (1, "a", "x"), (2, "a", None)], "seq long, user string, url string")
    changes = changelog.rolling_changelog(clicks, ["user"], "seq", counted="url")
    assert values(changes, "change_seq", "row_kind", "count") == [(0, "+I", 0), (1, "+U", 1), (1, "-U", 0)]


def test_changelog_between(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, n int")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("c", 4), ("d", 5)], "k string, n int").where("k <> 'x'")
    changes = changelog.changelog_between(old, new, ["k"], ["n"])
    assert values(changes) == ordered(
        [("b", "-U", 2), ("b", "+U", 3), ("c", "-U", None), ("c", "+U", 4), ("d", "+I", 5)]
    )
    assert values(changelog.changelog_between(new, old, ["k"], ["n"]).where("k = 'd'")) == [("d", "-D", 5)]


def test_tumbling_hour(spark):
    minutes_of_day = [
        ("Mary", 720), ("Bob", 720), ("Mary", 722), ("Mary", 775), ("Bob", 781), ("Liz", 810),
        ("Liz", 839), ("Mary", 840), ("Liz", 842), ("Bob", 870), ("Bob", 880),
    ]
    clicks = spark.createDataFrame(minutes_of_day, "user string, m long")
    clicks = clicks.withColumn("ts", F.timestamp_seconds(F.col("m") * 60))
    counts = windows.tumbling(clicks, "ts", timedelta(hours=1), ["user"])
    assert values(counts, F.hour("window_end"), "user", "count") == [
        (13, "Bob", 1),
        (13, "Mary", 3),
        (14, "Bob", 1),
        (14, "Liz", 2),
        (15, "Bob", 2),
        (15, "Liz", 1),
        (15, "Mary", 1),
    ]


def test_window_edges_and_panes(spark):
    seconds = [0, 4.999, 5, 9, 10]
    df = spark.createDataFrame([("a", float(s)) for s in seconds], "k string, s double")
    df = df.withColumn("ts", F.timestamp_millis((F.col("s") * 1000).cast("long")))
    assert values(windows.tumbling(df, "ts", 5 * SECOND, ["k"]), "window_start", "count") == [
        (at(0), 2),
        (at(5), 2),
        (at(10), 1),
    ]
    for size, slide in ((10, 4), (6, 6), (9, 2)):
        sliding = windows.sliding_counts(df, "ts", size * SECOND, slide * SECOND, ["k"])
        direct = df.groupBy(F.window("ts", f"{size} seconds", f"{slide} seconds"), "k").count()
        assert values(sliding) == values(direct.select("k", "window.start", "window.end", "count"))


def test_top_n_with_few_items_and_ties(spark):
    counts = spark.createDataFrame(
        [(1, "b", 5), (1, "a", 5), (1, "c", 9), (1, "d", 1), (2, "x", 1)], "w int, item string, count long"
    )
    assert values(ranking.top_n(counts, 3, ["w"]), "w", "rank", "item") == [
        (1, 1, "c"),
        (1, 2, "a"),
        (1, 3, "b"),
        (2, 1, "x"),
    ]
    assert [r.item for r in ranking.by_count(counts).collect()] == ["c", "a", "b", "d", "x"]


def test_upsert(spark):
    writes = spark.createDataFrame([(0, "key", 1), (1, "key", 2), (2, "new", 7)], "seq long, k string, v int")
    target = spark.createDataFrame([("key", 0), ("old", 3)], schemas.KEY_VALUE)
    assert values(upsert.latest_per_key(writes, ["k"], "seq"), "k", "v") == [("key", 2), ("new", 7)]
    updates, inserts = upsert.split_upsert(writes, target, ["k"], "seq")
    assert (values(updates, "k", "v"), values(inserts, "k", "v")) == ([("key", 2)], [("new", 7)])
    assert values(upsert.upserted(target, writes, ["k"], "seq")) == [("key", 2), ("new", 7), ("old", 3)]


def test_parsing_and_time(spark):
    lines = spark.createDataFrame([("a 3",), ("b",)], schemas.LINE)
    assert values(rows.parse_pairs(lines, "line")) == [("a", 3000), ("b", None)]
    assert values(rows.parse_pairs(lines, "line", unit="ms")) == [("a", 3), ("b", None)]
    df = spark.createDataFrame([(7_200_123,)], "ms long")
    assert df.select(time.millis_text(F.col("ms"))).first()[0] == "1970-01-01 02:00:00.123"
    assert df.select(time.window_start_millis(F.col("ms"), 5 * SECOND)).first()[0] == 7_200_000


def test_delay_timers(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "k string, s long")
    fired = timers.delay_timers(df.withColumn("ts", F.timestamp_seconds("s")), ["k"], "ts", 5 * SECOND)
    assert values(fired) == [("a", at(6)), ("a", at(7)), ("b", at(6))]


def test_user_aggregate_merges(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(7)
    folded = folds.user_aggregate(
        df, ["k"], "id", lambda: [0, 0], lambda a, v: [a[0] + v, a[1] + 1], lambda a, b: [a[0] + b[0], a[1] + b[1]], held=2
    )
    expected = [(k, [sum(range(k, 1000, 3)), len(range(k, 1000, 3))]) for k in range(3)]
    assert values(folded) == expected


def test_user_aggregate_merges_many_keys(spark, capsys):
    """Partial accumulators are not merged in a frame per key; keys go on over frames, null is one key."""
    df = spark.range(600).repartition(5).selectExpr("double(if(id % 4 = 1, id % 8, null)) AS k", "id % 3 AS j", "id")
    folded = folds.user_aggregate(
        df, ["k", "j"], "id", lambda: [0, 0], lambda a, v: [a[0] + v, a[1] + 1], lambda a, b: [a[0] + b[0], a[1] + b[1]], held=2, frame_rows=1
    )
    folded.explain()
    assert "FlatMapGroupsInPandas" not in capsys.readouterr().out
    got = sorted((repr(k), j, a) for k, j, a in folded.collect())
    want = {}
    for i in range(600):
        a = want.setdefault((repr(float(i % 8) if i % 4 == 1 else None), i % 3), [0, 0])
        a[:] = [a[0] + i, a[1] + 1]
    assert got == sorted((*k, a) for k, a in want.items()) and len(got) == 9


def test_null_keys_of_snapshots_are_equal(spark):
    a = spark.createDataFrame([(None, 1), (1, 2)], "k bigint, n bigint")
    b = spark.createDataFrame([(None, 5), (2, 3)], "k bigint, n bigint")
    assert changelog.changelog_between(a, a, ["k"], ["n"]).collect() == []
    changes = {tuple(r) for r in changelog.changelog_between(a, b, ["k"], ["n"]).collect()}
    assert changes == {(None, "-U", 1), (None, "+U", 5), (1, "-D", 2), (2, "+I", 3)}
    batch = b.withColumn("seq", F.lit(1))
    assert {tuple(r) for r in upsert.upserted(a, batch, ["k"], "seq").collect()} == {(None, 5), (1, 2), (2, 3)}
    updates, inserts = upsert.split_upsert(batch, a, ["k"], "seq")
    assert [r.k for r in updates.collect()] == [None] and [r.k for r in inserts.collect()] == [2]


WIDE = 2**53


@pytest.mark.parametrize("cut", [True, False])
def test_wide_keys_beside_null_keys(spark, tiny, cut):
    """As floats, 2^53 and 2^53 + 1 would be one key."""
    keys = [WIDE, WIDE + 1, None]
    rows = [(seq, keys[seq % 3], seq * 100, "fail" if seq % 12 < 9 else "ok", seq) for seq in range(60)]
    df = spark.createDataFrame(rows, "seq long, k long, ms long, kind string, v long").withColumn("ts", F.timestamp_millis("ms"))
    skew = tiny if cut else None
    event = F.when(F.col("kind") == "fail", "fail").otherwise("success")
    got = machine.run_machine(df, ["k"], "ts", "seq", event, machine.LOGIN_FAILURES, skew)
    want = []
    for key in keys:
        streak = 0
        for seq, k, _, kind, _ in rows:
            if k == key:
                streak = streak + 1 if kind == "fail" else 0
                if streak >= 3:
                    want.append((key, seq, "S2"))
    assert got.schema["k"].dataType.simpleString() == "bigint"
    assert values(got) == sorted(want, key=lambda r: [(v is not None, v) for v in r]) and len({w[0] for w in want}) == 3
    fired = timers.timer_average(df, ["k"], "ts", "seq", "v", SECOND, skew)
    assert {r.k for r in fired.collect()} == set(keys)
    folded = folds.user_aggregate(
        df.withColumn("v", F.when(F.col("v") != 1, F.col("v") + WIDE)),
        ["k"],
        "v",
        lambda: [0, 0],
        lambda a, v: [a[0] + (v is None), max(a[1], v or 0)],
        lambda a, b: [a[0] + b[0], max(a[1], b[1])],
    )
    assert dict(map(tuple, folded.collect())) == {WIDE: [0, WIDE + 57], WIDE + 1: [1, WIDE + 58], None: [0, WIDE + 59]}


def test_machine_over_long_keys(spark):
    """Rows are followed in lines that move on together; one by one gives the same."""
    moves = {(s, e): (n, e == "c") for s, e, n in (("p", "a", "q"), ("q", "b", "r"), ("r", "c", "p"), ("q", "c", "p"), ("r", "a", "r"))}
    three = machine.Machine(moves)
    rows = [(i, "abcd"[(i * i + i // 7) % 4]) for i in range(1009)]
    df = spark.createDataFrame(rows, "seq long, kind string").withColumn("ts", F.timestamp_millis("seq")).withColumn("k", F.lit(1))
    state, want = "p", []
    for seq, kind in rows:
        target, gives = moves.get((state, kind), (state, False))
        state = target
        if gives:
            want.append((1, seq, state))
    assert values(machine.run_machine(df, ["k"], "ts", "seq", F.col("kind"), three)) == want and want


def test_visitor_sketches(spark):
    rows = spark.range(40_000).select(F.timestamp_seconds(F.col("id") % 7200).alias("ts"), (F.col("id") % 9000).alias("user"))
    hour = timedelta(hours=1)
    for error in (0.1, 0.01):
        near = distinct.sketch_unique_visitors(rows, "ts", "user", hour, timedelta(minutes=30), error)
        exact = rows.groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count_distinct("user").alias("n"))
        both = near.join(exact, near.window_start == exact.w.start).collect()
        assert len(both) == exact.count() > 2
        assert all(abs(r.visitors - r.n) <= 4 * error * r.n for r in both)
    assert distinct.sketch_size(0.01) > distinct.sketch_size(0.1)
    with pytest.raises(ValueError):
        distinct.sketch_size(0)


def test_a_filter_that_is_too_small_says_so(spark):
    rows = spark.range(3000).select(F.timestamp_seconds(F.lit(5)).alias("ts"), F.col("id").alias("user"))
    assert abs(distinct.bloom_unique_visitors(rows, "ts", "user", SECOND, items=5000).first().visitors - 3000) < 100
    for items in (2000, 20):
        with pytest.raises(Exception, match="make its filter larger"):
            distinct.bloom_unique_visitors(rows, "ts", "user", SECOND, items=items).collect()


def test_equal_rows_are_spread_too(spark):
    same = spark.range(8000).select(F.lit("x").alias("v"), F.lit(None).cast("int").alias("n"))
    sizes = [r["count"] for r in redistribute.placed(redistribute.shuffled(same, 4)).groupBy("subtask").count().collect()]
    assert len(sizes) == 4 and min(sizes) > 1500 and sum(sizes) == 8000
    for wanted in (2, 24):
        given = redistribute.with_parallelism(same, wanted)
        assert given.rdd.getNumPartitions() == wanted and given.count() == 8000
