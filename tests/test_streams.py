"""Streams over several micro-batches: the same rows as in batch, however the input is cut."""

import os
import random
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from conftest import ordered, values
from rivulet.operators import joins, machine, patterns, rolling, timers, windows
from rivulet.sinks import keyed
from rivulet.sinks import rows as row_sinks
from rivulet.sources import files
from rivulet.streaming import carried, jobs, ordered as ordered_steps, run, sessions, steps

EPOCH = datetime(1970, 1, 1)
SCHEMA = "seq long, ms long, k string, kind string, v long"
SECOND = timedelta(seconds=1)
END = "end"  # key of a far-future row that lets the watermark pass all others


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    out, at = [], 1_000_000
    for seq in range(240):
        at += rng.choice([10, 400, 900, 3000])
        kind = rng.choice(["fail", "fail", "ok", "create", "pay"])
        out.append((seq, at - rng.choice([0, 0, 500, 1500]), rng.choice("abc"), kind, rng.randint(0, 9)))
    return out


@pytest.fixture(scope="module")
def table(spark, data):
    return spark.createDataFrame(data, SCHEMA).withColumn("ts", F.timestamp_millis("ms"))


def write_files(spark, tmp_path, data, count):
    """One file per micro-batch, in order."""
    size = -(-len(data) // count)
    for i in range(0, len(data), size):
        spark.createDataFrame(data[i : i + size], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.02)


@pytest.fixture
def stream(spark, tmp_path, data):
    far = [(10_000, 10_000_000, END, "end", 0)]
    write_files(spark, tmp_path, data, 4)
    write_files(spark, tmp_path, far, 1)
    schema = spark.createDataFrame([], SCHEMA).schema
    raw = files.table_stream(spark, f"{tmp_path}/in", schema, files_per_trigger=1)
    return raw.withColumn("ts", F.timestamp_millis("ms"))


DELAY = timedelta(seconds=2)


def test_timer_average(stream, table):
    got = run.drained(steps.timer_average(stream, ["k"], "ts", "seq", "v", 7 * SECOND, DELAY), "t")
    want = timers.timer_average(table, ["k"], "ts", "seq", "v", 7 * SECOND)
    assert values(got) == values(want)


def test_rows_that_wait_in_grains(stream, table, monkeypatch):
    """The processor is sent to the tasks, so the limit and the grain are set on what is sent."""
    from rivulet.streaming import ordered as module

    class Grains(module._Processor):
        def __init__(self, steps, keys, fields, grain):
            super().__init__(steps, keys, fields, 700_000)

        def handleInputRows(self, key, rows, timerValues):
            module.LOOSE = 3
            return super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(module, "_Processor", Grains)
    got = run.drained(steps.timer_average(stream, ["k"], "ts", "seq", "v", 7 * SECOND, DELAY), "t")
    assert values(got) == values(timers.timer_average(table, ["k"], "ts", "seq", "v", 7 * SECOND))


def test_rising_alert(stream, table):
    got = run.drained(steps.rising_alert(stream, ["k"], "ts", "seq", "v", 2 * SECOND, DELAY), "t")
    want = timers.rising_alert(table, ["k"], "ts", "seq", "v", 2 * SECOND)
    assert values(got) == values(want)


def test_delay_timers(stream, table):
    got = run.drained(steps.delay_timers(stream, ["k"], "ts", "seq", 5 * SECOND, DELAY), "t")
    assert values(got) == values(timers.delay_timers(table, ["k"], "ts", 5 * SECOND))


def test_patterns(stream, table):
    fail = {n: F.col("kind") == "fail" for n in ("first", "second")}
    got = run.drained(steps.strict_sequence(stream, ["k"], "ts", "seq", fail, DELAY), "t")
    assert values(got) == values(patterns.strict_sequence(table, ["k"], "ts", "seq", fail))

    names = ["one", "two", "three"]
    got = run.drained(steps.repeated(stream, ["k"], "ts", "seq", F.col("kind") != "ok", names, DELAY), "t")
    want = patterns.repeated(table, ["k"], "ts", "seq", F.col("kind") != "ok", names)
    assert values(got) == values(want)


def test_machine(stream, table):
    event = F.when(F.col("kind") == "fail", "fail").otherwise("success")
    args = (["k"], "ts", "seq", event, machine.LOGIN_FAILURES)
    got = run.drained(steps.run_machine(stream, *args, DELAY), "t")
    assert values(got) == values(machine.run_machine(table, *args))


def test_followed_within(stream, table):
    kind = F.col("kind")
    args = (["k"], "ts", "seq", kind == "create", kind == "pay", 3 * SECOND)
    got = run.drained(steps.followed_within(stream, *args, delay=DELAY), "t")
    assert values(got) == values(patterns.followed_within(table, *args))


def test_running_totals(stream, table):
    got = run.drained(steps.running_totals(stream, ["k"], "ts", "seq", "v", DELAY), "t").where(F.col("k") != END)
    totals = {}
    expected = []
    for r in table.orderBy("ts", "seq").collect():
        s, n, m = totals.get(r.k, (0, 0, -1))
        totals[r.k] = s, n, m = s + r.v, n + 1, max(m, r.v)
        expected.append((r.k, r.seq, s, n, m, s / n))
    assert values(got) == ordered(expected)


def test_followers_exactly_at_the_limit(stream, table):
    kind = F.col("kind")
    for limit in (400, 3000):
        args = (["k"], "ts", "seq", kind == "create", kind == "pay", timedelta(milliseconds=limit))
        got = run.drained(steps.followed_within(stream, *args, delay=DELAY, at_limit=True), "t")
        assert values(got) == values(patterns.followed_within(table, *args, at_limit=True))


def _matched(rows, limit):
    """One to one: a row takes the oldest row of the other side that still waits."""
    waiting, out = {}, []
    for key, ts, side in rows:
        queue = waiting.setdefault(key, [])
        while queue and queue[0][0] + limit < ts:
            at, own = queue.pop(0)
            out.append((key, "no_left" if own else "no_right", None if own else at, at if own else None))
        if queue and queue[0][1] != side:
            at, _ = queue.pop(0)
            out.append((key, "matched", *((at, ts) if side else (ts, at))))
        else:
            queue.append((ts, side))
    for key, queue in waiting.items():
        out += [(key, "no_left" if own else "no_right", None if own else at, at if own else None) for at, own in queue]
    return out


def test_reconcile(stream, table):
    """Keys repeat on both sides; some rows wait together, some time out."""
    far = F.col("k") == END
    one = stream.where((F.col("kind") == "create") | far).select("k", F.col("ts").alias("a_ts"))
    two = stream.where((F.col("kind") == "pay") | far).select("k", F.col("ts").alias("b_ts"))
    for seconds in (4, 20):
        got = run.drained(steps.reconcile(one, two, ["k"], "a_ts", "b_ts", seconds * SECOND, DELAY), "t")
        rows = table.where("kind IN ('create', 'pay')").select("k", "ts", (F.col("kind") == "pay").cast("int")).collect()
        want = _matched(sorted(map(tuple, rows), key=lambda r: (r[1], r[2])), seconds * SECOND)
        assert values(got.where(F.col("k") != END)) == ordered(want)
        assert {w[1] for w in want} == {"matched", "no_left", "no_right"}


def test_sessions_come_and_go(stream, table):
    """Rows stay in list state until their session closes, over several micro-batches."""
    got = run.drained(sessions.sessions(stream, ["k"], "ts", F.col("v"), 3 * SECOND, DELAY), "t")
    want, open_ = [], {}
    for r in table.orderBy("ts", "seq").collect():
        held = open_.setdefault(r.k, [])
        if held and r.ts - held[-1][0] >= 3 * SECOND:
            want.append((r.k, held))
            held = open_[r.k] = []
        held.append((r.ts, r.v))
    want = [(k, s[0][0], s[-1][0], len(s), sum(v for _, v in s)) for k, s in [*want, *open_.items()]]
    assert values(got.where(F.col("k") != END)) == ordered(want) and len(want) > 10


def test_values_are_forgotten_after_a_time(spark, tmp_path):
    """The first micro-batch's values are kept in the second, and gone from the state in the third."""
    rows = [(0, 0, "a", "x", 1), (1, 0, "a", "x", 1), (2, 0, "a", "x", 2), (3, 0, "b", "x", 1)]
    memory = timedelta(seconds=30)

    def arrive(number):
        again = [(number * 10 + r[0], *r[1:]) for r in rows] + [(number * 10 + 9, 0, "b", "x", 5 + number)]
        write_files(spark, tmp_path, again, 1)

    def numbers(at_least):
        deadline, found = time.time() + 60, []
        while time.time() < deadline and len(found) < at_least:
            time.sleep(0.5)
            if os.path.exists(tmp_path / "out" / "_spark_metadata"):
                found = values(spark.read.schema(fresh.schema).parquet(f"{tmp_path}/out"), "number")
        return [n for (n,) in found]

    arrive(0)
    df = files.table_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema)
    fresh = sessions.unseen(df, ["k"], "seq", F.col("v"), memory)
    with run.state_settings(spark):
        writer = fresh.writeStream.format("parquet").option("path", f"{tmp_path}/out")
        query = run.start(writer, f"{tmp_path}/c", "500 milliseconds")
        try:
            assert numbers(4) == [0, 2, 3, 9]
            arrive(1)
            assert numbers(5) == [0, 2, 3, 9, 19]
            time.sleep(memory.total_seconds() + 1)
            arrive(2)
            assert numbers(9) == [0, 2, 3, 9, 19, 20, 22, 23, 29]
        finally:
            query.stop()


class _Cell:
    """Value and list state without a store."""

    def __init__(self, store):
        self.store, self.value = store, None

    def exists(self):
        return self.value is not None

    def get(self):
        self.store.calls += 1
        return self.value

    def update(self, value):
        self.store.calls += 1
        self.value = value

    put = update

    def appendList(self, values):
        self.update([*(self.value or []), *values])

    def clear(self):
        self.value = None


class _Cells:
    def __init__(self, store):
        self.store, self.values = store, {}

    def keys(self):
        return list(self.values)

    def getValue(self, key):
        self.store.calls += 1
        return self.values[key]

    def updateValue(self, key, value):
        self.store.calls += 1
        self.values[key] = value

    def removeKey(self, key):
        del self.values[key]


class _Store:
    """Counts what a processor asks of the state store."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def getValueState(self, name, schema):
        return _Cell(self)

    getListState = getValueState

    def getMapState(self, name, key, value):
        return _Cells(self)

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _by_bucket(processor, keys, rows):
    """A bucket's rows (time in ms, key, number, value), watermark after them: calls to the store, frames."""
    store = _Store()
    processor.init(store)
    pdf = pd.DataFrame([(ms * 1000, n, v, k, False) for ms, k, n, v in rows], columns=["at_us", "at_number", "at_value", *keys])
    assert list(processor.handleInputRows((0,), iter([pdf]), _Clock(0))) == []
    frames = []
    while store.timers and min(store.timers) < 10**9:
        due = min(store.timers)
        frames += processor.handleExpiredTimer((0,), _Clock(10**9), None)
        store.timers.discard(due)
    return store.calls, frames


def test_a_bucket_of_keys_costs_a_few_calls_and_frames():
    """A call to the state store or a frame for each key, or for each ten minutes of it, takes longer than all its rows."""
    key = T.StructType.fromDDL("_key0 bigint, _null0 boolean").fields
    names = ["at_key0", "at_null0"]
    rows = [(hour * 3_600_000, user, hour * 300 + user, hour) for hour in range(20) for user in range(300)]
    processor = ordered_steps._Processor(steps._RunningTotals(), key, T.StructType.fromDDL(steps._RunningTotals.schema).fields, 600_000_000)
    calls, frames = _by_bucket(processor, names, rows)
    got = pd.concat(frames)
    assert calls < 20 and len(frames) == 1
    assert sorted(zip(got["number"], got["sum"])) == [(n, hour * (hour + 1) // 2) for hour in range(20) for n in range(hour * 300, hour * 300 + 300)]
    closing = T.StructType.fromDDL("first_us bigint, last_us bigint, count bigint, sum bigint").fields
    calls, frames = _by_bucket(sessions._Sessions(3_600_000_000, key, closing), names, rows)
    assert calls < 20 and len(frames) == 1 and len(frames[0]) == len(rows)


def test_null_and_wide_keys(spark, tmp_path):
    """As floats, 2^53 and 2^53 + 1 would be one key; before, a null key was an error."""
    wide = 2**53
    rows = [(i, 1000 + i * 1000, (wide, wide + 1, None)[i % 3], i) for i in range(30)] + [(99, 10_000_000, -1, 0)]
    schema = "seq long, ms long, k long, v long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in").withColumn("ts", F.timestamp_millis("ms"))
    got = run.drained(steps.running_totals(stream, ["k"], "ts", "seq", "v", DELAY), "t").where("k IS NULL OR k > 0")
    want = [(k, i, sum(range(at, i + 1, 3)), i // 3 + 1) for at, k in enumerate((wide, wide + 1, None)) for i in range(at, 30, 3)]
    assert got.schema["k"].dataType.simpleString() == "bigint"
    assert values(got, "k", "seq", "sum", "count") == ordered(want)
    got = run.drained(sessions.sessions(stream, ["k"], "ts", F.col("v"), 5 * SECOND, DELAY), "t").where("k IS NULL OR k > 0")
    want = [(k, 10, sum(range(at, 30, 3))) for at, k in enumerate((wide, wide + 1, None))]
    assert values(got, "k", "count", "sum") == ordered(want)


def test_inner_join(stream, table):
    def sides(df):
        return [
            df.where(F.col("kind") == kind).select("k", F.col("seq").alias(name)) for kind, name in (("create", "a"), ("pay", "b"))
        ]

    want = values(joins.inner_join(*sides(table), ["k"]), "k", "a", "b")
    for grid in ((1, 1), (3, 2)):
        assert values(run.drained(jobs.inner_join(*sides(stream), ["k"], ("a", "b"), grid), "t"), "k", "a", "b") == want


def test_united_streams_need_the_slowest_watermark(spark, stream):
    name = "spark.sql.streaming.multipleWatermarkPolicy"
    spark.conf.set(name, "max")
    try:
        with pytest.raises(ValueError):
            jobs.union_counts([stream, stream], "ts", 5 * SECOND, DELAY)
    finally:
        spark.conf.unset(name)


def test_windows_and_joins(stream, table):
    counts = run.drained(jobs.tumbling_counts(stream, "ts", 5 * SECOND, DELAY, ["k"]), "t")
    assert values(counts) == values(windows.tumbling(table, "ts", 5 * SECOND, ["k"]))
    sliding = run.drained(jobs.sliding_counts(stream, "ts", 6 * SECOND, 2 * SECOND, DELAY, []), "t")
    assert values(sliding) == values(windows.sliding_counts(table, "ts", 6 * SECOND, 2 * SECOND))

    def side(df, kind, name):
        return df.where(F.col("kind").isin(kind, "end")).select("k", F.col("seq").alias(name), F.col("ts").alias(f"{name}_ts"))

    args = (["k"], "a_ts", "b_ts", -2 * SECOND, 3 * SECOND)
    got = run.drained(jobs.interval_join(side(stream, "create", "a"), side(stream, "pay", "b"), *args, DELAY), "t")
    want = joins.interval_join(side(table, "create", "a"), side(table, "pay", "b"), *args)
    assert values(got.where(F.col("k") != END)) == values(want)


def test_rolling_and_mean_views_over_batches(spark, stream, table, tmp_path, tiny):
    def write(name):
        return lambda batch, i: batch.where(F.col("k") != END).write.mode("overwrite").parquet(f"{tmp_path}/{name}/b={i}")

    for skew in (None, tiny):
        tag = "plain" if skew is None else "cut"
        with run.state_settings(spark):
            writer = carried.rolling_totals(stream, ["k"], "v", "seq", f"{tmp_path}/{tag}s1", write(f"{tag}1"), skew)
            run.run_available(writer, f"{tmp_path}/{tag}c1")
            writer = carried.mean_views(stream, "k", "seq", f"{tmp_path}/{tag}s2", write(f"{tag}2"), None, skew)
            run.run_available(writer, f"{tmp_path}/{tag}c2")
        got = spark.read.parquet(f"{tmp_path}/{tag}1")
        want = rolling.rolling_average(table, ["k"], "v", "seq")
        assert values(got, "seq", "average") == values(want, "seq", "average")
        largest = rolling.rolling_max(table, ["k"], "v", "seq")
        assert values(got, "seq", "max") == values(largest, "seq", "max")
        got = spark.read.parquet(f"{tmp_path}/{tag}2")
        assert values(got, "seq", "mean_views") == values(rolling.running_mean_views(table, "k", "seq"), "seq", "mean_views")


def test_dynamic_filter_over_batches(spark, stream, table, tmp_path):
    def split(df):
        queries = df.where("kind = 'fail'").select("seq", F.col("v").alias("query"))
        return df.where("kind <> 'fail'").select("seq", "v"), queries

    def write(batch, i):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/b={i}")

    with run.state_settings(spark):
        writer = carried.filtered_by_latest(*split(stream), "v", "query", "seq", f"{tmp_path}/state", write)
        run.run_available(writer, f"{tmp_path}/c")
    got = spark.read.parquet(f"{tmp_path}/out").where("seq < 10000")
    assert values(got, "seq", "v") == values(joins.dynamic_filter(*split(table), "v", "query", "seq"))


def test_machine_clock(spark, tmp_path, data):
    write_files(spark, tmp_path, data, 2)
    schema = spark.createDataFrame([], SCHEMA).schema
    df = files.table_stream(spark, f"{tmp_path}/in", schema, files_per_trigger=1)
    averages = steps.timer_average(df, ["k"], None, "seq", "v", SECOND)
    rises = steps.rising_alert(df, ["k"], None, "seq", "v", timedelta(milliseconds=1))
    with run.state_settings(spark):
        for name, out in (("avg", averages), ("rise", rises)):
            query = (
                out.writeStream.format("parquet")
                .option("path", f"{tmp_path}/{name}")
                .option("checkpointLocation", f"{tmp_path}/c{name}")
                .trigger(processingTime="500 milliseconds")
                .start()
            )
            deadline = time.time() + 60
            while time.time() < deadline and not (
                query.lastProgress and query.lastProgress["batchId"] >= 4 and (name == "rise" or _rows(spark, f"{tmp_path}/{name}", out) >= 3)
            ):
                time.sleep(0.3)
            query.stop()
            assert query.exception() is None
    fired = spark.read.schema(averages.schema).parquet(f"{tmp_path}/avg")
    by_key = {k: sum(1 for r in data if r[2] == k) for k in "abc"}
    last = {r.k: r["count"] for r in fired.groupBy("k").agg(F.max("count").alias("count")).collect()}
    assert set(last) == set("abc") and all(0 < last[k] <= by_key[k] for k in last)


def _rows(spark, path, like):
    try:
        return spark.read.schema(like.schema).parquet(path).select("k").distinct().count()
    except Exception:
        return 0


def test_arrival_windows_on_the_machine_clock(stream):
    counts = windows.arrival_windows(stream, timedelta(hours=1), ["k"])
    updates = run.drained(counts, "t", mode="update")
    assert updates.groupBy("k").agg(F.max("count")).count() == 4


def test_upserts_and_two_outputs(spark, stream, table, tmp_path):
    writes = stream.where(F.col("k") != END).select("k", "v", "seq")
    with run.state_settings(spark):
        writer = writes.writeStream.foreachBatch(
            lambda batch, i: keyed.append_batch(batch, i, f"{tmp_path}/kv", ["k"], "seq")
        )
        run.run_available(writer, f"{tmp_path}/c1")
        tagged = stream.withColumn("output", F.when(F.col("kind") == "ok", "main").otherwise("late"))
        sinks = [
            (lambda name: lambda batch, i: batch.write.mode("overwrite").parquet(f"{tmp_path}/{name}/b={i}"))(n)
            for n in ("main", "side")
        ]
        run.run_available(row_sinks.two_outputs(tagged, *sinks), f"{tmp_path}/c2")
    want = table.groupBy("k").agg(F.max_by("v", "seq"))
    assert values(keyed.read_upserted(spark, f"{tmp_path}/kv", ["k"], "seq"), "k", "v") == values(want)
    assert spark.read.parquet(f"{tmp_path}/main").count() == table.where("kind = 'ok'").count()
    assert spark.read.parquet(f"{tmp_path}/side").count() == table.where("kind <> 'ok'").count() + 1


def test_a_stopped_stream_goes_on_where_it_was(spark, tmp_path, data):
    schema = spark.createDataFrame([], SCHEMA).schema

    def count():
        df = files.table_stream(spark, f"{tmp_path}/in", schema).withColumn("ts", F.timestamp_millis("ms"))
        out = jobs.tumbling_counts(df, "ts", 5 * SECOND, DELAY, ["k"])
        with run.state_settings(spark):
            run.run_available(out.writeStream.format("parquet").option("path", f"{tmp_path}/out"), f"{tmp_path}/c")

    write_files(spark, tmp_path, data[:100], 1)
    count()
    write_files(spark, tmp_path, data[100:] + [(10_000, 10_000_000, END, "end", 0)], 1)
    count()
    table = spark.createDataFrame(data, SCHEMA).withColumn("ts", F.timestamp_millis("ms"))
    want = windows.tumbling(table, "ts", 5 * SECOND, ["k"])
    assert values(spark.read.parquet(f"{tmp_path}/out")) == values(want)


def test_table_of_several_files_as_a_stream(spark, tmp_path):
    whole = spark.range(30).withColumn("ts", F.timestamp_seconds(F.col("id") * 60))
    whole.repartition(3).write.parquet(f"{tmp_path}/many.parquet")
    single = spark.createDataFrame(whole.toPandas(), whole.schema).toPandas()
    single.to_parquet(f"{tmp_path}/one.parquet", coerce_timestamps="us")
    for name in ("many", "one"):
        end = run.Ending(spark)
        stream = end.after(files.table_stream(spark, str(tmp_path), whole.schema, glob=f"{name}.parquet"))
        counts = jobs.tumbling_counts(stream, "ts", timedelta(minutes=10), timedelta(hours=1), [])
        rows = run.drained(counts, f"several-{name}", end=end).collect()
        assert sorted(r["count"] for r in rows) == [10, 10, 10]
