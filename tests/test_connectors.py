"""Sources and sinks. Clients that are not here are stood in for by objects that record calls."""

import os
import subprocess
import sys
import uuid
from datetime import datetime

import pytest
from pyspark.sql import Row, functions as F

from conftest import values
from rivulet import schemas
from rivulet.functions.rows import window_message
from rivulet.session import scratch_path
from rivulet.sinks import kafka as kafka_sink, keyed, rows as row_sinks, tables
from rivulet.sources import files, memory, modulo, network
from rivulet.streaming import run
from rivulet.streaming.tables import KeyedTable


def test_user_behavior(spark, tmp_path):
    (tmp_path / "b.csv").write_text("1,2,3,pv,1511658000\n4,5,6,buy,1511658001\n")
    for df in (
        files.user_behavior(spark, str(tmp_path)),
        run.drained(files.user_behavior(spark, str(tmp_path), stream=True), "csv"),
    ):
        assert values(df.where("behavior = 'pv'")) == [
            ("1", "2", "3", "pv", 1511658000000, datetime(2017, 11, 26, 1, 0))
        ]
        assert df.count() == 2


def test_lines_and_rows(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a 1\nb 2\n")
    assert values(files.text_lines(spark, str(tmp_path))) == [("a 1",), ("b 2",)]
    assert values(memory.from_rows(spark, [("key", 1), ("key", 2)], schemas.KEY_VALUE)) == [("key", 1), ("key", 2)]


def test_modulo_source(spark):
    df = modulo.modulo(spark)
    assert df.rdd.getNumPartitions() == 3
    placed = df.withColumn("task", F.spark_partition_id())
    assert values(placed, "v", "subtask", "task") == [(v, v % 3, v % 3) for v in range(10)]
    assert values(modulo.modulo(spark, 200_000, 2).groupBy("subtask").count()) == [(0, 100_000), (1, 100_000)]


class Client:
    def __init__(self):
        self.calls, self.table, self.found, self.closed = [], {}, None, False

    def hset(self, name, mapping):
        self.calls.append((name, dict(mapping)))

    def cursor(self):
        return self

    def execute(self, sql, args):
        verb = sql.split()[0]
        self.calls.append(verb)
        if verb == "SELECT":
            self.found = (1,) if args[0] in self.table else None
        elif verb == "UPDATE":
            self.table[args[1]] = args[0]
        else:
            self.table[args[0]] = args[1]

    def executemany(self, sql, rows):
        for args in rows:
            self.execute(sql, args)

    def fetchone(self):
        return self.found

    def commit(self):
        self.calls.append("commit")

    def close(self):
        self.closed = True


def test_hash_writer():
    client = Client()
    keyed.hash_writer(lambda: client, "tuple", "k", "v", chunk=2)([Row(k=f"k{i}", v=i) for i in range(3)])
    assert client.calls == [("tuple", {"k0": "0", "k1": "1"}), ("tuple", {"k2": "2"})] and client.closed


def test_row_upserter():
    """An update that changes nothing is no reason to insert: some databases count changed rows, not rows found."""
    client = Client()
    client.table |= {"key": 0, "same": 5}
    keyed.row_upserter(lambda: client, "tuple", ["k"], ["v"])([Row(k="key", v=2), Row(k="same", v=5), Row(k="new", v=3)])
    assert client.table == {"key": 2, "same": 5, "new": 3} and client.closed
    assert client.calls == ["SELECT"] * 3 + ["UPDATE"] * 2 + ["INSERT", "commit"]


def test_row_upserter_with_a_statement():
    client = Client()
    client.table["key"] = 0
    rows = [Row(k="key", v=2), Row(k="b", v=3), Row(k="c", v=4)]
    keyed.row_upserter(lambda: client, "tuple", ["k"], ["v"], statement="MERGE of (%s, %s)", chunk=2)(rows)
    assert client.table == {"key": 2, "b": 3, "c": 4} and client.calls == ["MERGE"] * 3 + ["commit"]


def test_partition_writer_closes_after_an_error():
    client = Client()

    def fail(_, row):
        raise ValueError(row)

    with pytest.raises(ValueError):
        row_sinks.partition_writer(lambda: client, fail, Client.close)([1])
    assert client.closed


def test_writers_run_in_tasks(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([(0, "key", 1), (1, "key", 2), (2, "b", 3)], "seq long, k string, v int")

    class FileClient:
        def hset(self, name, mapping):
            for k, v in mapping.items():
                with open(f"{folder}/{name}-{k}", "a") as f:
                    f.write(v)

        def close(self):
            pass

    keyed.to_hash(df, FileClient, "tuple", "k", "v", "seq")
    assert (tmp_path / "tuple-key").read_text() == "2" and (tmp_path / "tuple-b").read_text() == "3"


def test_context_columns(spark):
    class Query:
        lastProgress = {"eventTime": {"watermark": "2024-01-01T00:00:00.000Z"}}

    df = spark.createDataFrame([(1, datetime(2024, 1, 2))], "v int, ts timestamp")
    row = row_sinks.with_context(df, Query(), "ts").first()
    assert row.event_time == datetime(2024, 1, 2) and row.watermark == datetime(2024, 1, 1)
    assert row.processing_time is not None
    assert row_sinks.with_context(df, None).first().watermark is None


def test_kafka_rows_and_options(spark):
    df = spark.createDataFrame([("k", 1)], schemas.KEY_VALUE)
    assert values(kafka_sink.kafka_rows(df)) == [('{"k":"k","v":1}',)]
    assert values(kafka_sink.kafka_rows(df, "v", key="k")) == [("k", "1")]
    options = network.kafka_options("host:9092", "t", "group")
    assert options["startingOffsets"] == "latest" and options["kafka.group.id"] == "group"


def test_printed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("hello\n")
    stream = files.text_lines(spark, f"{tmp_path}/in", stream=True)
    query = run.start(row_sinks.printed(stream, "main"), f"{tmp_path}/c", every="1 second")
    query.processAllAvailable()
    done = [p["numInputRows"] for p in query.recentProgress]
    query.stop()
    assert sum(done) == 1 and query.exception() is None


def test_message_and_scratch(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1), datetime(2024, 1, 2), 3)], "k string, s timestamp, e timestamp, n long")
    text = df.select(window_message(*(F.col(c) for c in "ksen"))).first()[0]
    assert text == "key a window 2024-01-01 00:00:00 ~ 2024-01-02 00:00:00 count 3"
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_row_sink_with_context(spark, tmp_path):
    """Tasks stage their rows in files; the commit publishes them under the micro-batch's number."""
    folder = tmp_path / "sink"
    folder.mkdir()
    for i in range(2):
        rows = [(i * 10 + j, datetime(2024, 1, 1, i, j)) for j in range(5)]
        spark.createDataFrame(rows, "v int, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = files.table_stream(spark, f"{tmp_path}/in", schema, files_per_trigger=1)
    stream = stream.withColumn("watermark", F.lit(datetime(2024, 1, 1)).cast("timestamp"))
    place = str(folder)

    def connect():
        name = f"{place}/staged-{uuid.uuid4().hex}"
        return name, open(name, "w")

    def invoke(resource, row, context):
        assert context.processing_time.tzinfo is not None
        resource[1].write(f"{row.v} {context.event_time:%H:%M} {context.watermark:%H:%M}\n")

    def close(resource):
        resource[1].close()
        return resource[0]

    def commit(names, batch_id):
        with open(f"{place}/batch-{batch_id}", "w") as out:
            for name in sorted(names):
                out.write(open(name).read())

    sink = tables.RowSink(connect, invoke, close, commit, ts="ts", watermark="watermark")
    run.run_available(sink.writer(stream), f"{tmp_path}/c")
    lines = [line for i in range(2) for line in (folder / f"batch-{i}").read_text().splitlines()]
    assert sorted(lines) == sorted(f"{i * 10 + j} {i:02}:{j:02} 00:00" for i in range(2) for j in range(5))


def test_upserts_into_a_keyed_table(spark, tmp_path):
    for i in range(3):
        rows = [(i * 10 + j, "ab"[j % 2] if j < 4 else None, i * 10 + j) for j in range(5)]
        spark.createDataFrame(rows, "seq long, k string, v long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = files.table_stream(spark, f"{tmp_path}/in", schema, files_per_trigger=1)
    table = KeyedTable(f"{tmp_path}/table", ["k"], every=2)
    run.run_available(tables.upserts(stream, ["k"], "seq", table), f"{tmp_path}/c")
    whole = spark.read.parquet(f"{tmp_path}/in")
    assert values(table.before(spark, 3), "k", "v") == values(whole.groupBy("k").agg(F.max("v")))


def test_the_package_reaches_workers_elsewhere(tmp_path):
    """A session in another folder, whose workers find the package only because it was sent to them."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {home!r})
from rivulet import session
from rivulet.operators import folds
spark = session.local_session(2, 2)
session.ship(spark)
df = spark.range(10).selectExpr("id % 2 AS k", "id")
out = folds.user_aggregate(df, ["k"], "id", lambda: [0], lambda a, v: [a[0] + v], lambda a, b: [a[0] + b[0]])
print("sums", sorted((r.k, r.accumulator[0]) for r in out.collect()))
spark.stop()
"""
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert "sums [(0, 20), (1, 25)]" in done.stdout, done.stderr[-2000:]
