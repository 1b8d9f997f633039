"""Late rows and changelogs over several micro-batches: the same as in batch, however the input is cut."""

import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import ordered, values
from rivulet.operators import watermarks
from rivulet.streaming import changes, late
from rivulet.streaming.arrivals import Arrivals
from rivulet.streaming.tables import KeyedTable

SECOND = timedelta(seconds=1)
SCHEMA = "seq long, ms long, k string, kind string, v long, arrival string"


@pytest.fixture(scope="module")
def table(spark):
    """Rows up to an hour late, null keys and times, and a column named as the operators name theirs."""
    rng = random.Random(8)
    rows, at = [], 1_000_000
    for seq in range(200):
        at += rng.choice([10, 400, 900, 5000])
        behind = rng.choice([0, 0, 0, 1500, 6000, 20_000, 3_600_000 if seq > 150 else 0])
        ms = None if seq == 77 else at - behind
        kind = rng.choice(["mark", "click", "click", "view", None])
        rows.append((seq * 3, ms, rng.choice(["a", "a", "b", None]), kind, rng.choice([1, 2, None]), "mine"))
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_millis("ms"))


def fed(table, tmp_path, writer_of, slices=3):
    arrivals = Arrivals(table, "seq", slices)
    arrivals.run(writer_of(arrivals.stream()), f"{tmp_path}/checkpoint")


def into(path):
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read(spark, path):
    return spark.read.parquet(str(path)).drop("batch_id")


def marks_of(name):
    """(marks for a stream, the batch operator); made late, as columns need a session."""
    if name == "bounded":
        return late.bounded("ts", "seq", 3 * SECOND), lambda df: watermarks.with_watermark(df, "ts", "seq", 3 * SECOND)
    if name == "punctuated":
        is_mark = F.col("kind") == "mark"
        return late.punctuated("seq", is_mark, "ts"), lambda df: watermarks.with_punctuated_watermark(df, "seq", is_mark, "ts")
    sources = ["click", "view"]
    return (
        late.united("ts", "seq", SECOND, "kind", sources),
        lambda df: watermarks.with_union_watermark(df, "ts", "seq", SECOND, "kind", sources),
    )


@pytest.mark.parametrize("name", ["bounded", "punctuated", "united"])
def test_rows_meet_the_watermark_of_all_earlier_ones(spark, table, tmp_path, name):
    marks, batch = marks_of(name)
    fed(table, tmp_path, lambda s: late.with_watermark(s, "seq", marks, f"{tmp_path}/state", into(f"{tmp_path}/out")))
    got, want = (values(df, *table.columns, "watermark") for df in (read(spark, f"{tmp_path}/out"), batch(table)))
    assert got == want
    assert any(r[-1] is not None and r[6] is not None and r[6] < r[-1] - timedelta(minutes=30) for r in got)


@pytest.mark.parametrize("lateness", [0, 10])
def test_windows_fire_again_for_late_rows(spark, table, tmp_path, tiny, lateness):
    home, skew = str(tmp_path), tiny if lateness else None
    marks = late.bounded("ts", "seq", 3 * SECOND, skew)
    firings = late.Firings(
        ["k"], "ts", "seq", 5 * SECOND, lateness * SECOND, marks, home, into(f"{home}/fired"), into(f"{home}/dropped"), skew
    )
    rows = table.where("ts IS NOT NULL")
    fed(rows, home, firings.writer)
    firings.finish(spark)
    marked = watermarks.with_watermark(rows, "ts", "seq", 3 * SECOND, skew=None)
    arrivals = watermarks.window_arrivals(marked, "ts", 5 * SECOND, lateness * SECOND, out="how")
    want = watermarks.window_firings(arrivals.drop("arrival").withColumnRenamed("how", "arrival"), ["k"], "seq", None)
    assert values(read(spark, f"{home}/fired")) == values(want)
    dropped = values(read(spark, f"{home}/dropped"), "seq", "window_start", "arrival")
    assert dropped == values(arrivals.where("how = 'dropped'"), "seq", "window_start", "arrival")
    assert dropped
    if lateness:
        assert want.where("firing > 1").count() > 5


def test_a_micro_batch_run_again_gives_the_same(spark, table, tmp_path):
    rows = table.where("ts IS NOT NULL")
    parts = [rows.where(f"seq BETWEEN {a} AND {a + 299}") for a in (0, 300)]
    home = str(tmp_path)
    firings = late.Firings(
        ["k"], "ts", "seq", 5 * SECOND, 10 * SECOND, late.bounded("ts", "seq", 3 * SECOND, None), home, into(f"{home}/fired"), None, None
    )
    seen = []

    class Stream:
        """Gives back what a writer would call per micro-batch."""

        def __init__(self):
            self.writeStream = self

        def foreachBatch(self, each):
            return each

    count = changes.count_changes(Stream(), ["k"], "seq", f"{home}/state", into(f"{home}/counts"), "v", skew=None)
    for i, part in enumerate(parts):
        for again in range(2):
            firings._each(part, i)
            count(part, i)
            found = [values(spark.read.parquet(f"{home}/{n}/batch_id={i}")) for n in ("fired", "counts")]
            seen.append(found)
        assert seen[-1] == seen[-2]
    assert all(any(found[n] for found in seen) for n in (0, 1))


def test_count_changes(spark, table, tmp_path, tiny):
    for skew in (None, tiny):
        home = f"{tmp_path}/{skew is None}"
        fed(table, home, lambda s: changes.count_changes(s, ["k"], "seq", f"{home}/state", into(f"{home}/out"), "v", skew=skew))
        want, counts = [], {}
        for r in table.orderBy("seq").collect():
            old = counts.get(r.k)
            counts[r.k] = new = (old or 0) + (r.v is not None)
            if old is None:
                want.append((r.k, r.seq, "+I", new))
            elif new != old:
                want += [(r.k, r.seq, "-U", old), (r.k, r.seq, "+U", new)]
        assert values(read(spark, f"{home}/out")) == ordered(want)


def test_upsert_changes(spark, table, tmp_path):
    deletes = F.col("kind") == "view"
    fed(table, tmp_path, lambda s: changes.upsert_changes(s, ["k"], "v", "seq", deletes, f"{tmp_path}/s", into(f"{tmp_path}/out")))
    want, rows = [], {}
    for r in table.orderBy("seq").collect():
        if r.kind == "view":
            if r.k in rows:
                want.append((r.k, r.seq, "-D", rows.pop(r.k)))
        elif r.k not in rows:
            want.append((r.k, r.seq, "+I", r.v))
            rows[r.k] = r.v
        elif rows[r.k] != r.v:
            want += [(r.k, r.seq, "-U", rows[r.k]), (r.k, r.seq, "+U", r.v)]
            rows[r.k] = r.v
    assert {w[2] for w in want} == {"+I", "-U", "+U", "-D"}
    assert values(read(spark, f"{tmp_path}/out")) == ordered(want)


def test_keyed_table_keeps_a_bounded_number_of_folders(spark, tmp_path):
    table = KeyedTable(str(tmp_path), ["k"], every=3)
    rng, want = random.Random(1), {}
    for batch_id in range(11):
        before = table.before(spark, batch_id)
        assert (before is None) == (batch_id == 0)
        if before is not None:
            assert values(before, "k", "v") == ordered(want.items())
        new = {rng.choice(["a", "b", "c", None, "d"]): batch_id for _ in range(2)}
        table.write(spark.createDataFrame(list(new.items()), "k string, v long"), batch_id)
        want |= new
        folders = [len(os.listdir(tmp_path / d)) for d in ("base", "changes") if os.path.exists(tmp_path / d)]
        assert sum(folders) <= 2 * 3 + 2
    assert values(table.before(spark, 11), "k", "v") == ordered(want.items())
