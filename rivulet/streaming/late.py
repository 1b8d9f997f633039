"""Watermarks of our own on streams: exact to the row, and no row is dropped before it is seen.

Spark moves its watermark once per micro-batch and drops what is behind it. Here the rows of a
micro-batch meet the watermark of all rows that arrived before them, in this and in earlier
micro-batches: a few rows that stand for all earlier ones are kept and put before the next
micro-batch, and the batch operators do the rest. Arrival order is the unique integer column
``seq``; a later micro-batch arrived later.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from rivulet.functions.time import interval
from rivulet.operators import watermarks
from rivulet.operators.segments import DEFAULT, Order, Running, Skew, running
from rivulet.streaming.tables import BEFORE_ALL, kept

Write = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Marks:
    """``add`` gives rows their ``watermark``; ``stand_in`` picks the rows that do to it what all rows do."""

    add: Callable[[DataFrame], DataFrame]
    stand_in: Callable[[DataFrame], DataFrame]


def _furthest(rows: DataFrame, time: str, by: list[str]) -> DataFrame:
    """The row with the latest time, of each group."""
    latest = F.max_by(F.struct(*(f"`{c}`" for c in rows.columns)), time).alias("_latest")
    return rows.where(F.col(time).isNotNull()).groupBy(*by).agg(latest).where("_latest IS NOT NULL").select("_latest.*")


def bounded(ts: str, seq: str, bound: timedelta, skew: Skew | None = DEFAULT) -> Marks:
    return Marks(
        lambda rows: watermarks.with_watermark(rows, ts, seq, bound, skew=skew),
        lambda rows: _furthest(rows, ts, []),
    )


def punctuated(seq: str, is_mark: Column, mark: str, skew: Skew | None = DEFAULT) -> Marks:
    """Mark rows travel in the stream and leave the result."""
    return Marks(
        lambda rows: watermarks.with_punctuated_watermark(rows, seq, is_mark, mark, skew=skew),
        lambda rows: _furthest(rows.where(is_mark), mark, []),
    )


def united(
    ts: str, seq: str, bound: timedelta, source: str, sources: list[str], skew: Skew | None = DEFAULT
) -> Marks:
    return Marks(
        lambda rows: watermarks.with_union_watermark(rows, ts, seq, bound, source, sources, skew=skew),
        lambda rows: _furthest(rows.where(F.col(source).isin(sources)), ts, [source]),
    )


def _placed(rows: DataFrame, seq: str) -> DataFrame:
    place = (F.lit(BEFORE_ALL) + F.monotonically_increasing_id()).cast(rows.schema[seq].dataType)
    return rows.withColumn(seq, place).withColumn("_row", F.lit(False))


def _marked(batch: DataFrame, batch_id: int, seq: str, marks: Marks, home: str) -> DataFrame:
    """A micro-batch with the watermark that each row met; what stands for all so far is written."""
    spark = batch.sparkSession
    rows = batch.withColumn("_row", F.lit(True))
    so_far = batch
    if batch_id > 0:
        earlier = spark.read.schema(batch.schema).parquet(f"{home}/marks/{batch_id - 1}")
        rows = rows.unionByName(_placed(earlier, seq))
        so_far = batch.unionByName(earlier)
    marks.stand_in(so_far).coalesce(1).write.mode("overwrite").parquet(f"{home}/marks/{batch_id}")
    return marks.add(rows).where("_row").drop("_row")


def _reached(spark: SparkSession, batch: DataFrame, batch_id: int, seq: str, marks: Marks, home: str) -> Column:
    """The watermark after a micro-batch: the one that a row after it would meet."""
    earlier = spark.read.schema(batch.schema).parquet(f"{home}/marks/{batch_id}")
    kinds = {f.name: f.dataType for f in batch.schema.fields}
    probe = spark.range(1).select(*(F.lit(None).cast(t).alias(n) for n, t in kinds.items()))
    probe = probe.withColumn(seq, F.lit(-BEFORE_ALL).cast(kinds[seq])).withColumn("_row", F.lit(True))
    met = marks.add(_placed(earlier, seq).unionByName(probe)).where("_row").select(F.unix_micros("watermark")).first()
    return F.timestamp_micros(F.lit(met[0]).cast("bigint"))


def with_watermark(df: DataFrame, seq: str, marks: Marks, home: str, write: Write) -> DataStreamWriter:
    """Give every micro-batch, its rows with the ``watermark`` they met, to ``write``.

    With ``operators.watermarks`` this tags late rows, routes them, or splits windows from their side output.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        with kept(batch):
            write(_marked(batch, batch_id, seq, marks, home), batch_id)

    return df.writeStream.foreachBatch(each)


class Firings:
    """Tumbling windows that fire when the watermark passes their end, and again for each late row.

    ``fired`` gets keys, window bounds, ``firing`` (1, 2, ..), ``first`` and ``count``; ``dropped`` gets the
    rows whose window is gone, ``lateness`` after its end. State: one row per window that can still fire.
    """

    def __init__(
        self,
        keys: list[str],
        ts: str,
        seq: str,
        size: timedelta,
        lateness: timedelta,
        marks: Marks,
        home: str,
        fired: Write,
        dropped: Write | None = None,
        skew: Skew | None = DEFAULT,
    ):
        self.keys, self.ts, self.seq, self.size, self.lateness = keys, ts, seq, size, lateness
        self.marks, self.home, self.fired, self.dropped, self.skew = marks, home, fired, dropped, skew
        self.group = [*keys, "window_start", "window_end"]
        self.last = -1

    def writer(self, df: DataFrame) -> DataStreamWriter:
        return df.writeStream.foreachBatch(self._each)

    def _each(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with kept(batch):
            marked = _marked(batch, batch_id, self.seq, self.marks, self.home)
            now = _reached(spark, batch, batch_id, self.seq, self.marks, self.home)
            open_ = spark.read.parquet(f"{self.home}/windows/{batch_id - 1}") if batch_id > 0 else None
            with kept(watermarks.window_arrivals(marked, self.ts, self.size, self.lateness, out="_arrival")) as arrivals:
                self._fire(arrivals, open_, now, batch_id)
                if self.dropped is not None:
                    self.dropped(arrivals.where("_arrival = 'dropped'").drop("_arrival", "watermark"), batch_id)
        self.last = batch_id

    def _fire(self, arrivals: DataFrame, open_: DataFrame | None, now: Column, batch_id: int) -> None:
        group, one = self.group, F.lit(1).cast("bigint")
        last = F.col("window_end") - interval(watermarks.TICK)
        held = arrivals.where("_arrival = 'on_time'").groupBy(*group)
        held = held.agg(F.count(F.lit(1)).alias("_n"), F.lit(0).cast("bigint").alias("_f"))
        if open_ is not None:
            held = held.unionByName(open_.select(*group, F.col("count").alias("_n"), F.col("firing").alias("_f")))
            held = held.groupBy(*group).agg(F.sum("_n").alias("_n"), F.max("_f").alias("_f"))
        first = (F.col("_f") == 0) & F.coalesce(last <= now, F.lit(False))
        held = held.select(*group, "_n", "_f", first.alias("_fires"), F.lit(BEFORE_ALL).alias("_place"))
        held = held.withColumn("_f", F.when(F.col("_fires"), one).otherwise(F.col("_f")))
        late = arrivals.where("_arrival = 'late'").select(
            *group, one.alias("_n"), one.alias("_f"), F.lit(True).alias("_fires"), F.col(self.seq).cast("bigint").alias("_place")
        )
        still = F.coalesce(last + interval(self.lateness) > now, F.lit(True))
        with kept(held.unionByName(late)) as rows:
            state = rows.groupBy(*group).agg(F.sum("_n").alias("count"), F.sum("_f").alias("firing")).where(still)
            state.write.mode("overwrite").parquet(f"{self.home}/windows/{batch_id}")
            counted = running(
                rows, group, Order("_place"), [Running("count", "sum", "_n"), Running("firing", "sum", "_f")], self.skew
            )
            fired = counted.where("_fires").select(*group, "firing", (F.col("firing") == 1).alias("first"), "count")
            self.fired(fired, batch_id)

    def finish(self, spark: SparkSession) -> None:
        """The input has ended: windows that have not fired yet do so now."""
        open_ = spark.read.parquet(f"{self.home}/windows/{self.last}").where("firing = 0")
        fired = open_.select(*self.group, F.lit(1).cast("bigint").alias("firing"), F.lit(True).alias("first"), "count")
        self.fired(fired, self.last + 1)
