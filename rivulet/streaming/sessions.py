"""Keyed state that comes and goes: rows in list state until their session closes, values that are forgotten after a time."""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rivulet.functions.time import micros
from rivulet.operators.keys import unpacked
from rivulet.streaming.ordered import STORED, Rows, framed, keyed


class _Sessions(StatefulProcessor):
    """Of a bucket's keys. List state: the rows of sessions that are open, in pieces as they came. One timer, not after the end of the oldest
    session; new rows that may end earlier delete it and set another."""

    def __init__(self, gap: int, keys: list[T.StructField], fields: list[T.StructField]):
        self.gap, self.fields = gap, [*keys, *fields]
        self.names = [f"at{f.name}" for f in keys]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", STORED)
        self.timer = handle.getValueState("timer", "ms bigint")

    def _wake(self, us: int, only_earlier: bool) -> None:
        wanted = math.ceil(us / 1000)
        current = int(self.timer.get()[0]) if self.timer.exists() else None
        if wanted == current or (only_earlier and current is not None and current < wanted):
            return
        if current is not None:
            self.handle.deleteTimer(current)
        self.handle.registerTimer(wanted)
        self.timer.update((wanted,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [Rows.of(pdf, self.names, ["at_us", "at_value"]) for pdf in rows if len(pdf)]
        if new:
            self.rows.appendList([piece.stored() for piece in new])
            self._wake(min(int(piece.flat[:, 0].min()) for piece in new) + self.gap, only_earlier=True)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = self.rows.get() if self.rows.exists() else ()
        rows = Rows.joined((Rows.loaded(*piece, width=3) for piece in held), width=3)
        if not len(rows.flat):
            return
        rows.flat = rows.flat[np.lexsort((rows.flat[:, 1], rows.flat[:, 0], rows.flat[:, 2]))]
        us, value, own = rows.flat.T
        starts = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (us[1:] - us[:-1] >= self.gap)])
        counts = np.diff(np.r_[starts, len(us)])
        ends = us[starts + counts - 1]
        closed = ends + self.gap <= now
        left = rows.where(~np.repeat(closed, counts))
        if len(left.flat):
            self.rows.put([left.stored()])
            self._wake(int(ends[~closed].min()) + self.gap, only_earlier=False)
        else:
            self.rows.clear()
        columns = (us[starts], ends, counts, np.add.reduceat(value, starts), own[starts])
        out = [(*rows.keys[place], *numbers) for *numbers, place in zip(*(c[closed].tolist() for c in columns))]
        if out:
            yield framed(out, self.fields)

    def close(self) -> None:
        pass


def sessions(df: DataFrame, keys: list[str], ts: str, value: Column, gap: timedelta, delay: timedelta) -> DataFrame:
    """Count and sum per session: a key's rows with less than ``gap`` between one and the next.

    A session comes out, and its rows leave the state, once the watermark has passed its last row by ``gap``.
    The open sessions of a bucket of keys lie in one task's list.
    """
    rows = df.withWatermark(ts, f"{micros(delay)} microseconds").select(
        *keys, ts, F.unix_micros(ts).alias("at_us"), value.cast("bigint").alias("at_value")
    )
    own = [df.schema[k] for k in keys]
    rows, key_fields = keyed(rows, keys)
    fields = T.StructType.fromDDL("first_us bigint, last_us bigint, count bigint, sum bigint").fields
    out = rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_Sessions(micros(gap), key_fields, fields),
        outputStructType=T.StructType([*key_fields, *fields]),
        outputMode="append",
        timeMode="EventTime",
    )
    first, last = (F.timestamp_micros(c) for c in ("first_us", "last_us"))
    return out.select(*unpacked(out, own), first.alias("first_ts"), last.alias("last_ts"), "count", "sum")


class _Unseen(StatefulProcessor):
    """Map state with a time to live: the values that came lately."""

    def __init__(self, memory: int, keys: list[str]):
        self.memory, self.keys = memory, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "value bigint", "number bigint", self.memory)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out = []
        for pdf in rows:
            for number, value in sorted(zip(pdf["at_number"].tolist(), pdf["at_value"].tolist())):
                if not self.seen.containsKey((int(value),)):
                    self.seen.updateValue((int(value),), (int(number),))
                    out.append((int(number), int(value)))
        if out:
            made = pd.DataFrame(out, columns=["number", "value"])
            for position, (name, held) in enumerate(zip(self.keys, key)):
                made.insert(position, name, [held] * len(made))
            yield made

    def close(self) -> None:
        pass


def unseen(df: DataFrame, keys: list[str], seq: str, value: Column, memory: timedelta) -> DataFrame:
    """Rows whose key did not have their value for ``memory``, on the machine's clock: ``number`` (of ``seq``) and ``value``.

    Spark drops a value from the state that long after it was written, so state holds what came lately only.
    """
    rows = df.select(*keys, F.col(seq).cast("bigint").alias("at_number"), value.cast("bigint").alias("at_value"))
    fields = T.StructType.fromDDL("number bigint, value bigint").fields
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Unseen(max(1, micros(memory) // 1000), keys),
        outputStructType=T.StructType([*(rows.schema[k] for k in keys), *fields]),
        outputMode="append",
        timeMode="ProcessingTime",
    )
