"""Keyed state machines over a stream in event-time order.

Rows wait in the key's state until the watermark has passed them, then they are
handled in order of time, ties by arrival number; so results do not depend on
how the stream was cut into micro-batches. Alarms that a key sets are rung
between rows, and by a timer when no more rows come.

Keys share ``BUCKETS`` groups by their hash: a call to the state store costs more
than a row's step, so state is read and written for a bucket's keys at once. A
bucket's waiting rows lie in the state store; if they are many, in grains of time. So
Python holds at most ``2 * LOOSE`` rows and those of one grain at a time,
however many rows of the bucket wait, and what its keys remember.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rivulet.functions.time import micros
from rivulet.operators.keys import packed, unpacked

NONE = -1
LOOSE = 200_000
BUCKETS = 2048  # keys share so many groups at most
FRAME = 10_000  # output rows of a frame, about
Out = list[tuple]


class Steps:
    """What a key does. ``memo`` is its state, a list of integers that a step may change in place."""

    schema = "value bigint"
    alarm_first = True  # an alarm due at a row's time rings before that row

    def start(self) -> list[int]:
        return []

    def row(self, memo: list[int], us: int, number: int, value: int) -> Out:
        raise NotImplementedError

    def due(self, memo: list[int]) -> int:
        """Time in microseconds of the next alarm, NONE if there is none."""
        return NONE

    def alarm(self, memo: list[int]) -> Out:
        return []


class Rows:
    """Rows of several keys: numpy columns time, number, value and the key's position in ``keys``."""

    def __init__(self, keys: list[tuple], flat: np.ndarray):
        self.keys, self.flat = keys, flat

    @staticmethod
    def of(pdf: pd.DataFrame, names: list[str], columns: list[str]) -> Rows:
        """The ``columns`` of a frame, the keys in ``names``."""
        if pdf[columns].isna().any(axis=None):
            raise ValueError(f"rows of a keyed stream need {', '.join(columns)}")
        places: dict[tuple, int] = {}
        own = [places.setdefault(key, len(places)) for key in zip(*(pdf[n].tolist() for n in names))]
        numbers = pdf[columns].to_numpy(dtype=np.int64)
        return Rows(list(places), np.column_stack([numbers, np.array(own, dtype=np.int64)]))

    @staticmethod
    def joined(parts: Iterable[Rows], width: int = 4) -> Rows:
        places: dict[tuple, int] = {}
        flats = [np.empty((0, width), dtype=np.int64)]
        for part in parts:
            own = np.array([places.setdefault(key, len(places)) for key in part.keys], dtype=np.int64)
            flat = part.flat.copy()
            flat[:, -1] = own[flat[:, -1]]
            flats.append(flat)
        return Rows(list(places), np.concatenate(flats))

    def where(self, chosen: np.ndarray) -> Rows:
        """The chosen rows, with no other keys than theirs."""
        flat = self.flat[chosen]
        used, own = np.unique(flat[:, -1], return_inverse=True)
        flat[:, -1] = own
        return Rows([self.keys[i] for i in used.tolist()], flat)

    def split(self, by: np.ndarray) -> Iterator[tuple[int, Rows]]:
        order = np.argsort(by, kind="stable")
        values, starts = np.unique(by[order], return_index=True)
        for value, chosen in zip(values.tolist(), np.split(order, starts[1:])):
            yield value, self.where(chosen)

    def by_key(self) -> Iterator[tuple[tuple, Iterator[tuple[int, int, int]]]]:
        """Each key with its rows, ordered by time, number and value."""
        us, number, value, own = self.flat.T
        order = np.lexsort((value, number, us, own))
        places, starts = np.unique(own[order], return_index=True)
        for place, chosen in zip(places.tolist(), np.split(order, starts[1:])):
            yield self.keys[place], zip(us[chosen].tolist(), number[chosen].tolist(), value[chosen].tolist())

    def stored(self) -> tuple[bytes, bytes]:
        return self.flat.tobytes(), pickle.dumps(self.keys)

    @staticmethod
    def loaded(flat: bytes, keys: bytes, width: int = 4) -> Rows:
        return Rows(pickle.loads(keys), np.frombuffer(flat, dtype=np.int64).reshape(-1, width))


STORED = "flat binary, keys binary"  # of Rows


def keyed(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[T.StructField]]:
    """The rows with ``bucket``, which their keys share with others, and the fields of the keys as the workers get them.

    The workers' columns have an ``at`` before these names: Spark hands rows over as named tuples, which must not begin with an underscore.
    """
    rows, names = packed(df, keys)
    bucket = F.pmod(F.xxhash64(*names), F.lit(BUCKETS)).cast("int").alias("bucket")
    others = [c for c in rows.columns if c not in names]
    return rows.select(bucket, *others, *(F.col(n).alias(f"at{n}") for n in names)), [rows.schema[n] for n in names]


def framed(out: Out, fields: list[T.StructField]) -> pd.DataFrame:
    """Output rows as a frame; nulls do not make floats of whole numbers."""
    whole = {f.name: "Int64" for f in fields if isinstance(f.dataType, T.LongType)}
    return pd.DataFrame(out, columns=[f.name for f in fields], dtype=object).astype(whole)


class _Bucket(StatefulProcessor):
    """The state of a bucket's keys, and one timer for all of them."""

    def __init__(self, steps: Steps, keys: list[T.StructField], fields: list[T.StructField], grain: int):
        self.steps, self.grain = steps, grain
        self.names = [f"at{f.name}" for f in keys]
        self.fields = [*keys, *fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memos = handle.getValueState("memos", "lengths binary, numbers binary, keys binary")
        self.timer = handle.getValueState("timer", "ms bigint")

    def _open(self) -> dict[tuple, list[int]]:
        if not self.memos.exists():
            return {}
        lengths, numbers, keys = self.memos.get()
        ends = np.cumsum(np.frombuffer(lengths, dtype=np.int64)).tolist()
        flat = np.frombuffer(numbers, dtype=np.int64).tolist()
        return {key: flat[a:b] for key, a, b in zip(pickle.loads(keys), [0, *ends], ends)}

    def _keep(self, memos: dict[tuple, list[int]]) -> None:
        """Save the state of the keys that have one."""
        fresh = self.steps.start()
        kept = {key: memo for key, memo in memos.items() if memo != fresh}
        if kept:
            lengths = np.array([len(memo) for memo in kept.values()], dtype=np.int64)
            numbers = np.array([n for memo in kept.values() for n in memo], dtype=np.int64)
            self.memos.update((lengths.tobytes(), numbers.tobytes(), pickle.dumps(list(kept))))
        elif self.memos.exists():
            self.memos.clear()

    def _steps(self, key: tuple, memo: list[int], rows: Iterable[tuple[int, int, int]], out: Out) -> None:
        """Handle a key's rows, in order, and the alarms between them."""
        steps = self.steps
        for us, number, value in rows:
            while NONE != (due := steps.due(memo)) and (due <= us if steps.alarm_first else due < us):
                out.extend((*key, *row) for row in steps.alarm(memo))
            out.extend((*key, *row) for row in steps.row(memo, us, number, value))

    def _ring(self, memos: dict[tuple, list[int]], now: int, out: Out) -> Iterator[pd.DataFrame]:
        """The alarms that are due by now. Frames come when there is enough for one."""
        steps = self.steps
        for key, memo in memos.items():
            while NONE != (due := steps.due(memo)) and due <= now:
                out.extend((*key, *row) for row in steps.alarm(memo))
            yield from self._frames(out, FRAME)

    def _next(self, memos: dict[tuple, list[int]]) -> list[int]:
        return [due for memo in memos.values() if (due := self.steps.due(memo)) != NONE]

    def _frames(self, out: Out, least: int = 1) -> Iterator[pd.DataFrame]:
        if len(out) >= least:
            yield framed(out, self.fields)
            out.clear()

    def _wake(self, times: list[int], only_earlier: bool = False) -> None:
        """Have one timer, for the first of these times; with ``only_earlier`` an earlier one stays."""
        wanted = math.ceil(min(times) / 1000) if times else None
        current = int(self.timer.get()[0]) if self.timer.exists() else None
        if wanted == current or (only_earlier and current is not None and current < wanted):
            return
        if current is not None:
            self.handle.deleteTimer(current)
            self.timer.clear()
        if wanted is not None:
            self.handle.registerTimer(wanted)
            self.timer.update((wanted,))

    def close(self) -> None:
        pass


class _Processor(_Bucket):
    """In event time. Map state: (grain, part) -> waiting rows. Input is put away in pieces of ``LOOSE`` rows, each with parts of its own.

    A bucket's first ``LOOSE`` waiting rows are kept whole, with no grain.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        _Bucket.init(self, handle)
        self.waiting = handle.getMapState("waiting", "grain bigint, part bigint", STORED)
        self.parts = handle.getValueState("parts", "used bigint, loose bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        used, loose = (int(n) for n in self.parts.get()) if self.parts.exists() else (0, 0)
        first = []

        def put(held: list[Rows]) -> None:
            nonlocal used, loose
            rows = Rows.joined(held)
            us = rows.flat[:, 0]
            if loose + len(us) <= LOOSE:
                pieces = [(NONE, rows)]
                loose += len(us)
            else:
                pieces = rows.split(us // self.grain)
            for grain, piece in pieces:
                self.waiting.updateValue((grain, used), piece.stored())
                used += 1
            first.append(int(us.min()))

        held: list[Rows] = []
        for pdf in rows:
            if not len(pdf):
                continue
            held.append(Rows.of(pdf, self.names, ["at_us", "at_number", "at_value"]))
            if sum(len(r.flat) for r in held) >= LOOSE:
                put(held)
                held = []
        if held:
            put(held)
        if first:
            self.parts.update((used, loose))
            self._wake([min(first)], only_earlier=True)
        return iter(())

    def _take(self, grain: int, parts: list[int]) -> list[Rows]:
        out = []
        for part in parts:
            out.append(Rows.loaded(*self.waiting.getValue((grain, part))))
            self.waiting.removeKey((grain, part))
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        now = timerValues.getCurrentWatermarkInMs() * 1000
        used, was = (int(n) for n in self.parts.get()) if self.parts.exists() else (0, 0)
        parts: dict[int, list[int]] = {}
        for grain, part in self.waiting.keys():
            parts.setdefault(int(grain), []).append(int(part))
        memos, out, woken = self._open(), [], []
        loose = Rows.joined(self._take(NONE, parts.pop(NONE, [])))
        left = loose.where(loose.flat[:, 0] > now)
        loose = loose.where(loose.flat[:, 0] <= now)
        for grain in [*sorted(parts), None]:  # at last what is loose and later than all grains
            own = []
            if grain is not None:
                if grain * self.grain > now:
                    woken.append(grain * self.grain)
                    grain = None
                else:
                    own = self._take(grain, parts[grain])
            late = loose.flat[:, 0] // self.grain > grain if grain is not None else np.zeros(len(loose.flat), dtype=bool)
            rows = Rows.joined([loose.where(~late), *own])
            loose = loose.where(late)
            waits = rows.flat[:, 0] > now
            if waits.any():
                left = Rows.joined([left, rows.where(waits)])
                rows = rows.where(~waits)
            for one, steps in rows.by_key():
                memo = memos.get(one)
                if memo is None:
                    memo = memos[one] = self.steps.start()
                self._steps(one, memo, steps, out)
                yield from self._frames(out, FRAME)
            if grain is None:
                break
        if len(left.flat):
            self.waiting.updateValue((NONE, used), left.stored())
            woken.append(int(left.flat[:, 0].min()))
        if was or len(left.flat):
            self.parts.update((used + 1, len(left.flat)))
        yield from self._ring(memos, now, out)
        self._keep(memos)
        self._wake([*woken, *self._next(memos)])
        yield from self._frames(out)


class _ClockProcessor(_Bucket):
    """On the machine's clock: a row's time is that of its micro-batch, and it is handled at once."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() * 1000
        memos, out = self._open(), []
        yield from self._ring(memos, now, out)
        for pdf in rows:
            if not len(pdf):
                continue
            for one, steps in Rows.of(pdf.assign(at_us=now), self.names, ["at_us", "at_number", "at_value"]).by_key():
                memo = memos.get(one)
                if memo is None:
                    memo = memos[one] = self.steps.start()
                self._steps(one, memo, steps, out)
                yield from self._frames(out, FRAME)
        self._keep(memos)
        self._wake(self._next(memos))
        yield from self._frames(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        memos, out = self._open(), []
        yield from self._ring(memos, timerValues.getCurrentProcessingTimeInMs() * 1000, out)
        self._keep(memos)
        self._wake(self._next(memos))
        yield from self._frames(out)


def run_steps(
    df: DataFrame,
    keys: list[str],
    ts: str | None,
    seq: str,
    value: Column,
    steps: Steps,
    delay: timedelta = timedelta(0),
    grain: timedelta = timedelta(minutes=10),
) -> DataFrame:
    """Apply ``steps`` per key to a stream, in event time, or without ``ts`` on the machine's clock.

    ``seq`` and ``value`` are integers.
    """
    common = [F.col(seq).cast("bigint").alias("at_number"), value.cast("bigint").alias("at_value")]
    fields = T.StructType.fromDDL(steps.schema).fields
    own = [df.schema[k] for k in keys]
    if ts is None:
        rows = df.select(*keys, *common)
    else:
        rows = df.withWatermark(ts, f"{micros(delay)} microseconds").select(
            *keys,
            ts,
            F.unix_micros(ts).alias("at_us"),
            *common,
        )
    rows, key_fields = keyed(rows, keys)
    processor = _ClockProcessor if ts is None else _Processor
    out = rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=processor(steps, key_fields, fields, micros(grain)),
        outputStructType=T.StructType([*key_fields, *fields]),
        outputMode="append",
        timeMode="ProcessingTime" if ts is None else "EventTime",
    )
    return out.select(*unpacked(out, own), *(f.name for f in fields))
