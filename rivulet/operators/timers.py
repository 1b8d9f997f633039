"""Timers in batch form.

A timer that is due at or before a row's time fires before that row is handled.
Input ends with the end of time: a timer still set then fires too.
"""

from __future__ import annotations

from datetime import timedelta

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.rows import ratio
from rivulet.functions.time import interval, micros
from rivulet.operators.scan import Rows, State, scan
from rivulet.operators.segments import DEFAULT, Order, Skew, cut, neighbours

ARM, CANCEL = 1, -1
NEVER = -1


def delay_timers(df: DataFrame, keys: list[str], ts: str, delay: timedelta) -> DataFrame:
    """One timer per key and due time, ``delay`` after each row; repeats are one timer."""
    return df.select(*keys, (F.col(ts) + interval(delay)).alias("fire_ts")).distinct()


class _Timer:
    """A key's timer: an arming row sets it if it is not set, a cancelling row clears it.

    State: [due time or NEVER, sum of the rows so far, their count].
    """

    def __init__(self, period: int):
        self.period = period

    def _walk(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Times; for each row the next arming and the next cancelling row at or after it, the
        first row at or after the due time it would set, and the arming row that follows once
        a timer set by it is gone. Row n stands for none."""
        t, act = rows["_us"], rows["_act"]
        n = len(t)
        at = np.arange(n)

        def next_at(hit: np.ndarray) -> np.ndarray:
            marks = np.where(hit, at, n)
            return np.append(np.minimum.accumulate(marks[::-1])[::-1], [n, n])

        arm, cancel = next_at(act == ARM), next_at(act == CANCEL)
        due = np.searchsorted(t, t + self.period, side="left")
        stop = cancel[1 : n + 1]
        return t, arm, cancel, due, arm[np.where(stop < due, stop + 1, due)]

    def summarize(self, rows: Rows) -> State:
        """[exit if entered unset, is there a cancel, exit after it, last time, sum, count, then
        pairs (due time up to, exit)].

        ``exit`` is the due time of the timer set at the segment's end. A timer
        set before the segment is due at most one period after its first row.
        """
        t, arm, cancel, due, following = self._walk(rows)
        n = len(t)
        open_end = (cancel[1 : n + 1] >= n) & (due >= n)
        jump = np.where(following < n, following, np.arange(n))
        while True:
            further = jump[jump]
            if np.array_equal(further, jump):
                break
            jump = further
        left = np.append(np.where(open_end[jump], t[jump] + self.period, NEVER), NEVER)
        stop = cancel[0]
        cancelled = left[arm[stop + 1]] if stop < n else NEVER
        near = int(np.searchsorted(t, t[0] + self.period, side="right"))
        reachable = np.unique(t[: near + 1])
        at = np.searchsorted(t, reachable, side="left")
        exits = np.where(at > stop, cancelled, left[arm[at]])
        keep = np.append(exits[1:] != exits[:-1], True)
        pairs = np.column_stack([reachable[keep], exits[keep]]).ravel()
        return [left[arm[0]], int(stop < n), cancelled, t[-1], rows["_own"].sum(), n, *pairs]

    def fold(self, state: State, summary: State) -> State:
        """The state at a segment's end from that at its start."""
        unset, has_cancel, cancelled, end, total, count, *pairs = summary
        due = state[0]
        if due == NEVER:
            due = unset
        elif due > end:
            due = cancelled if has_cancel else due
        else:
            due = next(left for upto, left in zip(pairs[::2], pairs[1::2]) if due <= upto)
        return [due, state[1] + total, state[2] + count]

    def emit(self, rows: Rows, state: State, last: bool) -> list[np.ndarray]:
        """Firings: due time, and sum and count of the rows before it."""
        t, arm, cancel, dues, following = self._walk(rows)
        n = len(t)
        fired: list[tuple[int, int]] = []
        due, row = state[0], 0
        if due != NEVER:
            row = int(np.searchsorted(t, due, side="left"))
            if cancel[0] < row:
                row = int(cancel[0]) + 1
            elif row < n or last:
                fired.append((due, row))
        row = int(arm[row])
        while row < n:
            at = int(dues[row])
            if cancel[row + 1] >= at and (at < n or last):
                fired.append((int(t[row]) + self.period, at))
            row = int(following[row])
        due_times, rows_before = np.array(fired, dtype=np.int64).reshape(-1, 2).T
        sums = np.append(0, np.cumsum(rows["_own"]))
        return [due_times, state[1] + sums[rows_before], state[2] + rows_before]


def _fire(
    df: DataFrame, keys: list[str], ts: str, seq: str, period: timedelta, act: Column, value: Column, skew: Skew | None
) -> DataFrame:
    timer = _Timer(micros(period))
    rows = df.withColumn("_own", value.cast("bigint")).withColumn("_act", act.cast("bigint"))
    rows = rows.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    fired = scan(
        rows,
        keys,
        Order(seq, ts),
        ["_us", "_act", "_own"],
        [NEVER, 0, 0],
        timer.summarize,
        timer.fold,
        timer.emit,
        "_due bigint, _sum bigint, _rows bigint",
        skew,
    )
    return fired.withColumn("fire_ts", F.timestamp_micros("_due"))


def timer_average(
    df: DataFrame,
    keys: list[str],
    ts: str,
    seq: str,
    value: str,
    period: timedelta,
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Average so far, given out on a timer. ``value`` is an integer column.

    A row sets the timer to ``period`` later if none is set. When it fires, the
    average of all rows before it (never reset) is given out.
    """
    fired = _fire(df, keys, ts, seq, period, F.lit(ARM), F.col(value), skew)
    return fired.select(
        *keys,
        "fire_ts",
        F.col("_sum").alias("sum"),
        F.col("_rows").alias("count"),
        ratio(F.col("_sum"), F.col("_rows")).alias("average"),
    )


def rising_alert(
    df: DataFrame,
    keys: list[str],
    ts: str,
    seq: str,
    value: str,
    period: timedelta,
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Alerts for values that did not fall for ``period`` after a rise.

    A rise sets the timer if none is set, a fall clears it, an equal value
    leaves it. Columns: keys and ``fire_ts``.
    """
    order = Order(seq, ts)
    rows = cut(df.select(*keys, ts, seq, value), keys, order, skew)
    before = neighbours(rows, keys, order, {"_previous": (value, -1)}, skew)
    previous, now = F.col("_previous"), F.col(value)
    act = F.when(previous.isNull() | (now < previous), CANCEL).when(now > previous, ARM).otherwise(0)
    fired = _fire(before, keys, ts, seq, period, act, F.lit(0), skew)
    return fired.select(*keys, "fire_ts")
