"""Stateful operators on streams, as steps per key, and the functions that run them.

With ``ts`` they run in event time, with ``ts=None`` on the machine's clock.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.rows import ratio
from rivulet.functions.time import interval, micros, span
from rivulet.operators.machine import Machine
from rivulet.streaming.ordered import NONE, Out, Steps, run_steps

ZERO = timedelta(0)


class _RunningTotals(Steps):
    schema = "number bigint, sum bigint, count bigint, max bigint"

    def start(self):
        return [0, 0, NONE]

    def row(self, memo, us, number, value) -> Out:
        memo[:] = [memo[0] + value, memo[1] + 1, value if memo[1] == 0 else max(memo[2], value)]
        return [(number, *memo)]


def running_totals(
    df: DataFrame, keys: list[str], ts: str | None, seq: str, value: str, delay: timedelta = ZERO
) -> DataFrame:
    """One row per input row: sum, count, max and average so far."""
    out = run_steps(df, keys, ts, seq, F.col(value), _RunningTotals(), delay)
    return out.withColumnRenamed("number", seq).withColumn("average", ratio(F.col("sum"), F.col("count")))


class _TimerAverage(Steps):
    """memo: sum, count, due."""

    schema = "_due bigint, sum bigint, count bigint"

    def __init__(self, period: int):
        self.period = period

    def start(self):
        return [0, 0, NONE]

    def due(self, memo):
        return memo[2]

    def row(self, memo, us, number, value) -> Out:
        memo[:] = [memo[0] + value, memo[1] + 1, us + self.period if memo[2] == NONE else memo[2]]
        return []

    def alarm(self, memo) -> Out:
        out = [(memo[2], memo[0], memo[1])]
        memo[2] = NONE
        return out


def timer_average(
    df: DataFrame, keys: list[str], ts: str | None, seq: str, value: str, period: timedelta, delay: timedelta = ZERO
) -> DataFrame:
    out = run_steps(df, keys, ts, seq, F.col(value), _TimerAverage(micros(period)), delay)
    return out.select(
        *keys,
        F.timestamp_micros("_due").alias("fire_ts"),
        "sum",
        "count",
        ratio(F.col("sum"), F.col("count")).alias("average"),
    )


class _DelayTimers(Steps):
    """memo: due times, ascending, each once; on the machine's clock one per micro-batch."""

    schema = "_due bigint"

    def __init__(self, delay: int):
        self.delay = delay

    def due(self, memo):
        return memo[0] if memo else NONE

    def row(self, memo, us, number, value) -> Out:
        if not memo or memo[-1] != us + self.delay:
            memo.append(us + self.delay)
        return []

    def alarm(self, memo) -> Out:
        return [(memo.pop(0),)]


def delay_timers(
    df: DataFrame, keys: list[str], ts: str | None, seq: str, after: timedelta, delay: timedelta = ZERO
) -> DataFrame:
    """One firing per key and due time, ``after`` each row, once the watermark has passed it.

    In event time this is a group per key and due time: its row comes out when
    the watermark, here declared on the due time, closes it.
    """
    if ts is None:
        out = run_steps(df, keys, None, seq, F.lit(0), _DelayTimers(micros(after)))
        return out.select(*keys, F.timestamp_micros("_due").alias("fire_ts"))
    due = df.select(*keys, (F.col(ts) + interval(after)).alias("fire_ts")).withWatermark("fire_ts", span(delay + after))
    return due.groupBy(*keys, "fire_ts").count().drop("count")


class _RisingAlert(Steps):
    """memo: due, then the last value once there is one."""

    schema = "_due bigint"

    def __init__(self, period: int):
        self.period = period

    def start(self):
        return [NONE]

    def due(self, memo):
        return memo[0]

    def row(self, memo, us, number, value) -> Out:
        if len(memo) == 1 or value < memo[1]:
            memo[0] = NONE
        elif value > memo[1] and memo[0] == NONE:
            memo[0] = us + self.period
        memo[1:] = [value]
        return []

    def alarm(self, memo) -> Out:
        out = [(memo[0],)]
        memo[0] = NONE
        return out


def rising_alert(
    df: DataFrame, keys: list[str], ts: str | None, seq: str, value: str, period: timedelta, delay: timedelta = ZERO
) -> DataFrame:
    out = run_steps(df, keys, ts, seq, F.col(value), _RisingAlert(micros(period)), delay)
    return out.select(*keys, F.timestamp_micros("_due").alias("fire_ts"))


class _Machine(Steps):
    """memo: state code."""

    schema = "number bigint, state string"

    def __init__(self, machine: Machine):
        move, gives = machine.tables()
        self.move, self.gives, self.names = move.tolist(), gives.tolist(), machine.states

    def start(self):
        return [0]

    def row(self, memo, us, number, value) -> Out:
        gives = self.gives[memo[0]][value]
        memo[0] = self.move[memo[0]][value]
        return [(number, self.names[memo[0]])] if gives else []


def run_machine(
    df: DataFrame, keys: list[str], ts: str | None, seq: str, event: Column, machine: Machine, delay: timedelta = ZERO
) -> DataFrame:
    code = F.lit(len(machine.events))
    for i, name in enumerate(machine.events):
        code = F.when(event == name, i).otherwise(code)
    return run_steps(df, keys, ts, seq, code, _Machine(machine), delay).withColumnRenamed("number", seq)


class _Sequence(Steps):
    """memo: (time, conditions met) of the last rows, oldest first; conditions are bits."""

    schema = "times array<bigint>"

    def __init__(self, length: int):
        self.length = length

    def row(self, memo, us, number, value) -> Out:
        memo.extend((us, value))
        while len(memo) > 2 * self.length:
            del memo[:2]
        met = memo[1::2]
        if len(met) == self.length and all(m >> i & 1 for i, m in enumerate(met)):
            return [(memo[::2],)]
        return []


def strict_sequence(
    df: DataFrame, keys: list[str], ts: str | None, seq: str, steps: dict[str, Column], delay: timedelta = ZERO
) -> DataFrame:
    met = F.lit(0)
    for i, condition in enumerate(steps.values()):
        met = met + F.when(condition, 1 << i).otherwise(0)
    out = run_steps(df, keys, ts, seq, met, _Sequence(len(steps)), delay)
    return out.select(*keys, *(F.timestamp_micros(F.col("times")[i]).alias(f"{n}_ts") for i, n in enumerate(steps)))


def repeated(
    df: DataFrame, keys: list[str], ts: str | None, seq: str, condition: Column, names: list[str], delay: timedelta = ZERO
) -> DataFrame:
    return strict_sequence(df.where(condition), keys, ts, seq, {n: F.lit(True) for n in names}, delay)


class _FollowedWithin(Steps):
    """memo: time of the open first row or NONE. Bits of a row: 1 first, 2 then."""

    schema = "first_us bigint, then_us bigint, output string"

    def __init__(self, limit: int, at_limit: bool):
        self.limit, self.alarm_first = limit, not at_limit

    def start(self):
        return [NONE]

    def due(self, memo):
        return NONE if memo[0] == NONE else memo[0] + self.limit

    def row(self, memo, us, number, value) -> Out:
        out = [(memo[0], us, "match")] if memo[0] != NONE and value & 2 else []
        memo[0] = us if value & 1 else NONE
        return out

    def alarm(self, memo) -> Out:
        out = [(memo[0], None, "timeout")]
        memo[0] = NONE
        return out


def followed_within(
    df: DataFrame,
    keys: list[str],
    ts: str | None,
    seq: str,
    first: Column,
    then: Column,
    limit: timedelta,
    delay: timedelta = ZERO,
    at_limit: bool = False,
) -> DataFrame:
    """With ``at_limit`` a row exactly at the limit is still in time."""
    bits = F.when(first, 1).otherwise(0) + F.when(then, 2).otherwise(0)
    out = run_steps(df, keys, ts, seq, bits, _FollowedWithin(micros(limit), at_limit), delay)
    return out.select(
        *keys,
        F.timestamp_micros("first_us").alias("first_ts"),
        F.timestamp_micros("then_us").alias("then_ts"),
        "output",
    )


class _Reconcile(Steps):
    """memo: side that waits, how many of its rows are gone, then the times of its rows, oldest first. A row's value is its side.

    A row that meets waiting rows of the other side takes the oldest, so rows of one side only ever wait.
    """

    schema = "status string, left_us bigint, right_us bigint"
    alarm_first = False

    def __init__(self, limit: int):
        self.limit = limit

    def start(self):
        return [0, 0]

    def due(self, memo):
        at = 2 + memo[1]
        return memo[at] + self.limit if at < len(memo) else NONE

    def _next(self, memo) -> int:
        at = memo[2 + memo[1]]
        memo[1] += 1
        if 2 * memo[1] >= len(memo) - 2:  # half of the list is gone: close up
            memo[1:] = [0, *memo[2 + memo[1] :]]
        return at

    def row(self, memo, us, number, value) -> Out:
        if len(memo) == 2 + memo[1]:
            memo[0] = value
        if memo[0] == value:
            memo.append(us)
            return []
        other = self._next(memo)
        return [("matched", us, other) if value == 0 else ("matched", other, us)]

    def alarm(self, memo) -> Out:
        side, at = memo[0], self._next(memo)
        return [("no_right", at, None) if side == 0 else ("no_left", None, at)]


def reconcile(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_ts: str,
    right_ts: str,
    limit: timedelta,
    delay: timedelta = ZERO,
) -> DataFrame:
    """Match the rows of two streams one to one; both become one stream with a side tag.

    In order of time, a row takes the oldest row of the other side that still waits, or waits itself, for ``limit`` at most.
    """
    tagged = [
        side.select(*on, F.col(at).alias("at_ts"), F.lit(i).alias("at_side"))
        for i, (side, at) in enumerate(((left, left_ts), (right, right_ts)))
    ]
    both = tagged[0].unionByName(tagged[1])
    out = run_steps(both, on, "at_ts", "at_side", F.col("at_side"), _Reconcile(micros(limit)), delay)
    return out.select(
        *on,
        "status",
        F.timestamp_micros("left_us").alias(left_ts),
        F.timestamp_micros("right_us").alias(right_ts),
    )
