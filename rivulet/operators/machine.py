"""Finite state machines over keyed events."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.operators.scan import Rows, State, scan
from rivulet.operators.segments import DEFAULT, Order, Skew


@dataclass(frozen=True)
class Machine:
    """``moves`` maps (state, event) to (next state, whether to give out the row).

    The first state of the first move is where a key starts. An event without a
    move from a state leaves it.
    """

    moves: dict[tuple[str, str], tuple[str, bool]]

    @property
    def states(self) -> list[str]:
        names = [s for (s, _), (n, _) in self.moves.items() for s in (s, n)]
        return list(dict.fromkeys(names))

    @property
    def events(self) -> list[str]:
        return list(dict.fromkeys(e for _, e in self.moves))

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Next state and output flag by [state, event]; the last event code is "unknown"."""
        states, events = self.states, self.events
        move = np.tile(np.arange(len(states))[:, None], (1, len(events) + 1))
        gives = np.zeros(move.shape, dtype=bool)
        for (state, event), (target, out) in self.moves.items():
            at = states.index(state), events.index(event)
            move[at], gives[at] = states.index(target), out
        return move, gives


LOGIN_FAILURES = Machine(
    {
        ("INITIAL", "fail"): ("S1", False),
        ("INITIAL", "success"): ("INITIAL", False),
        ("S1", "fail"): ("S2", False),
        ("S1", "success"): ("INITIAL", False),
        ("S2", "fail"): ("S2", True),
        ("S2", "success"): ("INITIAL", False),
    }
)


def run_machine(
    df: DataFrame,
    keys: list[str],
    ts: str,
    seq: str,
    event: Column,
    machine: Machine,
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Rows at which the machine gives out something: keys, ``seq`` and ``state`` after it."""
    move, gives = machine.tables()
    names, events = machine.states, machine.events
    names_array = np.array(names, dtype=object)
    code = F.lit(len(events))
    for i, name in enumerate(events):
        code = F.when(event == name, i).otherwise(code)
    rows = df.withColumn("_event", code.cast("bigint")).withColumn("_seq", F.col(seq).cast("bigint"))

    def lines(rows: Rows) -> np.ndarray:
        """The events in about as many lines as a line has places, filled up with an event that moves nothing."""
        codes = rows["_event"]
        width = max(1, int(len(codes) ** 0.5))
        filled = np.full(-(-len(codes) // width) * width, len(events))
        filled[: len(codes)] = codes
        return filled.reshape(-1, width)

    def exits(table: np.ndarray) -> np.ndarray:
        """[line, state]: where a line leads from each state. All lines move on together."""
        out = np.tile(np.arange(len(names)), (len(table), 1))
        for at in range(table.shape[1]):
            out = move[out, table[:, at, None]]
        return out

    def passed(rows: Rows, state: int) -> np.ndarray:
        """The state before each row."""
        table = lines(rows)
        entries = []
        for leads in exits(table).tolist():
            entries.append(state)
            state = leads[state]
        now, out = np.array(entries), np.empty(table.shape, dtype=np.int64)
        for at in range(table.shape[1]):
            out[:, at] = now
            now = move[now, table[:, at]]
        return out.ravel()[: len(rows["_event"])]

    def summarize(rows: Rows) -> State:
        whole = np.arange(len(names))
        for leads in exits(lines(rows)):
            whole = leads[whole]
        return whole.tolist()

    def fold(state: State, summary: State) -> State:
        return [summary[state[0]]]

    def emit(rows: Rows, state: State, last: bool) -> list[np.ndarray]:
        before, codes = passed(rows, state[0]), rows["_event"]
        hit = gives[before, codes]
        return [rows["_seq"][hit], names_array[move[before[hit], codes[hit]]]]

    return scan(
        rows, keys, Order(seq, ts), ["_event", "_seq"], [0], summarize, fold, emit, f"`{seq}` bigint, state string", skew
    )
