"""State carried row by row along a key, for results no window function can give.

Rows are shuffled by (key, segment) and sorted; numpy code works on one segment
at a time. A key below the hot limit is one segment. For a hot key every
segment is first reduced, in parallel, to a summary: what it makes of any state
it may be entered with. Folding the summaries in order gives each segment its
entry state, and then all segments run in parallel again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rivulet.operators.keys import packed, unpacked
from rivulet.operators.segments import DEFAULT, HOT, PIECES, Order, Skew, cut

Rows = dict[str, np.ndarray]
State = list[int]
Summarize = Callable[[Rows], State]
Fold = Callable[[State, State], State]
Emit = Callable[[Rows, State, bool], list[np.ndarray]]

FLUSH = 50_000


def _starts(rows: Rows, columns: list[str]) -> np.ndarray:
    """Positions at which a group begins. Nulls are equal to nulls."""
    size = len(rows[columns[0]])
    new = np.zeros(size, dtype=bool)
    for name in columns:
        here, above = rows[name][1:], rows[name][:-1]
        new[1:] |= (here != above) & ~(pd.isna(here) & pd.isna(above))
    if size:
        new[0] = True
    return np.flatnonzero(new)


def _groups(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[Rows]:
    """Whole groups from sorted batches; only the open group is held."""
    held: list[Rows] = []

    def whole() -> Rows:
        return held[0] if len(held) == 1 else {n: np.concatenate([h[n] for h in held]) for n in held[0]}

    for pdf in batches:
        if not len(pdf):
            continue
        rows = {n: pdf[n].to_numpy() for n in pdf.columns}
        starts = _starts(rows, columns)
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(pdf)])):
            piece = {n: v[a:b] for n, v in rows.items()}
            if i == 0 and held:
                pair = {n: np.array([held[-1][n][-1], piece[n][0]], dtype=object) for n in columns}
                if len(_starts(pair, columns)) == 1:
                    held.append(piece)
                    continue
            if held:
                yield whole()
            held = [piece]
    if held:
        yield whole()


def scan(
    df: DataFrame,
    keys: list[str],
    order: Order,
    values: list[str],
    initial: State,
    summarize: Summarize,
    fold: Fold,
    emit: Emit,
    schema: str,
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Run a keyed state over ordered rows; ``emit`` gives the output columns of a segment.

    ``values`` are the non-null bigint columns the functions see, as arrays.
    ``summarize(rows)`` -> summary, ``fold(state, summary)`` -> next state,
    ``emit(rows, state, last)`` -> one array per column of ``schema``; the keys
    are put before them. States and summaries are lists of integers.
    """
    sort = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order.columns)]
    sorted_by = [f"_o{i}" for i in range(len(sort))]
    own_fields = [df.schema[k] for k in keys]
    piece_fields = [T.StructField(p, T.LongType()) for p in PIECES]
    numbers = T.ArrayType(T.LongType())

    parts = cut(df, keys, order, skew).select(*keys, *PIECES, HOT, *sort, *(F.col(v).alias(f"_v{i}") for i, v in enumerate(values)))
    parts, keys = packed(parts, keys)
    key_fields = [parts.schema[k] for k in keys]
    group = [*keys, *PIECES]
    rows_in = parts.select(
        *keys,
        *PIECES,
        *sorted_by,
        *(F.col(f"_v{i}").alias(v) for i, v in enumerate(values)),
        HOT,
        F.lit(1).alias("_mark"),
        F.lit(None).cast("array<bigint>").alias("_state"),
        F.lit(True).alias("_last"),
    )
    entered = rows_in.drop(HOT)
    if skew is not None:
        hot = rows_in.where(HOT).select(*group, *sorted_by, *values)
        hot = hot.repartition(*group).sortWithinPartitions(*group, *sorted_by).select(*group, *values)

        def summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in _groups(batches, group):
                head = pd.DataFrame({n: rows[n][:1] for n in group})
                head["_summary"] = [[int(v) for v in summarize(rows)]]
                yield head

        reduced = hot.mapInPandas(
            summaries, T.StructType([*key_fields, *piece_fields, T.StructField("_summary", numbers)])
        )
        along = Window.partitionBy(*keys).orderBy(*PIECES)
        reduced = reduced.withColumn("_last", F.lead(F.lit(False), 1, True).over(along))
        reduced = reduced.repartition(*keys) if keys else reduced.coalesce(1)
        reduced = reduced.sortWithinPartitions(*group)

        def states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            state = initial
            for pdf in batches:
                entry = []
                for summary, last in zip(pdf["_summary"], pdf["_last"]):
                    entry.append([int(v) for v in state])
                    state = initial if last else fold(state, [int(v) for v in summary])
                out = pdf[[*group, "_last"]].copy()
                out["_state"] = entry
                yield out[[*group, "_state", "_last"]]

        carried = reduced.mapInPandas(
            states,
            T.StructType(
                [*key_fields, *piece_fields, T.StructField("_state", numbers), T.StructField("_last", T.BooleanType())]
            ),
        )
        # A segment's entry state travels as its first row, so the rows need no join.
        blank = [F.lit(0).cast("bigint").alias(v) for v in values]
        nothing = [F.lit(None).alias(c) for c in sorted_by]
        entered = entered.unionByName(
            carried.select(*group, *nothing, *blank, F.lit(0).alias("_mark"), "_state", "_last")
        )

    # A fixed number of partitions: small ones would be merged by size, though Python time is what counts.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    used = entered.repartition(tasks, *group).sortWithinPartitions(*group, "_mark", *sorted_by)
    used = used.select(*group, *values, "_mark", "_state", "_last")
    fields = T.StructType.fromDDL(schema).fields

    def results(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owners: list[tuple] = []
        made: list[list[np.ndarray]] = []
        size = 0

        def frame() -> pd.DataFrame:
            times = [len(m[0]) for m in made]
            columns = {
                k: pd.Series([o[i] for o in owners]).repeat(times).reset_index(drop=True) for i, k in enumerate(keys)
            }
            columns |= {f.name: np.concatenate([m[i] for m in made]) for i, f in enumerate(fields)}
            return pd.DataFrame(columns)

        for rows in _groups(batches, group):
            state, last = initial, True
            if rows["_mark"][0] == 0:
                state, last = [int(v) for v in rows["_state"][0]], bool(rows["_last"][0])
                rows = {n: v[1:] for n, v in rows.items()}
            columns = emit(rows, state, last)
            if len(columns[0]):
                owners.append(tuple(rows[k][0] for k in keys))
                made.append(columns)
                size += len(columns[0])
            if size >= FLUSH:
                yield frame()
                owners, made, size = [], [], 0
        if made:
            yield frame()

    made = used.mapInPandas(results, T.StructType([*key_fields, *fields]))
    return made.select(*unpacked(made, own_fields), *(F.col(f.name) for f in fields))
