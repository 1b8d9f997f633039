"""Changelogs of streams: rows with a ``row_kind``, from the former value of each key.

The former values are a keyed table between micro-batches; within one, rows of a key follow each
other by ``seq``. A micro-batch that is run again gives the same changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from rivulet.operators.segments import DEFAULT, Order, Running, Skew, running
from rivulet.operators.upsert import latest_per_key
from rivulet.streaming.tables import BEFORE_ALL, KeyedTable, kept, touched

Write = Callable[[DataFrame, int], None]


def _change(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("row_kind"), value.alias("value"))


def count_changes(
    df: DataFrame,
    keys: list[str],
    seq: str,
    home: str,
    write: Write,
    counted: str | None = None,
    count: str = "count",
    skew: Skew | None = DEFAULT,
) -> DataStreamWriter:
    """Changes of ``COUNT(counted) GROUP BY keys``: +I for a group's first row, then -U and +U for each row that counts.

    ``change_seq`` is the arrival number of the row that made the change.
    """
    table = KeyedTable(f"{home}/counts", keys)

    def each(batch: DataFrame, batch_id: int) -> None:
        with kept(batch):
            one = F.lit(1).cast("bigint")
            value = one if counted is None else F.col(counted).isNotNull().cast("bigint")
            rows = batch.select(
                *keys, F.col(seq).alias("_place"), value.alias("_n"), one.alias("_rows"), F.lit(True).alias("_row")
            )
            state = table.before(batch.sparkSession, batch_id)
            if state is not None:
                former = touched(state, batch, keys)
                rows = rows.unionByName(
                    former.select(*keys, F.lit(BEFORE_ALL).alias("_place"), "_n", "_rows", F.lit(False).alias("_row"))
                )
            totals = rows.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sum("_rows").alias("_rows"))
            table.write(totals, batch_id)
            measures = [Running("_after", "sum", "_n"), Running("_number", "sum", "_rows")]
            counts = running(rows, keys, Order("_place"), measures, skew).where("_row")
            after = F.col("_after")
            changes = F.when(F.col("_number") == 1, F.array(_change("+I", after))).when(
                F.col("_n") > 0, F.array(_change("-U", after - 1), _change("+U", after))
            )
            write(
                counts.select(*keys, F.col("_place").alias("change_seq"), F.explode(changes).alias("_change")).select(
                    *keys, "change_seq", "_change.row_kind", F.col("_change.value").alias(count)
                ),
                batch_id,
            )

    return df.writeStream.foreachBatch(each)


def upsert_changes(
    df: DataFrame,
    keys: list[str],
    value: str,
    seq: str,
    deletes: Column,
    home: str,
    write: Write,
    skew: Skew | None = DEFAULT,
) -> DataStreamWriter:
    """Changes of a keyed table that rows set and, where ``deletes`` holds, remove: +I, -U and +U, or -D.

    A row that sets the value there is, or removes what is not there, changes nothing.
    """
    table = KeyedTable(f"{home}/rows", keys)

    def each(batch: DataFrame, batch_id: int) -> None:
        with kept(batch):
            there = ~F.coalesce(deletes, F.lit(False))
            rows = batch.select(
                *keys,
                F.col(seq).alias("_place"),
                F.struct(F.when(there, F.col(value)).alias("v"), there.alias("there")).alias("_new"),
                F.lit(True).alias("_row"),
            )
            state = table.before(batch.sparkSession, batch_id)
            if state is not None:
                former = touched(state, batch, keys)
                rows = rows.unionByName(
                    former.select(*keys, F.lit(BEFORE_ALL).alias("_place"), "_new", F.lit(False).alias("_row"))
                )
            table.write(latest_per_key(rows.drop("_row"), keys, "_place").drop("_place"), batch_id)
            followed = running(rows, keys, Order("_place"), [Running("_old", "last", "_new", before=True)], skew)
            old, new = F.col("_old"), F.col("_new")
            was = F.coalesce(old["there"], F.lit(False))
            changes = (
                F.when(~was & new["there"], F.array(_change("+I", new["v"])))
                .when(was & ~new["there"], F.array(_change("-D", old["v"])))
                .when(
                    was & ~old["v"].eqNullSafe(new["v"]), F.array(_change("-U", old["v"]), _change("+U", new["v"]))
                )
            )
            write(
                followed.where("_row")
                .select(*keys, F.col("_place").alias("change_seq"), F.explode(changes).alias("_change"))
                .select(*keys, "change_seq", "_change.row_kind", F.col("_change.value").alias(value)),
                batch_id,
            )

    return df.writeStream.foreachBatch(each)
