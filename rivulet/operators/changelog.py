"""Changelogs: how a grouped result changes, as rows with a ``row_kind``.

Kinds: ``+I`` insert, ``-U`` the value before an update, ``+U`` the value after
it, ``-D`` delete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.operators.segments import DEFAULT, Order, Running, Skew, running


def _change(kind: str, value: Column, name: str) -> Column:
    return F.struct(F.lit(kind).alias("row_kind"), value.alias(name))


def rolling_changelog(
    df: DataFrame,
    keys: list[str],
    seq: str,
    counted: str | None = None,
    count: str = "count",
    skew: Skew | None = DEFAULT,
) -> DataFrame:
    """Changes of ``COUNT(counted) GROUP BY keys`` as the rows arrive.

    ``change_seq`` is the arrival number of the row that made the change. A row
    that leaves the count as it was (a null) changes nothing, but a group's
    first row always inserts it.
    """
    measures = [
        Running("_after", "count", counted),
        Running("_rows", "count"),
    ]
    rows = df.select(*keys, seq, *([counted] if counted and counted not in (*keys, seq) else []))
    counts = running(rows, keys, Order(seq), measures, skew)
    after = F.col("_after")
    before = after - 1 if counted is None else after - F.col(counted).isNotNull().cast("bigint")
    changes = F.when(F.col("_rows") == 1, F.array(_change("+I", after, count))).when(
        before != after, F.array(_change("-U", before, count), _change("+U", after, count))
    )
    return counts.withColumn("_change", F.explode(changes)).select(
        *keys, F.col(seq).alias("change_seq"), "_change.row_kind", f"_change.{count}"
    )


def changelog_between(previous: DataFrame, current: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Changes that turn one snapshot of a keyed result into the next. Null keys are equal."""
    old = previous.select(*keys, F.struct(*values).alias("_old"))
    new = current.select(*(F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)), F.struct(*values).alias("_new"))
    both = old.join(new, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)], "full")
    both = both.select(*(F.coalesce(k, f"_key_{i}").alias(k) for i, k in enumerate(keys)), "_old", "_new")
    gone, came = F.col("_new").isNull(), F.col("_old").isNull()

    def change(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("row_kind"), F.col(side).alias("_value"))

    changes = (
        F.when(came, F.array(change("+I", "_new")))
        .when(gone, F.array(change("-D", "_old")))
        .when(~F.col("_old").eqNullSafe(F.col("_new")), F.array(change("-U", "_old"), change("+U", "_new")))
    )
    return both.withColumn("_change", F.explode(changes)).select(
        *keys, "_change.row_kind", *(F.col("_change._value")[v].alias(v) for v in values)
    )
