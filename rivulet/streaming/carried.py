"""Row-exact operators on streams that batch operators compute per micro-batch.

What a micro-batch needs from the earlier ones is a small table: totals per
key, or the latest query. It is put before the batch's rows as rows of its own,
so a hot key is cut into segments like in batch and nothing is joined to its
rows. Keyed tables write only the keys that a micro-batch has, under its number: a
batch that is run again reads the same state and writes it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from rivulet.functions.rows import ratio
from rivulet.operators.joins import dynamic_filter
from rivulet.operators.segments import DEFAULT, Order, Running, Skew, running
from rivulet.operators.upsert import latest_per_key
from rivulet.streaming.tables import BEFORE_ALL, KeyedTable, kept, touched

Write = Callable[[DataFrame, int], None]


def _state(spark: SparkSession, home: str, batch_id: int) -> DataFrame | None:
    return spark.read.parquet(f"{home}/{batch_id - 1}") if batch_id > 0 else None


def rolling_totals(
    df: DataFrame, keys: list[str], value: str, seq: str, home: str, write: Write, skew: Skew | None = DEFAULT
) -> DataStreamWriter:
    """Every row with ``sum``, ``count``, ``max`` and ``average`` of its key so far."""

    table = KeyedTable(f"{home}/totals", keys)

    def each(batch: DataFrame, batch_id: int) -> None:
        with kept(batch):
            rows = batch.select(
                "*",
                F.col(seq).alias("_place"),
                F.col(value).alias("_sum"),
                F.lit(1).cast("bigint").alias("_count"),
                F.col(value).alias("_max"),
                F.lit(True).alias("_row"),
            )
            state = table.before(batch.sparkSession, batch_id)
            if state is not None:
                state = touched(state, batch, keys)
                state = state.withColumn("_place", F.lit(BEFORE_ALL)).withColumn("_row", F.lit(False))
                rows = rows.unionByName(state, allowMissingColumns=True)
            totals = rows.groupBy(*keys).agg(
                F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"), F.max("_max").alias("_max")
            )
            table.write(totals, batch_id)
            measures = [Running("sum", "sum", "_sum"), Running("count", "sum", "_count"), Running("max", "max", "_max")]
            counted = running(rows, keys, Order("_place"), measures, skew).where("_row")
            counted = counted.withColumn("average", ratio(F.col("sum"), F.col("count")))
            write(counted.select(*df.columns, "sum", "count", "max", "average"), batch_id)

    return df.writeStream.foreachBatch(each)


def mean_views(
    df: DataFrame, user: str, seq: str, home: str, write: Write, by: list[str] | None = None, skew: Skew | None = DEFAULT
) -> DataStreamWriter:
    """Every row with rows so far / distinct users so far: ``views``, ``users``, ``mean_views``.

    The users seen are a keyed table; a micro-batch adds its new ones to it.
    """
    by = by or []
    seen, totals_table = KeyedTable(f"{home}/users", [*by, user]), KeyedTable(f"{home}/totals", by)

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with kept(batch):
            users = batch.groupBy(*by, user).agg(F.min(seq).alias("_first"))
            known = seen.before(spark, batch_id)
            if known is not None:
                same = [F.col(f"_seen.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in (*by, user)]
                users = users.alias("_new").join(known.alias("_seen"), same, "left_anti")
            with kept(users):
                seen.write(users, batch_id)
                zero, one, place = F.lit(0).cast("bigint"), F.lit(1).cast("bigint"), F.col(seq) * 2 + 1
                rows = batch.select(
                    "*", one.alias("_views"), zero.alias("_users"), place.alias("_place"), F.lit(True).alias("_row")
                )
                first = (F.col("_first") * 2).alias("_place")
                others = [users.select(*by, zero.alias("_views"), one.alias("_users"), first)]
                state = totals_table.before(spark, batch_id)
                if state is not None:
                    others.append(touched(state, batch, by).withColumn("_place", F.lit(BEFORE_ALL)))
                for other in others:
                    rows = rows.unionByName(other.withColumn("_row", F.lit(False)), allowMissingColumns=True)
                totals = rows.groupBy(*by).agg(F.sum("_views").alias("_views"), F.sum("_users").alias("_users"))
                totals_table.write(totals, batch_id)
                measures = [Running("views", "sum", "_views"), Running("users", "sum", "_users")]
                counted = running(rows, by, Order("_place"), measures, skew).where("_row")
                counted = counted.withColumn("mean_views", ratio(F.col("views"), F.col("users")))
                write(counted.select(*df.columns, "views", "users", "mean_views"), batch_id)

    return df.writeStream.foreachBatch(each)


def filtered_by_latest(
    rows: DataFrame, queries: DataFrame, field: str, query: str, seq: str, home: str, write: Write
) -> DataStreamWriter:
    """``dynamic_filter`` over two streams in one arrival order; the state is the one latest query."""
    tagged = rows.withColumn("_asks", F.lit(False)).unionByName(
        queries.select(F.col(seq), F.col(query).alias("_query"), F.lit(True).alias("_asks")), allowMissingColumns=True
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        asked = batch.where("_asks").select(seq, F.col("_query").alias(query))
        state = _state(batch.sparkSession, home, batch_id)
        if state is not None:
            asked = asked.unionByName(state)
        clicks = batch.where(~F.col("_asks")).select(*rows.columns)
        latest = latest_per_key(asked.withColumn("_all", F.lit(0)), ["_all"], seq).select(seq, query)
        latest.write.mode("overwrite").parquet(f"{home}/{batch_id}")
        write(dynamic_filter(clicks, asked, field, query, seq), batch_id)

    return tagged.writeStream.foreachBatch(each)
