"""Idempotent keyed sinks: a hash of a key-value store, a relational table, a table of parquet files.

The client library is the caller's: ``connect`` runs in the task and returns a
connection. Before anything is sent, a batch is reduced to the last row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from rivulet.operators.upsert import latest_per_key


def _chunks(rows: Iterable[Row], size: int) -> Iterator[list[Row]]:
    rows = iter(rows)
    while chunk := list(islice(rows, size)):
        yield chunk


def hash_writer(connect: Callable[[], Any], name: str, key: str, value: str, chunk: int = 1000):
    """``hset(name, mapping=..)`` in chunks: key -> value as text."""

    def write(rows: Iterable[Row]) -> None:
        client = connect()
        try:
            for part in _chunks(rows, chunk):
                client.hset(name, mapping={str(r[key]): str(r[value]) for r in part})
        finally:
            client.close()

    return write


def to_hash(batch: DataFrame, connect: Callable[[], Any], name: str, key: str, value: str, seq: str) -> None:
    latest_per_key(batch.select(key, value, seq), [key], seq).foreachPartition(hash_writer(connect, name, key, value))


def row_upserter(
    connect: Callable[[], Any],
    table: str,
    keys: list[str],
    values: list[str],
    mark: str = "%s",
    statement: str | None = None,
    chunk: int = 1000,
):
    """Writes rows over one DB-API connection per task, in chunks.

    ``statement`` is the database's own upsert, with places for the keys and then the values. Without it a row is looked for,
    and then updated or inserted: that an update changed nothing does not say that no row is there.
    """
    match = " AND ".join(f"{k} = {mark}" for k in keys)
    look = f"SELECT 1 FROM {table} WHERE {match}"
    update = f"UPDATE {table} SET {', '.join(f'{v} = {mark}' for v in values)} WHERE {match}"
    insert = f"INSERT INTO {table} ({', '.join([*keys, *values])}) VALUES ({', '.join([mark] * len([*keys, *values]))})"

    def write(rows: Iterable[Row]) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            for part in _chunks(rows, chunk):
                if statement is not None:
                    cursor.executemany(statement, [[row[c] for c in [*keys, *values]] for row in part])
                    continue
                changed, new = [], []
                for row in part:
                    cursor.execute(look, [row[k] for k in keys])
                    if cursor.fetchone() is None:
                        new.append([row[c] for c in [*keys, *values]])
                    else:
                        changed.append([row[c] for c in [*values, *keys]])
                for text, given in ((update, changed), (insert, new)):
                    if given:
                        cursor.executemany(text, given)
            connection.commit()
        finally:
            connection.close()

    return write


def to_database(
    batch: DataFrame,
    connect: Callable[[], Any],
    table: str,
    keys: list[str],
    values: list[str],
    seq: str,
    mark: str = "%s",
    statement: str | None = None,
) -> None:
    latest = latest_per_key(batch.select(*keys, *values, seq), keys, seq)
    latest.foreachPartition(row_upserter(connect, table, keys, values, mark, statement))


def append_batch(batch: DataFrame, batch_id: int, path: str, keys: list[str], seq: str) -> None:
    """Add a batch's last rows to a table of batches. Writing a batch again replaces it."""
    latest_per_key(batch, keys, seq).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_upserted(spark: SparkSession, path: str, keys: list[str], seq: str) -> DataFrame:
    """The table's state: the row of the last batch, then of the last arrival, per key."""
    stored = spark.read.parquet(path)
    place = F.struct("batch", seq)
    return latest_per_key(stored.withColumn("_place", place), keys, "_place").drop("_place", "batch")
