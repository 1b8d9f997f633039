"""Key columns on their way through Python workers.

Pandas turns whole numbers with nulls among them into floats, which merges keys beyond 2^53. So a whole-number key
travels as two columns without nulls, the number (0 for null) and whether it is null, and is put together again after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _names(position: int) -> tuple[str, str]:
    return f"_key{position}", f"_null{position}"


def packed(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The rows with their keys in a form that survives, and the names of the new columns."""
    columns: list[Column] = []
    names: list[str] = []
    for i, key in enumerate(keys):
        value, null = _names(i)
        if isinstance(df.schema[key].dataType, WHOLE):
            columns += [F.coalesce(F.col(key).cast("bigint"), F.lit(0)).alias(value), F.col(key).isNull().alias(null)]
            names += [value, null]
        else:
            columns.append(F.col(key).alias(value))
            names.append(value)
    return df.select(*(c for c in df.columns if c not in keys), *columns), names


def unpacked(df: DataFrame, keys: list[T.StructField]) -> list[Column]:
    """The keys again, of the types they had."""
    out = []
    for i, field in enumerate(keys):
        value, null = _names(i)
        whole = isinstance(field.dataType, WHOLE)
        column = F.when(~F.col(null), F.col(value)).cast(field.dataType) if whole else F.col(value)
        out.append(column.alias(field.name))
    return out
