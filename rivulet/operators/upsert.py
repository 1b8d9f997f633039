"""Keyed upserts: what a batch changes in a target table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_per_key(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last row of each key by the unique ``seq``. Map tasks already reduce to one row per key.

    Column by column, so that fixed-width columns are aggregated by hash.
    """
    others = [c for c in df.columns if c not in (*keys, seq)]
    latest = df.groupBy(*keys).agg(F.max(seq).alias(seq), *(F.max_by(c, seq).alias(c) for c in others))
    return latest.select(*df.columns)


def _matches(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A semi or anti join in which null keys are equal."""
    other = right.select(*(F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return left.join(other, same, how)


def split_upsert(batch: DataFrame, target: DataFrame, keys: list[str], seq: str) -> tuple[DataFrame, DataFrame]:
    """(updates, inserts) of a batch against a target: last write per key, then by presence."""
    latest = latest_per_key(batch, keys, seq)
    return _matches(latest, target, keys, "left_semi"), _matches(latest, target, keys, "left_anti")


def upserted(target: DataFrame, batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The target after the batch: its rows of untouched keys and the batch's last rows."""
    latest = latest_per_key(batch, keys, seq).select(*target.columns)
    return _matches(target, latest, keys, "left_anti").select(*target.columns).unionByName(latest)
