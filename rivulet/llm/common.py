"""What several operators share: word pattern, written tables, texts without nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.session import scratch_path

_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: A word: a longest run of anything but white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared scratch folder and read back: later steps neither
    repeat the work nor depend on the executors that did it. So its shuffle files go as soon as it is written,
    not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``id`` and ``text`` (null: empty); all others are left behind."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )


def held_out(id_: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the number as text falls in the fold; a null number does not."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds == fold, F.lit(False))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
