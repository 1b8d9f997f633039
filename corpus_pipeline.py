"""From raw documents to a training mix: five stages, each over all that its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of ``docs``. A classifier has no SQL, so ORACLE_SQL is None; the tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import decontamination, jaccard, mixing, quality, secrets
from rivulet.llm.common import held_out, stored
from rivulet.llm.registry import table

ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labelled documents outside the held-out third."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 3, 1))
    return quality.accepted(docs, quality.fitted(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies: five words, similarity 0.8 or more.

    A repeated id stays if any of its rows does; rows without id stay.
    """
    groups = jaccard.joined(docs, jaccard.Join(words=5, percent=80))
    copies = groups.groupBy("doc_id").agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("copy")).where("copy")
    return docs.join(stored(copies.select("doc_id"), "copies"), "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark and ``n_chars`` counted anew."""
    rows = docs.select(F.struct("*").alias("whole"), "doc_id", "text")  # other columns may have any name
    scanned = secrets.scan(rows, keep=["whole"]).withColumn("text", secrets.redacted())
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}
    return scanned.select(*(new.get(c, F.col(f"whole.`{c}`")).alias(c) for c in docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the documents that it takes and how many words of each, repeats counted."""
    return mixing.mixed(docs).where("taken > 0")


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
