"""op13: periodic run detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivulet.llm import repetitions
from rivulet.llm.common import WORD
from rivulet.llm.registry import query, table


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def planted(id_: Column, text: Column) -> Column:
    """The text of a tenth of the documents from a word on replaced by repetitions; a null id plants nothing."""
    h = F.crc32(id_.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeat(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        times, rest = F.floor((n - a) / p).cast("int"), ((n - a) % p).cast("int")
        again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), again, F.slice(words, a + 1, rest)), " ")

    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    changed = _let(words, lambda w: F.when(F.size(w) > 0, repeat(w)).otherwise(""))
    return F.when(h % 10 == 0, changed).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the one with the most periods, and digests of all runs and of the collapsed text."""

    def more(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), more)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("*", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_repetitions")
def op13_repetitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, a tenth of which get some planted."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    return digests(repetitions.detected(docs.select("doc_id", planted(F.col("doc_id"), text).alias("text"))))
