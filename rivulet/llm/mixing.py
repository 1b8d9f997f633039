"""Mixing sources to target weights: hash order within each source, distributed prefix sums, exact cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from rivulet.llm.common import WORD, stored


def targets(totals: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """One row per source with its ``target``.

    ``totals`` has ``source``, ``words`` and ``rows``. The sources take the weights in turn, by code point and null
    last. All targets together are ``share`` times all words; none exceeds ``most`` times its source, and what is over
    goes to the others by weight. Filling up in the order of words / weight gives the same as sharing again and again.
    """
    everything = Window.partitionBy()
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    filling = Window.orderBy(F.col("words") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.col("words") * float(most)
    return (
        totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
        .withColumn("all", F.sum("words").over(everything) * float(share))
        .withColumn("before", F.coalesce(F.sum(full).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weights_on", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("stopped", full * F.col("weights_on") <= F.col("weight") * (F.col("all") - F.col("before")))
        .withColumn("left", F.col("all") - F.sum(F.when(F.col("stopped"), full).otherwise(0.0)).over(everything))
        .withColumn("sharing", F.sum(F.when(F.col("stopped"), 0).otherwise(F.col("weight"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("stopped") | (F.col("sharing") == 0), full).otherwise(F.col("left") / F.col("sharing") * F.col("weight")),
        )
        .select("source", "words", "rows", "target")
    )


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    rows_per_bin: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words the mix takes from each document.

    Each document gets a random key, the MD5 of its id and the seed, so reruns agree. Within a source the documents
    are sorted by that key; prefix sums of their words say where the source's budget ends. Whole epochs come first;
    the last one is cut at the exact word, so a source's words add up to its target rounded down.

    The prefix sums are distributed: a source's key range is cut into equal bins of about ``rows_per_bin`` documents,
    bins into groups of 1024. A source of any size is spread over its bins, and only sums of bins and groups meet.
    The table of sources has one row per source and is computed in one task.

    Returns ``doc_id, source, size, source_size, target, taken``, one row per row of ``docs``. Null text: size 0. Null sources are
    one source, the last. Null ids share one key; ties of the key are broken by id and size, so repeated rows are
    taken one after the other. Empty table: no rows. Other columns of ``docs`` play no part.
    """
    sized = stored(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.col(f"`{source_col}`").alias("source"),
            F.coalesce(F.regexp_count(f"`{text_col}`", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(f":{seed}"))).alias("key"),
        ).withColumn("name", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))),
        "mix-sizes",
    )
    totals = sized.groupBy("source", "name").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    budgets = targets(totals.select("source", "words", "rows"), weights, share, most)
    epochs = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0)
    budgets = stored(
        budgets.select(
            F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("name"),
            F.col("words").alias("source_size"),
            "target",
            epochs.cast("long").alias("epochs"),
            (F.floor("target") - epochs * F.col("words")).cast("long").alias("rest"),
            F.ceil(F.col("rows") / rows_per_bin).alias("bins"),
        ),
        "mix-targets",
    )
    place = F.conv(F.substring("key", 1, 7), 16, 10).cast("long")
    binned = sized.join(budgets, "name").withColumn("bin", F.floor(place * F.col("bins") / F.lit(1 << 28)).cast("long"))
    sums = binned.groupBy("name", "bin").agg(F.sum("size").alias("sum")).withColumn("group", F.floor(F.col("bin") / 1024))
    earlier = lambda *keys: Window.partitionBy("name", *keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        sums.groupBy("name", "group")
        .agg(F.sum("sum").alias("sum"))
        .select("name", "group", F.coalesce(F.sum("sum").over(earlier("group")), F.lit(0)).alias("of_groups"))
    )
    starts = (
        sums.withColumn("of_bins", F.coalesce(F.sum("sum").over(earlier("group", "bin")), F.lit(0)))
        .join(groups, ["name", "group"])
        .select("name", "bin", (F.col("of_groups") + F.col("of_bins")).alias("start"))
    )
    order = Window.partitionBy("name", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("start") + F.coalesce(F.sum("size").over(order), F.lit(0))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start))
    return binned.join(starts, ["name", "bin"]).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + cut).cast("long").alias("taken")
    )
