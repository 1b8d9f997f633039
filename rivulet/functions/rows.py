"""Row functions: parsing, tokenizing, copying, formatting. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.operators.segments import Order, Running, running


def tokens(line: Column) -> Column:
    """Words between single blanks: inner and leading empty words stay, trailing ones go."""
    return F.split(F.rtrim(line), " ")


def tokenize(df: DataFrame, line: str, word: str = "word") -> DataFrame:
    """One ``(word, 1)`` row per token."""
    return df.select(F.explode(tokens(F.col(line))).alias(word), F.lit(1).cast("bigint").alias("count"))


def tokenize_in_order(df: DataFrame, line: str, seq: str, word: str = "word", out: str = "word_seq") -> DataFrame:
    """Tokens with their number in the whole input, lines taken in order of ``seq``.

    Only line lengths are put in order; the lines themselves are joined to their
    offsets by ``seq``.
    """
    offsets = running(
        df.select(seq, F.size(tokens(F.col(line))).cast("bigint").alias("_n")),
        [],
        Order(seq),
        [Running("_before", "sum", "_n", before=True)],
    )
    placed = df.select(seq, line).join(offsets, seq)
    return placed.select(
        seq, F.coalesce("_before", F.lit(0)).alias("_before"), F.posexplode(tokens(F.col(line))).alias("_at", word)
    ).select(seq, (F.col("_before") + F.col("_at")).alias(out), word)


def replicate(df: DataFrame, value: str, copies: dict[str, int]) -> DataFrame:
    """Each row as many times as ``copies`` says for its value; other rows not at all."""
    times = F.lit(0)
    for text, n in copies.items():
        times = F.when(F.col(value) == text, n).otherwise(times)
    return df.where(F.col(value).isin(*copies)).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times))).drop(
        "_copy"
    )


def parse_pairs(df: DataFrame, line: str, unit: str = "s") -> DataFrame:
    """``"key n"`` lines to ``(key, ts)``, ts in epoch milliseconds; ``unit`` is that of n."""
    part = F.split(F.col(line), " ")
    number = F.try_element_at(part, F.lit(2)).cast("bigint")
    return df.select(
        F.element_at(part, 1).alias("key"),
        (number * (1000 if unit == "s" else 1)).alias("ts"),
    )


def duplicated(df: DataFrame, value: str) -> DataFrame:
    """x -> (x, x)."""
    return df.select(F.col(value).alias("left"), F.col(value).alias("right"))


def squared(df: DataFrame, value: str, out: str = "square") -> DataFrame:
    return df.withColumn(out, F.col(value) * F.col(value))


def ratio(total: Column, count: Column) -> Column:
    return total.cast("double") / count


def window_message(key: Column, start: Column, end: Column, count: Column) -> Column:
    """Text of one window result: key, window and count."""
    return F.format_string(
        "key %s window %s ~ %s count %d",
        key.cast("string"),
        F.date_format(start, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(end, "yyyy-MM-dd HH:mm:ss"),
        count,
    )


def labelled(df: DataFrame, label: str) -> DataFrame:
    """The rows with the prefix a printing sink shows before them."""
    return df.withColumn("label", F.lit(label))
