"""op11: spelling variant grouping."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import spelling
from rivulet.llm.registry import query, table


def slipped(id_: int | None, word: str) -> str:
    """The word, or for one in 31 of the pairs of a document and a word, the word without one of its letters."""
    if id_ is None:
        return word
    h = crc32(f"{id_}:{word}".encode())
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


@query("op11_spelling")
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents, some of them misspelt on the way, with its form and root."""
    return spelling.grouped(table(spark, sf_dir, "documents"), change=slipped)
