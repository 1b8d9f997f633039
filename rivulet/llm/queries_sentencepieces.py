"""op12: SentencePiece encoding and decoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rivulet.llm import sentencepieces
from rivulet.llm.registry import query, table


@query("op12_sentencepiece")
def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, and the digest of the text that they decode to."""
    coded = sentencepieces.coded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
