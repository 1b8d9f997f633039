"""Spelling variant grouping over a bit-sliced position index.

The vocabulary is cut into blocks so that words one edit apart meet: of two such words, the longer of M letters, the first or the last
(M - 1) // 2 letters are the same. A block's index has a bitset over its words for each (position, letter); a word is looked up
letter by letter, all words of the block at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm.common import id_and_text, partitions, stored

LETTERS = r"A-Za-zÀ-ÿ"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
Change = Callable[[int | None, str], str]


@dataclass(frozen=True)
class Spelling:
    """Words have at least ``letters`` letters and ``count`` occurrences; a form has ``times`` the occurrences of its variant.

    ``block`` bounds the words of an index and of the queries put to it; larger blocks become all pairs of such parts.
    """

    letters: int = 7
    count: int = 2
    times: int = 10
    block: int = 8192


class Index:
    """Bitsets over words: per (position, letter) those that have it there, per length those that have it."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.all = (1 << len(words)) - 1
        self.at: dict[tuple[int, str], int] = {}
        self.length: dict[int, int] = {}
        at, bit = self.at, 1
        for word in words:
            self.length[len(word)] = self.length.get(len(word), 0) | bit
            for slot in enumerate(word):
                at[slot] = at.get(slot, 0) | bit
            bit <<= 1

    def near(self, word: str) -> int:
        """The words that differ from ``word`` by exactly one inserted, deleted or replaced letter.

        ``same`` has no error so far; the others have one, and stand where the word stands, one letter on or one letter back.
        """
        at = self.at.get
        same, replaced, longer, shorter = self.all, 0, 0, 0
        for i, letter in enumerate(word):
            here = at((i, letter), 0)
            replaced = (replaced & here) | (same & ~here)
            longer = (longer | same) & at((i + 1, letter), 0)
            shorter = (shorter & at((i - 1, letter), 0)) | same
            same &= here
        size, length = len(word), self.length.get
        return (
            replaced & length(size, 0)
            | (longer | same) & length(size + 1, 0)
            | shorter & length(size - 1, 0)
        )

    def picked(self, bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield low.bit_length() - 1
            bits ^= low


def vocabulary(docs: DataFrame, spelling: Spelling = Spelling(), change: Change | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words (lower case A-Z, runs of ``LETTERS``) and how often they occur, ``n``, in all texts.

    ``change`` maps (id, word) to what is counted instead. Counts are added up per task first, at most 200,000 words at a time.
    """
    pattern = re.compile(f"[{LETTERS}]{{{spelling.letters},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], ["word", "n"])
            totals.clear()
            return out

        for batch in batches:
            for id_, text in zip(batch["id"].to_pylist(), batch["text"]):
                low = text.as_buffer().to_pybytes().translate(_LOWER).decode()
                for word in pattern.findall(low):
                    if change is not None:
                        word = change(id_, word)
                    if len(word) >= spelling.letters:
                        totals[word] = totals.get(word, 0) + 1
                if len(totals) > 200_000:
                    yield flushed()
        yield flushed()

    words = id_and_text(docs, id_col, text_col).mapInArrow(count, "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= spelling.count)


def _blocks(words: DataFrame, spelling: Spelling) -> DataFrame:
    """(block, side, longest, index, asks, word, n): every word with its blocks; ``index`` and ``asks`` say what it does in each."""
    size = F.length("word")
    keys = []
    for more in (0, 1):  # the word is the longer one, or the other has a letter more
        half = F.floor((size + (more - 1)) / 2).cast("int")
        for side, part in (("first", F.substring("word", F.lit(1), half)), ("last", F.substring("word", size - half + 1, half))):
            keys.append(F.struct((size + more).alias("longest"), F.lit(side).alias("side"), part.alias("part")))
    placed = words.select("word", "n", F.explode(F.array(*keys)).alias("key")).select("word", "n", "key.*")
    key = ["longest", "side", "part"]
    large = placed.groupBy(*key).agg(F.ceil(F.count("*") / spelling.block).cast("int").alias("parts")).where("parts > 1")
    whole = placed.join(stored(large, "large-blocks"), key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    # Part i of a block is the index and part j asks; a part meets itself once, in both roles.
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    roles = F.concat(
        F.transform(every, lambda j: F.struct(own.alias("i"), j.alias("j"), F.lit(True).alias("index"), (own == j).alias("asks"))),
        F.transform(F.filter(every, lambda i: i != own), lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(False).alias("index"), F.lit(True).alias("asks"))),
    )
    return whole.select("word", "n", *key, F.explode(roles).alias("role")).select("word", "n", *key, "role.*")


def neighbours(words: DataFrame, spelling: Spelling = Spelling()) -> DataFrame:
    """Of every word that has near words: ``n_near``, and the near word of largest n (``near``, the smallest of ties) with ``near_n``."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                ["word", "n_near", "minus_n", "near"],
            )
            out.clear()
            return made

        for (longest, side, *_), group in groupby(rows(), key=lambda r: r[:5]):
            known, asking = [], []
            for *_, index, asks, word, n in group:
                if index:
                    known.append((word, n))
                if asks:
                    asking.append(word)
            if len(known) + len(asking) < 3 and (not known or not asking or known[0][0] == asking[0]):
                continue
            index = Index([w for w, _ in known])
            half = (longest - 1) // 2
            for word in asking:
                bits = index.near(word)
                if not bits:
                    continue
                found = [known[k] for k in index.picked(bits)]
                # A pair belongs to the blocks of its longer word, and to the first side if that has it.
                found = [(-n, w) for w, n in found if max(len(w), len(word)) == longest and (side == "first" or w[:half] != word[:half])]
                if found:
                    out.append((word, len(found), *min(found)))
            if len(out) > 10_000:
                yield flushed()
        yield flushed()

    blocks = _blocks(words, spelling).select("longest", "side", "part", "i", "j", "index", "asks", "word", "n")
    dealt = blocks.repartition(partitions(words), "longest", "side", "part", "i", "j").sortWithinPartitions("longest", "side", "part", "i", "j")
    met = dealt.mapInArrow(look_up, "word string, n_near bigint, minus_n bigint, near string")
    best = F.min(F.struct("minus_n", "near")).alias("best")
    merged = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus_n")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the ends of their chains, by doubling.

    Each form is more frequent by a factor, so chains are short and cannot close; a round ends the work if no root moved in it.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        moved = roots.join(up, "root", "left").select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved"))
        moved = stored(moved, "roots")
        roots = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return roots


def grouped(docs: DataFrame, spelling: Spelling = Spelling(), change: Change | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every word of the vocabulary with its number of near words, its form and its root.

    A word's form is its near word of largest n (ties: smallest in code-point order) if that has ``times`` its n, else null; its root is
    the end of the chain of forms, the word itself if it has none. Null and empty texts have no words, repeated rows count as often as
    they occur, a null id only reaches ``change`` as None, other columns are left behind, and an empty table or vocabulary gives an
    empty table. Texts of any length and words of any length are taken whole.
    """
    words = stored(vocabulary(docs, spelling, change, id_col, text_col), "vocabulary")
    near = neighbours(words, spelling)
    form = F.when(F.col("near_n") >= F.col("n") * spelling.times, F.struct(F.col("near").alias("form"), F.col("near_n").alias("form_n")))
    formed = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("f"))
    formed = stored(formed.select("word", "n", "n_near", "f.*"), "forms")
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
