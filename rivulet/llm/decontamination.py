"""Benchmark decontamination: q-gram lemma filtering in diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm.common import id_and_text

#: Bytes as they are compared: A-Z in lower case, white space as a space.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32

SCHEMA = "doc_id bigint, item_id bigint, start bigint, stop bigint, edits int"


@dataclass(frozen=True)
class Budget:
    """Items longer than ``window`` are cut into windows that overlap by half; a window may differ from the text by
    ``share`` of its length in edits. ``q`` is the length of the grams."""

    window: int = 120
    share: float = 0.06
    q: int = 12
    bits: int = 22
    block_bytes: int = 1 << 20


def folded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes in lower case with each run of white space as one space, and where each of them was."""
    low = _FOLD[data]
    space = low == 32
    kept = np.flatnonzero(~(space[1:] & space[:-1])) + 1 if len(low) else np.zeros(0, np.int64)
    kept = np.concatenate([[0], kept]) if len(low) else kept
    return low[kept], kept


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q bytes from each position on."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for at in range(0, q, 8):
        size = min(8, q - at)
        part = np.zeros(n, np.uint64)
        for i in range(size):
            part = (part << np.uint64(8)) | data[at + i : at + i + n]
        out = (out ^ part) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class Patterns:
    """The windows of one block of benchmark items and the index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], budget: Budget) -> None:
        self.budget, q = budget, budget.q
        self.items, self.texts, self.edits, self.least = [], [], [], []
        self.tiny: dict[bytes, list[int]] = {}
        hashes, owners, places = [], [], []
        for item, text in items:
            data = folded(np.frombuffer(text.encode(), np.uint8))[0].tobytes().strip(b" ")
            if len(data) < q:
                if data:
                    self.tiny.setdefault(data, []).append(item)
                continue
            last = max(0, len(data) - budget.window)
            for at in [*range(0, last, budget.window // 2), last]:
                piece = np.frombuffer(data[at : at + budget.window], np.uint8)
                m = len(piece)
                edits = min(int(m * budget.share), (m - q) // q)
                g = grams(piece, q)
                hashes.append(g)
                owners.append(np.full(len(g), len(self.items)))
                places.append(np.arange(len(g)))
                self.items.append(item)
                self.texts.append(piece)
                self.edits.append(edits)
                self.least.append(m - q + 1 - q * edits)
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        hashes = join(hashes, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners, self.places = hashes[order], join(owners, np.int64)[order], join(places, np.int64)[order]
        self.seen = np.zeros(1 << budget.bits, bool)
        self.seen[self.hashes >> np.uint64(64 - budget.bits)] = True
        self.fewest = min(self.least, default=1)
        self.reach = max((len(t) + e for t, e in zip(self.texts, self.edits)), default=0)

    def search(self, data: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, stop, edits) of every window found in the concatenated texts; positions in ``data``."""
        q = self.budget.q
        low, kept = folded(data)
        first = np.searchsorted(kept, starts)  # a text that begins with white space keeps it, unless the former ends so
        found = self._tiny(low, first) if self.tiny else []
        found = [(k, item, starts[k], starts[k + 1], 0) for k, item in found]
        g = grams(low, q)
        if not len(g) or not len(self.hashes):
            return found
        hit = self.seen[g >> np.uint64(64 - self.budget.bits)]
        total = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
        # A region has all the shared grams of its window: where too few of any kind lie, nothing can be.
        spots = np.flatnonzero(hit)
        ends = np.minimum(spots + self.reach, len(g))
        behind = np.maximum(spots - self.reach, 0)
        spots = spots[total[ends] - total[behind] >= self.fewest]
        if not len(spots):
            return found
        lo, hi = np.searchsorted(self.hashes, g[spots], "left"), np.searchsorted(self.hashes, g[spots], "right")
        many = hi - lo
        spots, lo, many = spots[many > 0], lo[many > 0], many[many > 0]
        index = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
        at = np.repeat(spots, many)
        owner, place = self.owners[index], self.places[index]
        edits, least = np.array(self.edits)[owner], np.array(self.least)[owner]
        # Bands of 2 * (edits + 1) diagonals overlap by half, so all grams of a region share one of them.
        width = edits + 1
        diagonal = at - place
        for shift in (0, 1):
            band = (diagonal + (shift * width)) // (2 * width)
            order = np.lexsort((at, band, owner))
            o, b, x = owner[order], band[order], at[order]
            need, d, wide = least[order], diagonal[order], width[order]
            # ``need`` grams within the reach of one window
            ahead = np.arange(len(o)) + need - 1
            ok = ahead < len(o)
            ahead = np.minimum(ahead, len(o) - 1)
            ok &= (o[ahead] == o) & (b[ahead] == b) & (x[ahead] - x <= self.reach)
            starts_at = np.flatnonzero(ok)
            last = (-1, -1, -1)
            for i in starts_at:
                if (o[i], b[i]) == last[:2] and d[i] - wide[i] < last[2]:
                    continue
                from_, to = int(d[i] - 2 * wide[i]), int(d[i] + 2 * wide[i])
                last = (o[i], b[i], to)
                k = int(np.searchsorted(first, x[i], "right")) - 1
                left, right = int(first[k]), int(first[k + 1])
                got = self._align(low, int(o[i]), max(from_, left), to, left, right)
                if got:
                    start, stop, cost = got
                    found.append((k, self.items[o[i]], int(kept[start]), int(kept[stop - 1]) + 1, cost))
        return found

    def _tiny(self, low: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
        """Items shorter than a gram only match a text that says nothing else."""
        short = np.flatnonzero(first[1:] - first[:-1] <= self.budget.q + 2)
        texts = ((int(k), low[first[k] : first[k + 1]].tobytes().strip(b" ")) for k in short)
        return [(k, item) for k, t in texts for item in self.tiny.get(t, ())]

    def _align(self, low: np.ndarray, owner: int, from_: int, to: int, left: int, right: int) -> tuple[int, int, int] | None:
        """The best place of the window that begins in [from_, to], if it costs no more edits than allowed.

        One row of the table per byte of the window; a row holds the diagonals of the band only.
        """
        piece, most = self.texts[owner], self.edits[owner]
        m = len(piece)
        text = low[from_ : min(right, to + m + most)]
        hay, needle = text.tobytes(), piece.tobytes()
        if (at := hay.find(needle)) >= 0:
            return from_ + at, from_ + at + m, 0
        if not most:
            return None
        width = to - from_ + 2 * most + 1  # cell j of row i stands for text position i + j - most
        far = np.int32(1 << 20)
        cell = np.arange(width)
        cost, begin = np.where(cell - most >= 0, 0, far).astype(np.int32), (cell - most).astype(np.int64)
        padded = np.zeros(m + width + most + 1, np.uint8)
        padded[most : most + len(text)] = text[: m + width + 1]
        inside = np.zeros(len(padded), bool)
        inside[most : most + len(text)] = True
        for i in range(m):
            here = slice(i, i + width)
            same = (padded[here] == piece[i]) & inside[here]
            take = cost + np.where(same, 0, 1)  # a byte of the text for one of the window
            take[~inside[here]] = far
            skip = np.concatenate([cost[1:], [far]]) + 1  # the window has one byte more
            other = np.concatenate([begin[1:], [0]])
            begin = np.where(skip < take, other, begin)
            cost = np.minimum(take, skip)
            # the text has bytes more: from the left within the row, one edit each
            ramp = cost - cell
            best = np.minimum.accumulate(ramp)
            source = np.maximum.accumulate(np.where(ramp == best, cell, 0))
            cost, begin = (best + cell).astype(np.int32), begin[source]
        j = int(np.argmin(cost))
        if cost[j] > most:
            return None
        start, stop = from_ + max(0, int(begin[j])), from_ + m + j - most
        return (start, min(stop, right), int(cost[j])) if stop > start else None


def _searched(texts: list[bytes], patterns: Patterns) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray]:
    """What the texts hold, and where each begins: a zero byte parts them, so that nothing runs from one into the next."""
    starts = np.concatenate([[0], np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))]).astype(np.int64)
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    return patterns.search(data, starts), starts


def _in_blocks(column: pa.Array, most: int) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a column in lists of about ``most`` bytes, each with the row that it begins at."""
    at, texts, size = 0, [], 0
    for i, text in enumerate(column):
        texts.append(text.as_py().encode())
        size += len(texts[-1])
        if size >= most:
            yield at, texts
            at, texts, size = i + 1, [], 0
    if texts:
        yield at, texts


def _matches(batches: Iterator[pa.RecordBatch], items: list[tuple[int, str]], budget: Budget) -> Iterator[pa.RecordBatch]:
    patterns = Patterns(items, budget)
    names, kinds = ["doc_id", "item_id", "start", "stop", "edits"], [pa.int64()] * 4 + [pa.int32()]
    for batch in batches:
        rows = []
        for at, texts in _in_blocks(batch.column(1), budget.block_bytes):
            found, starts = _searched(texts, patterns)
            for k, item, a, b, cost in found:
                text, base = texts[k], int(starts[k])
                point = lambda p: len(text[: p - base].decode(errors="ignore"))
                rows.append((batch.column(0)[at + k].as_py(), item, point(a), point(min(b, base + len(text))), cost))
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _untouched(text: Column, items: Broadcast, budget: Budget) -> Column:
    """Whether the text holds none of the items. Only texts go to Python and only marks come back: the rows stay in Spark."""

    def marks(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        patterns = Patterns(items.value, budget)
        for column in columns:
            clean = np.ones(len(column), bool)
            for at, texts in _in_blocks(column, budget.block_bytes):
                clean[[at + f[0] for f in _searched(texts, patterns)[0]]] = False
            yield pa.array(clean)

    return F.arrow_udf(marks, "boolean")(text)


def _passes(benchmark: DataFrame, item_col: str, text_col: str, most_items: int, most_bytes: int) -> list[list[tuple[int, str]]]:
    """The items in lists of bounded size."""
    items = id_and_text(benchmark, item_col, text_col).where(F.length("text") > 0).distinct()
    passes: list[list[tuple[int, str]]] = []
    size = most_bytes
    for row in items.orderBy("id", "text").toLocalIterator():
        if size >= most_bytes or len(passes[-1]) >= most_items:
            passes.append([])
            size = 0
        passes[-1].append((row.id, row.text))
        size += len(row.text)
    return passes


def clean(
    docs: DataFrame, benchmark: DataFrame, budget: Budget = Budget(), text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", items_per_pass: int = 50_000, pass_bytes: int = 16 << 20,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text repeats no passage of the benchmark (see ``contamination``)."""
    for some in _passes(benchmark, item_col, item_text_col, items_per_pass, pass_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(some)
        docs = docs.where(_untouched(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), sent, budget))
    return docs


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    budget: Budget = Budget(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    items_per_pass: int = 50_000,
    pass_bytes: int = 16 << 20,
) -> DataFrame:
    """Where the texts repeat passages of the benchmark.

    Texts and items are compared in lower case (A-Z) with runs of white space as one space. An item, or each window of a
    long one, shares at least m - q + 1 - q * edits of its m - q + 1 q-grams with any text within the edit budget, and
    these lie on at most edits + 1 neighbouring diagonals. A text is first left out where too few of its q-grams occur in
    any item; then grams are counted per window in bands of diagonals that overlap by half; what reaches the bound is
    aligned in the band. Lengths and edits are those of UTF-8 bytes, positions in the result code points.

    The items are sent to the tasks in passes of bounded size (``items_per_pass``, ``pass_bytes``); a larger benchmark takes more passes over
    the documents.

    Returns ``doc_id, item_id, start, stop, edits``: one row for each document, item and place, of overlapping places of
    an item their union with the fewest edits. Null and empty texts or items match nothing. An item shorter than q bytes matches only a text that
    consists of it. Repeated rows of ``docs`` give the rows of one. Extra columns play no part.
    """
    spark = docs.sparkSession
    left = id_and_text(docs, id_col, text_col)
    found = None
    for some in _passes(benchmark, item_col, item_text_col, items_per_pass, pass_bytes):
        sent = spark.sparkContext.broadcast(some)
        part = left.mapInArrow(lambda batches, sent=sent: _matches(batches, sent.value, budget), SCHEMA)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], SCHEMA)
    return _merged(found)


def _merged(found: DataFrame) -> DataFrame:
    """Overlapping places of one item in one document become one."""
    order = Window.partitionBy("doc_id", "item_id").orderBy("start", "stop", "edits")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        found.withColumn("new", (F.coalesce(F.col("start") > reach, F.lit(True))).cast("int"))
        .withColumn("place", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "item_id", "place")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("edits").alias("edits"))
        .select("doc_id", "item_id", "start", "stop", "edits")
    )
