"""Periodic runs of words: suffix trees of a text and of its reversal, Lyndon roots, and extension to both sides.

A run has length >= max(least, times * period). Every word of it then lies in a window of ``WINDOW`` words that occurs twice in the
run, so the trees are built only for the stretches of a text that such repeated windows cover; no run reaches beyond a stretch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rivulet.llm.common import WORD, id_and_text

SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_NONE = np.zeros((0, 3), np.int64)


@dataclass(frozen=True)
class Run:
    """What counts as a run: at least ``least`` words and ``times`` periods, with ``times`` 2 or more."""

    least: int = 6
    times: int = 4

    @property
    def window(self) -> int:
        """Words of the windows that must occur twice: a run holds window + period words at least, whatever its period."""
        smallest = min(max(self.least, self.times * q) - q for q in range(1, self.least + 1))
        return max(1, smallest)


class SuffixTree:
    """Ukkonen's suffix tree of an integer sequence that a symbol of its own ends, with an Euler tour for common prefixes."""

    def __init__(self, symbols: list[int]) -> None:
        end = max(symbols, default=0) + 1
        self.n = len(symbols)
        s, sigma = [*symbols, end], end + 1
        total = self.n + 1
        begin, stop, link, suffix = [0], [0], [0], [-1]
        child: dict[int, int] = {}  # (node, first symbol) as one number
        node = edge = length = waiting = 0
        for i, c in enumerate(s):
            made, waiting = 0, waiting + 1
            while waiting:
                if not length:
                    edge = i
                key = node * sigma + s[edge]
                at = child.get(key)
                if at is None:
                    child[key] = len(begin)
                    begin.append(i), stop.append(total), link.append(0), suffix.append(i - waiting + 1)
                    if made:
                        link[made], made = node, 0
                else:
                    size = min(stop[at], i + 1) - begin[at]
                    if length >= size:
                        edge, length, node = edge + size, length - size, at
                        continue
                    middle = begin[at] + length
                    if s[middle] == c:
                        length += 1
                        if made:
                            link[made] = node
                        break
                    split = len(begin)
                    begin.append(begin[at]), stop.append(middle), link.append(0), suffix.append(-1)
                    child[key] = split
                    child[split * sigma + c] = len(begin)
                    begin.append(i), stop.append(total), link.append(0), suffix.append(i - waiting + 1)
                    begin[at] = middle
                    child[split * sigma + s[middle]] = at
                    if made:
                        link[made] = split
                    made = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self._tour(child, sigma, np.array(stop) - np.array(begin), suffix)

    def _tour(self, child: dict[int, int], sigma: int, sizes: np.ndarray, suffix: list[int]) -> None:
        """Depths along the Euler tour, children in order of their symbols; minima over powers of two of it."""
        keys = np.fromiter(child.keys(), np.int64, len(child))
        parents = keys // sigma
        order = np.lexsort((-keys, parents))  # the largest symbol of a parent first, so that the smallest comes to lie on top
        edges = np.searchsorted(parents[order], np.arange(len(sizes) + 1)).tolist()
        kids = np.fromiter(child.values(), np.int64, len(child))[order].tolist()
        sizes = sizes.tolist()
        depth = [0] * len(sizes)
        tour: list[int] = []
        seen = [0] * (self.n + 1)
        ranked: list[int] = []
        stack = [0]
        while stack:
            node = stack.pop()
            if node < 0:
                tour.append(depth[~node])
                continue
            d = depth[node]
            if suffix[node] >= 0:
                seen[suffix[node]] = len(tour)
                ranked.append(suffix[node])
            tour.append(d)
            for kid in kids[edges[node] : edges[node + 1]]:
                depth[kid] = d + sizes[kid]
                stack.append(~node)
                stack.append(kid)
        self.order = np.array(ranked)  # suffixes in order, the empty one (just the end symbol) last
        self.seen = np.array(seen)
        table = [np.array(tour, np.int32)]
        while len(table[-1]) > 1 << (len(table) - 1):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.table = table

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at a and at b, a != b, in constant time each; n is the empty suffix."""
        x, y = self.seen[a], self.seen[b]
        x, y = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((y - x + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.table[k][x[at]], self.table[k][y[at] - (1 << int(k)) + 1])
        return out


def _next_smaller(ranks: list[int]) -> list[int]:
    out, stack = [len(ranks)] * len(ranks), []
    for i, r in enumerate(ranks):
        while stack and ranks[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def maximal_runs(symbols: list[int], run: Run = Run()) -> np.ndarray:
    """All runs of a sequence as rows (start, length, period), ordered by start, then period.

    The longest Lyndon word at a place reaches to the next smaller suffix, or to the next greater one if the order of symbols is
    turned round. Every run has such a word of just its period, so extending each as far as its period holds finds all runs.
    """
    n = len(symbols)
    if n < 2:
        return _NONE
    tree = SuffixTree(symbols)
    ranks = np.empty(n + 1, np.int64)
    ranks[tree.order] = np.arange(n + 1)
    ranks = ranks[:n]
    smaller, greater = np.array(_next_smaller(ranks.tolist())), np.array(_next_smaller((-ranks).tolist()))
    within = np.flatnonzero((smaller < n) & (smaller != greater))  # the end symbol is the largest: words that reach n would hold it
    here = np.concatenate([within, np.arange(n)])
    there = np.concatenate([smaller[within], greater])
    stop = there + tree.common(here, there)
    del tree
    back = SuffixTree(symbols[::-1])
    start = here - back.common(n - here, n - there)
    period, length = there - here, stop - start
    found = (length >= 2 * period) & (length >= np.maximum(run.least, run.times * period))
    rows = np.stack([start, period, length], 1)[found]
    return np.unique(rows, axis=0)[:, [0, 2, 1]] if len(rows) else _NONE


def _stretches(symbols: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Where windows of ``size`` symbols that occur more than once cover the sequence: (start, stop), stop exclusive.

    Windows are numbered exactly: a window of k symbols is a pair of numbered windows of k // 2 and k - k // 2.
    """
    n = len(symbols)
    if n < size + 1:
        return []

    def numbered(k: int) -> np.ndarray:
        if k == 1:
            return symbols
        head, tail = numbered(k // 2), numbered(k - k // 2)
        many = n - k + 1
        pairs = head[:many] * (int(tail.max()) + 1) + tail[k // 2 : k // 2 + many]
        return np.unique(pairs, return_inverse=True)[1]

    windows = numbered(size)
    again = np.bincount(windows)[windows] > 1
    if not again.any():
        return []
    cover = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    inside = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def runs_of(words: list[str], run: Run = Run()) -> np.ndarray:
    """All runs of a list of words, as ``maximal_runs`` gives them."""
    codes: dict[str, int] = {}
    symbols = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    found = []
    for start, stop in _stretches(symbols, run.window):
        part = np.unique(symbols[start:stop], return_inverse=True)[1]
        rows = maximal_runs(part.tolist(), run)
        found.append(rows + np.array([start, 0, 0]))
    rows = np.concatenate(found) if found else _NONE
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapsed(words: list[str], runs: np.ndarray) -> list[str]:
    """The words without those that a run contains after its first period."""
    if not len(runs):
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]


def detected(docs: DataFrame, run: Run = Run(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, its number of words, its runs (ordered by start, then period) and its words without repetitions, joined by a space.

    Null, empty and blank texts have no words, no runs and collapse to an empty text; a null id stays null; repeated rows come out as
    often as they go in; other columns, whatever their names, are left behind; an empty table gives an empty table. A text is worked
    on whole in one task: its repeated stretches take some 500 bytes a word there, one stretch at a time, the rest some 100.
    """
    pattern = re.compile(WORD)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                counts, spans, texts = [], [], []
                for text in some["text"].to_pylist():
                    words = pattern.findall(text)
                    rows = runs_of(words, run)
                    counts.append(len(words))
                    spans.append([{"start": a, "length": b, "period": c} for a, b, c in rows.tolist()])
                    texts.append(" ".join(collapsed(words, rows)))
                yield pa.RecordBatch.from_arrays(
                    [some["id"], pa.array(counts, pa.int64()), pa.array(spans, _ARROW), pa.array(texts, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(work, SCHEMA)
