"""Suffix-array dedup: a radix sort of suffixes that stops at the threshold."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from rivulet.llm.blocks import Block, Deal, answered, asked, mix, packed, with_answers
from rivulet.llm.common import partitions

SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
_NONE = np.zeros(0, np.int64)
_PIECE, _TIMES = 1 << 15, np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Depth:
    """``window``: the threshold in bytes. ``digit``: bytes of the first digit."""

    window: int = 50
    digit: int = 24
    block_bytes: int = 6 << 20


class Suffixes:
    """The windows of a block, dealt to heads.

    A window's head is the place of the least hashed digit (``digit`` bytes) in it. Equal windows have their heads at the
    same distance, so suffixes need only be compared from heads on, and one head serves about a dozen windows. Digits are
    hashed and compared in pieces of the block that stay in a core's cache; only heads are kept.
    """

    def __init__(self, block: Block, depth: Depth) -> None:
        self.depth, size = depth, depth.window
        self.digits = Digits(block.data, depth.digit)
        low, head, first = self._heads(len(block.data))
        long = np.flatnonzero(np.diff(block.starts) >= size)
        begin, last = block.starts[long], block.starts[long + 1] - size
        cuts = np.sort(np.concatenate([low, begin]))
        cuts = cuts[np.diff(cuts, prepend=-1) > 0]
        of = np.searchsorted(begin, cuts, "right") - 1
        fine = of >= 0
        fine[fine] = cuts[fine] <= last[of[fine]]
        until = np.append(cuts, len(block.data))[1:] - 1
        self.low, of = cuts[fine], of[fine]
        run = np.searchsorted(low, self.low, "right") - 1
        self.head, self.first = head[run], first[run]
        self.high = np.minimum(until[fine], last[of])
        self.doc = long[of]
        self.id = block.ids[self.doc]

    def _heads(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where a new head begins to serve, as if the block were one text, the head, and its digit's hash."""
        span = self.depth.window - self.depth.digit + 1
        place = np.uint64((1 << (_PIECE + span).bit_length()) - 1)
        before, out = -1, [(_NONE, _NONE, np.zeros(0, np.uint64))]
        for a in range(0, length - self.depth.window + 1, _PIECE):
            g = self.digits.between(a, min(a + _PIECE + span - 1, length - self.depth.digit + 1))
            key, cover = (g & ~place) | np.arange(len(g), dtype=np.uint64), 1
            while cover < span:
                step = min(cover, span - cover)
                key = np.minimum(key[:-step], key[step:])
                cover += step
            head = (key & place).astype(np.int64)
            new = np.flatnonzero(np.diff(head, prepend=before - a))
            before = int(head[-1]) + a
            out.append((new + a, head[new] + a, g[head[new]]))
        low, head, first = (np.concatenate(c) for c in zip(*out))
        return low, head, first

    # First digit: is it in another block, or in two documents of this one?

    def ask_first(self, buckets: int) -> tuple[np.ndarray, np.ndarray, Deal]:
        inverse, digits = pd.factorize(self.first)
        return digits, inverse, Deal(digits, buckets)

    def shared(self, got: dict[int, bytes], buckets: int) -> np.ndarray:
        digits, inverse, deal = self.ask_first(buckets)
        elsewhere = deal.gathered(got, np.uint8) > 0
        low, high = _extremes(inverse, self.id, len(digits))
        return np.flatnonzero((elsewhere | (low != high))[inverse])

    # Further digits up to the threshold on both sides of the head: all windows of a head at once.

    def ask_rest(self, some: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Deal]:
        low, stop = self.low[some], self.high[some] + self.depth.window
        rest = mix(self.digits.stretches(low, stop, 2 * self.depth.window) + (self.head[some] - low).astype(np.uint64))
        inverse, rest = pd.factorize(rest)
        first = np.empty(len(rest), np.uint64)
        first[inverse] = self.first[some]
        return first, rest, inverse, _extremes(inverse, self.id[some], len(rest))[0], Deal(first, buckets)

    def open(self, some: np.ndarray, got: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Heads all of whose windows are in a smaller document, and heads whose windows must be looked at one by one."""
        _, _, inverse, least, deal = self.ask_rest(some, buckets)
        bits = deal.gathered(got, np.uint8)[inverse]
        done = (self.id[some] > least[inverse]) | ((bits & 1) > 0)
        return some[done], some[~done & ((bits & 2) > 0)]

    def windows(self, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every window of the heads: where it begins, and its document's id."""
        many = self.high[heads] - self.low[heads] + 1
        before = np.cumsum(many) - many
        at = np.arange(many.sum()) - np.repeat(before, many) + np.repeat(self.low[heads], many)
        return at, np.repeat(self.id[heads], many)

    def ask_windows(self, at: np.ndarray, ids: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Deal]:
        inverse, digests = pd.factorize(self.digits.stretches(at, at + self.depth.window, self.depth.window))
        return digests, inverse, _extremes(inverse, ids, len(digests))[0], Deal(digests, buckets)


class Digits:
    """Hashes of the digits of a block's bytes, and of longer stretches as those of the digits that cover them."""

    def __init__(self, data: np.ndarray, size: int) -> None:
        self.size = size
        self.eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
        self.steps = [min(k, max(size - 8, 0)) for k in range(0, size, 8)]
        self.mask = np.uint64((1 << 8 * size) - 1) if size < 8 else None

    def _hashed(self, eights: Iterator[np.ndarray], many: int) -> np.ndarray:
        """``mix`` after every eight bytes, in place."""
        out = np.zeros(many, np.uint64)
        for eight in eights:
            out ^= eight if self.mask is None else eight & self.mask
            out ^= out >> np.uint64(32)
            out *= _TIMES
            out ^= out >> np.uint64(32)
            out *= _TIMES
        out ^= out >> np.uint64(32)
        return out

    def between(self, start: int, stop: int) -> np.ndarray:
        """The digits that begin in that range."""
        return self._hashed((self.eight[start + k : stop + k] for k in self.steps), stop - start)

    def stretches(self, start: np.ndarray, stop: np.ndarray, most: int) -> np.ndarray:
        """Stretches of at least a digit and at most ``most`` bytes."""
        out = np.empty(len(start), np.uint64)
        for a in range(0, len(start), _PIECE):
            at, size = start[a : a + _PIECE], stop[a : a + _PIECE] - start[a : a + _PIECE]
            h = size.astype(np.uint64)
            for k in range(0, most, self.size):
                place = at + np.minimum(k, size - self.size)
                h = mix(h * _TIMES ^ self._hashed((self.eight[place + j] for j in self.steps), len(place)))
            out[a : a + _PIECE] = h
        return out


def _extremes(group: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.full(size, np.iinfo(np.int64).max)
    high = np.full(size, np.iinfo(np.int64).min)
    np.minimum.at(low, group, values)
    np.maximum.at(high, group, values)
    return low, high


def _in_two_blocks(digits: np.ndarray, _: np.ndarray) -> np.ndarray:
    """1 for a digit that more than one block asked about; a block asks once."""
    code, _ = pd.factorize(digits)
    return (np.bincount(code)[code] > 1).astype(np.uint8)


def _rest(first: np.ndarray, rest: np.ndarray, ids: np.ndarray, _: np.ndarray) -> np.ndarray:
    """Bit 1: the same in a smaller document. Bit 2: the same first digit goes on in another way elsewhere."""
    order = np.lexsort((ids, rest, first))
    f, r, d = first[order], rest[order], ids[order]
    key = np.concatenate([[True], f[1:] != f[:-1]])
    kind = key | np.concatenate([[True], r[1:] != r[:-1]])
    of_key, of_kind = np.cumsum(key) - 1, np.cumsum(kind) - 1
    smaller = d > d[kind][of_kind]
    several = np.bincount(of_key[kind])[of_key] > 1
    out = np.empty(len(first), np.uint8)
    out[order] = smaller + 2 * several
    return out


def _smaller(digests: np.ndarray, ids: np.ndarray, _: np.ndarray) -> np.ndarray:
    """1 where a smaller document has the window."""
    inverse, unique = pd.factorize(digests)
    return (ids > _extremes(inverse, ids, len(unique))[0][inverse]).astype(np.uint8)


def _result(block: Block, s: Suffixes, heads: np.ndarray, starts: np.ndarray) -> pa.Table:
    """Removes the bytes that all windows of the heads and the windows at ``starts`` cover."""
    size, n = s.depth.window, len(block.data)
    start, stop = np.concatenate([s.low[heads], starts]), np.concatenate([s.high[heads], starts]) + size
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    doc = np.searchsorted(block.starts, start, "right") - 1
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] > stop[:-1]) | (doc[1:] != doc[:-1])
    i = np.flatnonzero(new)
    start, stop, doc = start[i], stop[np.append(i[1:], len(stop))[: len(i)] - 1], doc[i]
    edge = np.zeros(n + 1, np.int8)
    edge[start] += 1
    edge[stop] -= 1
    stays = np.cumsum(edge[:n], dtype=np.int8) == 0
    runs = np.bincount(doc, minlength=len(block.ids))
    removed = np.zeros(len(block.ids), np.int64)
    np.add.at(removed, doc, stop - start)
    rows = []
    for k in range(len(block.ids)):
        a, b = block.starts[k], block.starts[k + 1]
        kept = block.data[a:b] if not runs[k] else block.data[a:b][stays[a:b]]
        rows.append((int(block.ids[k]) if block.known[k] else None, int(b - a), int(removed[k]), int(runs[k]), hashlib.sha256(kept.tobytes()).hexdigest()))
    kinds = [pa.int64()] * 4 + [pa.string()]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, zip(*rows), kinds)})


def deduplicated(docs: DataFrame, depth: Depth = Depth(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Removes each byte covered by a window of ``depth.window`` bytes that also starts in a document with a smaller id.

    Suffixes are sorted from the most significant digit on, and only as far as needed:

    1. the first digit (24 bytes at the head of a window, see ``Suffixes``): a digit in one document only is done;
    2. the bytes on both sides of the head, up to the threshold, for all windows of a head at once: equal ones are repeats of the smallest
       document that has them; those whose first digit never goes on in another way are done;
    3. single windows, for one document of each group that is left.

    Groups are formed by 64-bit digests of the bytes and the bucket they fall into, not by the bytes.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per row of ``docs``. Null text: empty. A null id
    is greater than all others. Rows with equal ids are one document: none of them is smaller than the other. Empty
    table: no rows. Extra columns play no part.
    """
    buckets = partitions(docs)
    blocks = packed(docs, depth.block_bytes, id_col, text_col)

    def ask_first(block: Block, got: dict) -> Iterator[tuple[int, bytes]]:
        digits, _, deal = Suffixes(block, depth).ask_first(buckets)
        return deal.shares(digits)

    def ask_rest(block: Block, got: dict) -> Iterator[tuple[int, bytes]]:
        s = Suffixes(block, depth)
        first, rest, _, least, deal = s.ask_rest(s.shared(got.get(1, {}), buckets), buckets)
        return deal.shares(first, rest, least)

    def ask_windows(block: Block, got: dict) -> Iterator[tuple[int, bytes]]:
        s = Suffixes(block, depth)
        _, heads = s.open(s.shared(got.get(1, {}), buckets), got.get(2, {}), buckets)
        digests, _, least, deal = s.ask_windows(*s.windows(heads), buckets)
        return deal.shares(digests, least)

    def result(block: Block, got: dict) -> pa.Table:
        s = Suffixes(block, depth)
        done, heads = s.open(s.shared(got.get(1, {}), buckets), got.get(2, {}), buckets)
        at, ids = s.windows(heads)
        _, inverse, least, deal = s.ask_windows(at, ids, buckets)
        elsewhere = deal.gathered(got.get(3, {}), np.uint8) > 0
        gone = at[(ids > least[inverse]) | elsewhere[inverse]] if len(at) else at
        return _result(block, s, done, gone)

    one, _ = answered(asked(blocks, ask_first), [np.uint64], _in_two_blocks, 1)
    two, _ = answered(asked(blocks, ask_rest, one), [np.uint64, np.uint64, np.int64], _rest, 2)
    three, _ = answered(asked(blocks, ask_windows, one.unionByName(two)), [np.uint64, np.int64], _smaller, 3)
    return with_answers(blocks, result, SCHEMA, one.unionByName(two).unionByName(three))
