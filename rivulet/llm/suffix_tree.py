"""LM scoring with a probabilistic suffix tree over words."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm.blocks import Block, Deal, answered, asked, mix, packed, with_answers
from rivulet.llm.common import held_out, partitions
from rivulet.llm.words import Words

SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
_END, _BEGIN = mix(np.array([3, 5], np.uint64))
_THEN = np.uint64(0xC2B2AE3D27D4EB4F)
_KEY, _LOW = 5, np.uint64((1 << 40) - 1)
#: Columns of a payload, all of them bytes: of a key, of what a word's digest has besides, of a count, of a gain.
WORDS, GRAMS, GAINS = ([np.uint8] * (_KEY + n) for n in (3 + 8, 4, 3))
#: Contexts of one more word are named by greater numbers.
_LEVEL = np.uint64(1 << 36)


@dataclass(frozen=True)
class Tree:
    """Contexts of one, two, .. words need ``least[0]``, ``least[1]``, .. occurrences in training, at any size of the corpus; the number of
    entries is the depth. They stay if they gain more than ``gain`` nats, each training token left out in turn. ``weight``: how
    many observations the shorter context counts for."""

    least: tuple[int, ...] = (20, 4)
    weight: float = 4.0
    gain: float = 3.0
    folds: int = 5
    fold: int = 1
    block_bytes: int = 12 << 20


@dataclass(frozen=True)
class Totals:
    """Tokens and distinct tokens of the training texts, and how many of those texts there are."""

    tokens: int
    distinct: int
    texts: int


@dataclass(frozen=True)
class Level:
    """The tokens of a block that have a frequent context of some length: their places, the number of each one's context, the contexts'
    digests and training counts, and the distinct grams (context and token) with where each place's is among them."""

    at: np.ndarray
    context: np.ndarray
    names: np.ndarray
    seen: np.ndarray
    grams: np.ndarray
    inverse: np.ndarray


def _bytes(numbers: np.ndarray, most: int) -> list[np.ndarray]:
    """The lower bytes of the numbers, a column each."""
    parts = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.dtype.itemsize)
    return [parts[:, i] for i in range(most)]


def _number(parts: tuple[np.ndarray, ...]) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for i, part in enumerate(parts):
        out |= part.astype(np.uint64) << np.uint64(8 * i)
    return out


def _in_order(digests: np.ndarray, buckets: int) -> np.ndarray:
    """The order by bucket, then by the lower 40 bits, which tell digests of a bucket apart; those of words need all bits."""
    order = np.argsort(digests << np.uint64(24) | digests >> np.uint64(40))
    return order[np.argsort(Deal(digests[order], buckets).bucket.astype(np.min_scalar_type(buckets)), kind="stable")]


def _distinct(digests: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct digests in that order, and where each digest is among them."""
    code, unique = pd.factorize(digests)
    order = _in_order(unique, buckets)
    place = np.empty(len(unique), np.int64)
    place[order] = np.arange(len(unique))
    return unique[order], place[code]


def _keys(deal: Deal, low: np.ndarray) -> list[np.ndarray]:
    """Numbers of 40 bits as steps from the one before in its bucket; they ascend there."""
    steps = np.diff(low, prepend=np.uint64(0))
    first = deal.cuts[:-1][np.diff(deal.cuts) > 0]
    steps[first] = low[first]
    return _bytes(steps, _KEY)


def _told(parts: tuple[np.ndarray, ...], asker: np.ndarray) -> np.ndarray:
    """The numbers again; each asker's steps begin anew."""
    return _summed(_number(parts), np.flatnonzero(np.diff(asker, prepend=-1)))


def _summed(steps: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the steps up to each, which begin anew at ``first``."""
    sums = np.cumsum(steps)
    return sums - np.repeat((sums - steps)[first], np.diff(first, append=len(steps)))


def _ranks(keys: np.ndarray, fine: np.ndarray, code: np.ndarray, asker: np.ndarray) -> np.ndarray:
    """Numbers the distinct keys that are ``fine`` from 1, in order; for each key asked about (``code``), the step from the asker's last one
    to it, or 0."""
    some = np.flatnonzero(fine)
    rank = np.zeros(len(keys), np.int64)
    rank[some[np.argsort(keys[some])]] = np.arange(1, len(some) + 1)
    at = np.flatnonzero(rank[code])
    mine, out = rank[code[at]], np.zeros(len(code), np.int64)
    out[at] = np.where(np.diff(asker[at], prepend=-1) != 0, mine, np.diff(mine, prepend=0))
    return out


class Tokens:
    """The tokens of a block: words, and an end after each text."""

    def __init__(self, block: Block, tree: Tree, buckets: int, totals: Totals | None, got: dict) -> None:
        self.block, self.tree, self.buckets, self.totals, self.got = block, tree, buckets, totals, got
        self.levels: list[Level] = []
        self.counted: dict[int, np.ndarray] = {}
        words = Words(block)
        self.texts = len(words.counts)
        self.unique, uid = _distinct(words.hash, buckets)
        self.known_words = len(self.unique)
        at = np.arange(len(uid)) + words.doc
        self.lens = words.counts + 1
        self.firsts = np.concatenate([[0], np.cumsum(self.lens)[:-1]]).astype(np.int64)
        self.token = np.full(len(uid) + self.texts, self.known_words)
        self.token[at] = uid
        self.doc = np.repeat(np.arange(self.texts), self.lens)
        crc = [zlib.crc32(str(i).encode()) % tree.folds == tree.fold if k else False for i, k in zip(block.ids.tolist(), block.known)]
        self.held_out = np.array(crc, bool)
        self.trains = ~self.held_out[self.doc]
        self.before = np.concatenate([[0], self.token[:-1]]).astype(np.int64)
        self.before[self.firsts] = self.known_words + 1
        self.digest = np.concatenate([self.unique, [_END, _BEGIN]])

    # Words

    def ask_words(self) -> Iterator[tuple[int, bytes]]:
        n = np.bincount(self.token[self.trains], minlength=self.known_words)[: self.known_words]
        deal = Deal(self.unique, self.buckets)
        return deal.shares(*_keys(deal, self.unique & _LOW), *_bytes(self.unique >> np.uint64(40), 3), *_bytes(n.astype(np.int64), 8))

    @cached_property
    def seen(self) -> np.ndarray:
        """Training count of each distinct word, then of the end and the beginning."""
        n = Deal(self.unique, self.buckets).gathered(self.got.get(1, {}), np.int64, planes=True)
        return np.concatenate([n, [self.totals.texts] * 2])

    @cached_property
    def root(self) -> np.ndarray:
        """P(token), the same for all tokens that training has not seen."""
        t = self.totals
        return (self.seen[self.token] + 0.5) / (t.tokens + 0.5 * (t.distinct + 1))

    # Contexts

    def level(self, words: int) -> Level:
        """Contexts of that many words. Each level stands on the counts of the one below: a gram is the next token's context."""
        while len(self.levels) < words:
            n = len(self.levels)
            if n:
                below, names, seen = self.levels[-1], self.levels[-1].grams, self.gram_counts(n)
                follows = ~np.isin(below.at + 1, np.append(self.firsts, len(self.token)), assume_unique=True)
                at, context = below.at[follows] + 1, below.inverse[follows]
            else:
                at, context, names, seen = np.arange(len(self.token)), self.before, self.digest, self.seen
            fine = seen[context] >= max(2, self.tree.least[n])
            at, context = at[fine], context[fine]
            grams = _distinct(mix(names[context] * _THEN + self.digest[self.token[at]]), self.buckets)
            self.levels.append(Level(at, context, names, seen[context], *grams))
        return self.levels[words - 1]

    def gram_counts(self, words: int) -> np.ndarray:
        """How often training has each gram of the level."""
        if words not in self.counted:
            deal = Deal(self.level(words).grams, self.buckets)
            self.counted[words] = deal.gathered(self.got.get(words + 1, {}), np.int64, planes=True)
        return self.counted[words]

    def ask_grams(self, words: int) -> Iterator[tuple[int, bytes]]:
        level = self.level(words)
        n = np.bincount(level.inverse, self.trains[level.at], len(level.grams)).astype(np.uint32)
        deal = Deal(level.grams, self.buckets)
        return deal.shares(*_keys(deal, level.grams & _LOW), *_bytes(n, 4))

    def smoothed(self, less: int) -> Iterator[tuple[Level, np.ndarray, np.ndarray]]:
        """For each level from the shortest contexts: P(token | context) and P(token | shorter context) at its places, with
        ``less`` occurrences of each token left out."""
        m, below = self.tree.weight, self.root.copy()
        for words in range(1, len(self.tree.least) + 1):
            level = self.level(words)
            parent = below[level.at]
            longer = (self.gram_counts(words)[level.inverse] - less + m * parent) / (level.seen - less + m)
            below[level.at] = longer
            yield level, longer, parent

    # Divergence tests

    @cached_property
    def tested(self) -> tuple[Deal, list[np.ndarray], list[np.ndarray]]:
        """The contexts of the block by bucket, then length, then digest, but the beginning before all others: how they are dealt, for each length
        where its names are among them (-1 if it does not occur), and where its places' contexts are."""
        names, used, size = [self.digest[:0]], [], 0
        for n in range(len(self.tree.least)):
            level = self.level(n + 1)
            some = np.flatnonzero(np.bincount(level.context, minlength=len(level.names)))
            if not n:
                some = np.concatenate([some[some > self.known_words], some[some <= self.known_words]])
            used.append(some)
            names.append(level.names[some])
            size += len(some)
        names = np.concatenate(names)
        order = Deal(names, self.buckets).order
        place = np.empty(size, np.int64)
        place[order] = np.arange(size)
        where = []
        for n, some in enumerate(used):
            of = np.full(len(self.level(n + 1).names), -1)
            of[some], place = place[: len(some)], place[len(some) :]
            where.append(of)
        return Deal(names[order], self.buckets), where, [of[self.level(n + 1).context] for n, of in enumerate(where)]

    def names(self) -> np.ndarray:
        """The numbers of these contexts in their buckets; the beginning has 0."""
        deal, where, _ = self.tested
        out = np.zeros(len(deal.order), np.uint64)
        for n, of in enumerate(where):
            asked = Deal(self.level(n).grams if n else self.unique, self.buckets)
            ranks = asked.gathered(self.got.get(-n - 1, {}), np.uint64, planes=True)
            ranks = _summed(ranks, asked.cuts[:-1][np.diff(asked.cuts) > 0])
            some = np.flatnonzero(of[: len(ranks)] >= 0)
            out[of[some]] = ranks[some] + np.uint64(n) * _LEVEL
        return out

    def ask_gains(self) -> Iterator[tuple[int, bytes]]:
        """What each context's next-symbol distribution gains over the shorter context's, on this block's training tokens, as the
        upper 24 bits of a float."""
        deal, _, of = self.tested
        gains = np.zeros(len(deal.order))
        for (level, longer, parent), context in zip(self.smoothed(1), of):
            trains = self.trains[level.at]
            gains += np.bincount(context[trains], np.log(longer[trains] / parent[trains]), len(gains))
        return deal.shares(*_keys(deal, self.names()), *_bytes((gains.astype(np.float32).view(np.uint32) + np.uint32(128)) >> np.uint32(8), 3))

    def scores(self) -> pa.Table:
        deal, _, of = self.tested
        kept = deal.gathered(self.got.get(len(self.tree.least) + 2, {}), np.uint8) > 0
        p = self.root.copy()
        for (level, longer, _), context in zip(self.smoothed(0), of):
            some = kept[context]
            p[level.at[some]] = longer[some]
        total = lambda x: np.add.reduceat(x, self.firsts) if self.texts else x[:0]
        b = self.block
        return pa.table(
            {
                "doc_id": pa.array(b.ids, pa.int64(), mask=~b.known),
                "held_out": self.held_out,
                "n_tokens": pa.array(self.lens, pa.int64()),
                "n_known": pa.array(total((self.seen[self.token] > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array([self.totals.tokens] * self.texts, pa.int64()),
                "base_score": total(np.log10(self.root)),
                "score": total(np.log10(p)),
            }
        )


def _words(parts: tuple[np.ndarray, ...], asker: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digest and count of each word asked about."""
    digest = _told(parts[:_KEY], asker) | (_number(parts[_KEY : _KEY + 3]) << np.uint64(40))
    return digest, _number(parts[_KEY + 3 :]).astype(np.int64)


def _word_sums(least: int, *parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Training counts, and ranks of the words that are contexts."""
    digests, n = _words(parts[:-1], parts[-1])
    code, unique = pd.factorize(digests)
    out = np.zeros(len(unique), np.int64)
    np.add.at(out, code, n)
    return out[code], _ranks(unique << np.uint64(24) | unique >> np.uint64(40), out >= least, code, parts[-1])


def _word_totals(*parts: np.ndarray) -> list[int]:
    digests, n = _words(parts[:-1], parts[-1])
    return [int(n.sum()), len(np.unique(digests[n > 0]))]


def _sums(least: int, *parts: np.ndarray) -> tuple[np.ndarray, np.ndarray] | np.ndarray:
    """Training counts, and ranks of the grams that are contexts; without ``least`` there are none."""
    code, unique = pd.factorize(_told(parts[:_KEY], parts[-1]))
    out = np.bincount(code, _number(parts[_KEY:-1]), len(unique)).astype(np.int64)
    return (out[code], _ranks(unique, out >= least, code, parts[-1])) if least else out[code]


def _stay(gain: float, *parts: np.ndarray) -> np.ndarray:
    """Whether all blocks' gains of a context add up to more than ``gain``."""
    gains = (_number(parts[_KEY:-1]).astype(np.uint32) << np.uint32(8)).view(np.float32)
    code, unique = pd.factorize(_told(parts[:_KEY], parts[-1]))
    return (np.bincount(code, gains, len(unique)) > gain).astype(np.uint8)[code]


def scored(docs: DataFrame, tree: Tree = Tree(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The log10 probability of every whole text, by a suffix tree learned from the texts outside the held-out fold.

    Tokens are lower-case words (A-Z), and one end per text. The root gives (c + 0.5) / (N + 0.5 (V + 1)), where all unknown words
    share one probability. A context of one word (or the beginning) needs 20 occurrences, one of two words 4
    (``tree.least``, which also sets the depth). A context stays if, on the training tokens and each left out in turn, its smoothed next-symbol distribution beats that of the context one word shorter by 3
    nats; a context that stays keeps its suffixes for smoothing: P(x|s) = (c(sx) + m P(x|shorter s)) / (c(s) + m). A token is scored
    in its longest context that stays.

    Counts and gains are sums over all blocks (see ``blocks``): a block asks once for each of its distinct words, grams and
    contexts, so a frequent one costs one number per block. Words are told apart by 64-bit digests, longer grams by 40 bits and the bucket:
    about one pair in a million shares its count with another.

    Returns one row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``. Null text:
    empty, one token. Null ids are training rows. Repeated rows count each time. Empty table: no rows. Without
    training texts all tokens are unknown. Extra columns play no part.
    """
    buckets = partitions(docs)
    blocks = packed(docs, tree.block_bytes, id_col, text_col)
    texts = docs.where(~held_out(F.col(f"`{id_col}`"), tree.folds, tree.fold)).count()

    def ask(what: str, totals: Totals | None, *more: int):
        return lambda block, got: getattr(Tokens(block, tree, buckets, totals, got), what)(*more)

    depth = len(tree.least)
    least = [max(2, n) for n in tree.least] + [0]
    told, sums = answered(asked(blocks, ask("ask_words", None)), WORDS, partial(_word_sums, least[0]), 1, _word_totals, planes=True)
    totals = Totals(sum(s[0] for s in sums) + texts, sum(s[1] for s in sums) + (texts > 0), texts)
    counts, ranks = told.where("question > 0"), told.where("question < 0")
    for n in range(1, depth + 1):
        told, _ = answered(asked(blocks, ask("ask_grams", totals, n), counts), GRAMS, partial(_sums, least[n]), n + 1, planes=True)
        counts, ranks = counts.unionByName(told.where("question > 0")), ranks.unionByName(told.where("question < 0"))
    told = counts.unionByName(ranks)
    gains, _ = answered(asked(blocks, ask("ask_gains", totals), told), GAINS, partial(_stay, tree.gain), depth + 2)
    return with_answers(blocks, ask("scores", totals), SCHEMA, counts.unionByName(gains))
