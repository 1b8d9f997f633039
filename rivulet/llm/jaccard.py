"""N-gram Jaccard join: prefixes of the rarest shingles and of combinations of frequent ones, then exact checks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rivulet.llm.blocks import Block, Deal, answered, asked, mix, opened, packed, read, squeezed, with_answers
from rivulet.llm.common import partitions, stored
from rivulet.llm.words import Words

FEATURES = "doc_id bigint, n_shingles bigint, low bigint, first boolean, block bigint, at int, outline binary, keys array<bigint>, rooms array<int>"
_PART = 1 << 15
_STEP, _COMBINED, _SAME = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5)


@dataclass(frozen=True)
class Join:
    """``words`` in a shingle; documents link from ``percent`` on. A shingle counts as often as its cell of a counting sketch
    (``cells`` cells), and is frequent if that exceeds the mean by ``frequent`` and by four standard deviations. Combinations are used up to ``combined`` shingles in a
    document. ``small``: groups of so many documents, in the first round and in later ones, are compared pair by pair. ``outline``: cells of
    a document's outline."""

    words: int = 3
    percent: int = 90
    cells: int = 1 << 20
    frequent: int = 24
    combined: int = 400
    small: tuple[int, int] = (2, 16)
    outline: int = 128
    block_bytes: int = 8 << 20


def shingled(block: Block, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The hash and document of every shingle, repeats too, and the number of documents."""
    w = Words(block)
    first = (np.cumsum(w.counts) - w.counts).astype(np.int64)
    full = np.flatnonzero(w.counts[w.doc] - (np.arange(len(w.doc)) - first[w.doc]) >= k)
    value = np.zeros(len(full), np.uint64)
    for j in range(k):
        value = mix(value * _STEP + w.hash[full + j])
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))  # the whole sequence is the only shingle
    extra = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        has = w.counts[short] > j
        extra[has] = mix(extra[has] * _STEP + w.hash[first[short[has]] + j])
    return np.concatenate([value, extra + np.uint64(1)]), np.concatenate([w.doc[full], short]), len(w.counts)


def _cell(value: np.ndarray, cells: int) -> np.ndarray:
    return (value >> np.uint64(20)).astype(np.int64) & (cells - 1)


@dataclass(frozen=True)
class Sketch:
    """How many shingles fell into each cell; above ``most`` they are frequent."""

    counts: np.ndarray
    most: float


class Sets:
    """The shingle set of every document of a block: distinct hashes, documents one after the other."""

    def __init__(self, block: Block, join: Join) -> None:
        self.block, self.join = block, join
        value, doc, n = shingled(block, join.words)
        order = np.argsort(value)
        order = order[np.argsort(doc[order].astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")]
        value, doc = value[order], doc[order]
        new = np.ones(len(doc), bool)
        new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        self.value, self.doc = value[new], doc[new]
        self.sizes = np.bincount(self.doc, minlength=n)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.some = np.flatnonzero(self.sizes)  # documents with words
        # two sums of spread hashes say which sets are equal
        add = lambda x: np.add.reduceat(x, self.starts[self.some]) if len(self.some) else x[:0]
        self.same = mix(add(mix(self.value ^ _SAME)) * _STEP + add(mix(self.value + _SAME)))

    def outlines(self, docs: np.ndarray) -> list[bytes]:
        """How many shingles of each document fall into each of a few cells. The smaller counts of two documents add up to no
        less than what they share."""
        cells = self.join.outline
        counts = np.bincount(self.doc * cells + (self.value & np.uint64(cells - 1)).astype(np.int64), minlength=len(self.sizes) * cells)
        counts = counts.reshape(-1, cells)[docs]
        wide = counts.max(1, initial=0)
        return [x.astype(np.uint8 if w < 1 << 8 else np.uint16 if w < 1 << 16 else np.uint32).tobytes() for x, w in zip(counts, wide)]

    def representatives(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct sets: (digest, least document id, for each document with words which one it has)."""
        unique, inverse = np.unique(self.same, return_inverse=True)
        least = np.full(len(unique), np.iinfo(np.int64).max)
        np.minimum.at(least, inverse, self.block.ids[self.some])
        return unique, least, inverse

    def keys(self, sketch: Sketch, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, key, room) for the given documents: what any document that links with it shares at least once.

        A link leaves at most e = n - ceil(percent * n / 100) of its n shingles unshared. In a fixed order, the rarest cells first and so the
        frequent shingles last, either one of the first e + 1 is shared and rare, or the first two shared ones are both frequent and among the first e + 2:
        so rare shingles of the prefix are keys alone, and frequent ones in pairs. In long documents, which would have
        many pairs, all are keys alone; lengths near the border have both kinds.

        Two documents that link meet under what they share first. The room is what a document can share with another if the
        key is that: the shingles from the key on. Under a key, only documents with room for a link need to be compared.
        """
        j = self.join
        wanted = np.zeros(len(self.sizes), bool)
        wanted[docs] = True
        at = np.flatnonzero(wanted[self.doc])
        value, doc = self.value[at], self.doc[at]
        count = sketch.counts[_cell(value, j.cells)]
        order = np.lexsort((mix(value + _STEP), count, doc))
        value, doc, often = value[order], doc[order], count[order] > sketch.most
        n = self.sizes[doc]
        rank = np.arange(len(doc)) - np.searchsorted(doc, doc, "left")
        unshared = n + (-j.percent * n) // 100
        single = (rank <= unshared) & (~often | (n * 100 >= j.combined * j.percent))
        pairs = (rank <= unshared + 1) & often & (n <= j.combined)
        out_doc, out_key, out_room = [doc[single]], [value[single]], [(n - rank)[single]]
        at = np.flatnonzero(pairs)
        if len(at):
            d = doc[at]
            many = np.searchsorted(d, d, "right") - np.arange(len(at)) - 1  # partners that follow
            left = np.repeat(np.arange(len(at)), many)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many)
            out_doc.append(d[left])
            out_key.append(mix(value[at][left] * _COMBINED + value[at][right]))
            out_room.append((n - rank)[at][right] + 1)
        return np.concatenate(out_doc), np.concatenate(out_key), np.concatenate(out_room)


def _sketch(blocks: DataFrame, join: Join) -> Sketch:
    """The counting sketch. The sketches add up in the tasks and by parts; the driver gets one number per cell."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(join.cells, np.int64)
        for batch in batches:
            for i in range(len(batch)):
                value = shingled(read(pa.Table.from_batches([batch.slice(i, 1)])), join.words)[0]
                total += np.bincount(_cell(value, join.cells), minlength=join.cells)
        parts = np.split(total, range(_PART, join.cells, _PART))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([squeezed(p.tobytes()) for p in parts], pa.binary())], ["part", "cells"]
        )

    def added(rows: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(opened(x.as_py()), np.int64) for x in rows.column("cells")], axis=0)
        return pa.table({"part": rows.column("part")[:1], "cells": pa.array([squeezed(total.tobytes())], pa.binary())})

    schema = "part int, cells binary"
    rows = blocks.mapInArrow(counted, schema).groupBy("part").applyInArrow(added, schema).orderBy("part").collect()
    if not rows:
        return Sketch(np.zeros(join.cells, np.uint8), 0)
    cells = np.concatenate([np.frombuffer(opened(bytes(r.cells)), np.int64) for r in rows])
    return Sketch(cells.astype(np.min_scalar_type(cells.max())), cells.mean() + max(join.frequent, 4 * cells.mean() ** 0.5))


def _least(digests: np.ndarray, ids: np.ndarray, _: np.ndarray) -> np.ndarray:
    """The smallest id of a document with the set."""
    _, inverse = np.unique(digests, return_inverse=True)
    least = np.full(inverse.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, ids)
    return least[inverse]


def _asked_twice(digests: np.ndarray, _: np.ndarray) -> np.ndarray:
    _, inverse, count = np.unique(digests, return_inverse=True, return_counts=True)
    return (count[inverse] > 1).astype(np.uint8)


def features(blocks: DataFrame, join: Join) -> DataFrame:
    """FEATURES of every document, written once.

    Documents with equal sets are represented by the smallest id (``first``). A representative keeps those of its keys that another
    representative has too, and if there are any, its outline; ``block`` and ``at`` say where its text is.
    """
    buckets = partitions(blocks)
    sent = blocks.sparkSession.sparkContext.broadcast(_sketch(blocks, join))

    def ask_same(block: Block, got: dict) -> Iterator[tuple[int, bytes]]:
        unique, least, _ = Sets(block, join).representatives()
        return Deal(unique, buckets).shares(unique, least)

    def chosen(sets: Sets, got: dict) -> tuple[np.ndarray, np.ndarray]:
        """The representatives of the block, one row each, and for every document with words its representative's id."""
        unique, least, inverse = sets.representatives()
        low = Deal(unique, buckets).gathered(got.get(1, {}), np.int64)
        mine = np.flatnonzero(sets.block.ids[sets.some] == low[inverse])
        return sets.some[mine[np.unique(inverse[mine], return_index=True)[1]]], low[inverse]

    def ask_keys(block: Block, got: dict) -> Iterator[tuple[int, bytes]]:
        sets = Sets(block, join)
        unique = np.unique(sets.keys(sent.value, chosen(sets, got)[0])[1])
        return Deal(unique, buckets).shares(unique)

    def result(block: Block, got: dict) -> pa.Table:
        sets = Sets(block, join)
        mine, low = chosen(sets, got)
        doc, key, room = sets.keys(sent.value, mine)
        unique, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        shared = (Deal(unique, buckets).gathered(got.get(2, {}), np.uint8) > 0) | (count > 1)
        doc, key, room = (x[shared[inverse]] for x in (doc, key, room))
        order = np.argsort(doc, kind="stable")
        doc, key, room = doc[order], key[order].view(np.int64), room[order].astype(np.int32)
        n = len(sets.sizes)
        has = np.bincount(doc, minlength=n) > 0
        cuts = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
        lows = block.ids.copy()
        lows[sets.some] = low
        first = np.zeros(n, bool)
        first[mine] = True
        outlines = np.full(n, None, object)
        outlines[has] = sets.outlines(np.flatnonzero(has))
        return pa.table(
            {
                "doc_id": pa.array(block.ids, pa.int64(), mask=~block.known),
                "n_shingles": pa.array(sets.sizes, pa.int64()),
                "low": pa.array(lows, pa.int64()),
                "first": first,
                "block": pa.array([block.number] * n, pa.int64()),
                "at": pa.array(np.arange(n), pa.int32()),
                "outline": pa.array(outlines, pa.binary()),
                "keys": pa.ListArray.from_arrays(pa.array(cuts), pa.array(key)),
                "rooms": pa.ListArray.from_arrays(pa.array(cuts), pa.array(room)),
            }
        )

    one, _ = answered(asked(blocks, ask_same), [np.uint64, np.int64], _least, 1)
    two, _ = answered(asked(blocks, ask_keys, one), [np.uint64], _asked_twice, 2)
    return stored(with_answers(blocks, result, FEATURES, one.unionByName(two)), "jaccard-features")


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every end of a link (a, b): the smallest id that links lead to.

    Each round every node takes the smallest component among its own and its neighbours', then the component of that
    component, until nothing changes. In the first round a component is a node itself.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "both-ways")
    least = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near"))
    taken = stored(least.select("id", F.least("id", "near").alias("component")), "components")
    while True:
        jump = taken.select(F.col("id").alias("component"), F.col("component").alias("next"))
        now = stored(taken.join(jump, "component").select("id", F.least("component", "next").alias("component")), "components")
        near = both.join(now.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        after = now.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        after = stored(after, "components")
        taken = after.select("id", "component")
        if after.where(F.col("component") != F.col("old")).isEmpty():
            return taken


def _merged(now: DataFrame | None, step: DataFrame) -> DataFrame:
    """``id, component`` after components, or documents that were alone, have joined as ``step`` (id, component) says."""
    if now is None:
        return step
    known = now.join(step.toDF("component", "next"), "component", "left").select("id", F.coalesce("next", "component").alias("component"))
    return stored(known.unionByName(step.join(now, "id", "left_anti")), "components")


def _counts(outlines: pa.Array, cells: int) -> np.ndarray:
    """Outlines, each in the narrowest numbers that hold it, as one matrix."""
    raw = outlines.to_pylist()
    out = np.zeros((len(raw), cells), np.int32)
    size = np.array([len(x) // cells for x in raw])
    for width in np.unique(size).tolist():
        some = np.flatnonzero(size == width)
        out[some] = np.frombuffer(b"".join(raw[i] for i in some), f"u{width}").reshape(-1, cells)
    return out


def _outlined(batches: Iterator[pa.RecordBatch], join: Join) -> Iterator[pa.RecordBatch]:
    """The pairs whose outlines allow a link."""
    for batch in batches:
        number = lambda name: batch.column(name).to_numpy()
        if not len(batch):
            continue
        both = np.minimum(_counts(batch.column("o_a"), join.outline), _counts(batch.column("o_b"), join.outline)).sum(1)
        may = both * 100 >= (number("n_a") + number("n_b") - both) * join.percent
        yield batch.select(["a", "b", "of_a", "of_b", "n_a", "n_b"]).filter(pa.array(may))


def _sets(blocks: DataFrame, wanted: DataFrame, join: Join) -> DataFrame:
    """``id, shingles`` of the documents that ``wanted`` (id, block, at) names, from the blocks where their texts are."""

    def taken(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, lists = right.column("id"), []
        if len(right):
            sets = Sets(read(left).only(right.column("at").to_numpy()), join)
            lists = [sets.value[sets.starts[i] : sets.starts[i + 1]].view(np.int64) for i in range(len(right))]
        return pa.table({"id": pa.array(ids.to_pylist(), pa.int64()), "shingles": pa.array(lists, pa.list_(pa.int64()))})

    return stored(blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(taken, "id bigint, shingles array<bigint>"), "sets")


def _checked(pairs: DataFrame, nodes: DataFrame, blocks: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) that link, given as their components (of_a, of_b). Outlines leave out almost all that do not, without loss; only what remains moves its sets.
    ``b`` may be in many pairs; its join comes last and is one that Spark can split."""
    side = lambda x: nodes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("outline").alias(f"o_{x}"))
    near = stored(
        pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(lambda x: _outlined(x, join), "a bigint, b bigint, of_a bigint, of_b bigint, n_a bigint, n_b bigint"), "near"
    )
    wanted = near.select(F.col("a").alias("id")).union(near.select("b")).distinct()
    sets = _sets(blocks, nodes.join(wanted, "id").select("id", "block", "at"), join)
    met = near.join(sets.toDF("a", "s_a"), "a").join(sets.toDF("b", "s_b"), "b")
    both = F.size(F.array_intersect("s_a", "s_b"))
    return met.where(both * 100 >= (F.col("n_a") + F.col("n_b") - both) * join.percent).select("of_a", "of_b").toDF("a", "b")


def linked(nodes: DataFrame, blocks: DataFrame, join: Join) -> DataFrame | None:
    """``id, component`` of the representatives that link with another. ``nodes``: id, n, block, at, outline, keys, rooms.

    Documents under one key are compared without making all pairs of a large group. First each key's smallest document is compared with
    its others, which joins most copies in work that grows with the rows. In small groups then every pair is; in a larger group
    the smallest documents that have not yet been centres, first one and then each time eight times as many, are compared with those
    that are not yet in their components. Pairs of one component need no check, and a pair of two components has been checked once
    either was a centre; the group is done when it is one component or has no two left. So no link between two components is lost.

    A round's links join components, so only they are followed, from one component to the other; links of former rounds and what they joined are
    not gone through again, and a round without links leaves the components as they are.
    """
    members = nodes.select("id", "n", F.explode(F.arrays_zip("keys", "rooms")).alias("k")).select("id", "n", "k.keys", "k.rooms").toDF("id", "n", "key", "room")
    members = stored(members, "members")
    now, limit, width = None, join.small[0], 1
    while True:
        current = members.withColumn("component", F.col("id")) if now is None else members.join(now, "id", "left").select(
            "id", "n", "key", "room", F.coalesce("component", "id").alias("component")
        )
        groups = (
            current.groupBy("key")
            .agg(F.count("*").alias("many"), F.min("component").alias("low"), F.max("component").alias("high"))
            .where(F.col("low") != F.col("high"))
        )
        left = stored(current.join(groups.select("key", "many"), "key"), "open")
        if left.isEmpty():
            return now
        place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
        # in a small group all are centres
        some = left.withColumn("place", place).where(F.col("place") <= max(limit, width)).where((F.col("many") <= limit) | (F.col("place") <= width))
        centres = stored(some.select("key", "id", "n", "room", "component").toDF("key", "b", "n_b", "room_b", "of_b"), "centres")
        fits = F.least("room", "room_b") * (100 + join.percent) >= (F.col("n") + F.col("n_b")) * join.percent
        both = left.join(centres, "key").where((F.col("b") < F.col("id")) & (F.col("component") != F.col("of_b")) & fits)
        pairs = both.select(F.col("id").alias("a"), "b", F.col("component").alias("of_a"), "of_b").distinct()
        links = stored(_checked(pairs, nodes, blocks, join), "links")
        if not links.isEmpty():
            now = _merged(now, components(links))
        taken = centres.select("key", F.col("b").alias("id"))
        members = left.where(F.col("many") > limit).join(taken, ["key", "id"], "left_anti").select("id", "n", "key", "room")
        limit, width = join.small[1], 8 * width


def joined(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: the smallest document id that links lead to, itself included.

    A document's set: its distinct shingles of ``join.words`` words (lower case A-Z); with fewer words the whole sequence; without words
    none. Two documents link when their sets' Jaccard similarity is ``join.percent`` per cent or more. Candidates share a key (see
    ``Sets.keys``) and fit in room and outline; every link is checked on the whole sets, of 64-bit shingle hashes. Documents with equal
    sets are one node, named by the smallest id, so a group of copies costs its size.

    One row per row of ``docs``. Null and empty texts link with nothing. A null id comes after all numbers; its component is null
    if no number is in it. Rows that repeat an id with another text are one document to those that they represent. Empty table:
    no rows. Extra columns play no part.
    """
    blocks = packed(docs, join.block_bytes, id_col, text_col)
    found = features(blocks, join)
    nodes = found.where(F.col("first") & (F.size("keys") > 0)).select(F.col("low").alias("id"), F.col("n_shingles").alias("n"), "block", "at", "outline", "keys", "rooms")
    now = linked(nodes, blocks, join)
    rows = found.select("doc_id", "n_shingles", "low")
    if now is not None:
        rows = rows.join(now.withColumnRenamed("id", "low"), "low", "left")
        rows = rows.withColumn("low", F.coalesce("component", "low"))
    null = F.lit(np.iinfo(np.int64).max)
    return rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.nullif("low", null)).alias("component_id"))
