"""Exact top-k search with a KD-tree per shard."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm.common import partitions, stored

SHARDS = (
    "shard bigint, task int, turn int, dims int, size bigint, ids binary, vectors binary, query_keys array<bigint>, query_ids array<bigint>, "
    "query_vectors array<binary>, bounds array<bigint>, bound_ids array<bigint>"
)
PACKS = "dims int, block int, keys binary, ids binary, vectors binary, bounds binary, bound_ids binary"
FOUND = "dims int, block int, query_ids binary, filled binary, ids binary, scores binary, beyond binary"
RANKED = "query_id bigint, rank int, vec_id bigint, score bigint"
_LOWEST, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_BELOW_ALL = -(1 << 200)


@dataclass(frozen=True)
class Search:
    """``scale``: components become floor(scale * x). Rows whose id is divisible by ``every`` are the queries. ``lane_bytes`` of shards
    lie in a task's memory at once; ``cells`` is the number of tasks beyond which work is only divided when those bytes ask for it."""

    k: int = 10
    scale: int = 1024
    every: int = 100
    shard_rows: int = 8192
    leaf_rows: int = 64
    block_queries: int = 1024
    shard_bytes: int = 16 << 20
    piece_rows: int = 512
    lane_bytes: int = 64 << 20
    cells: int = 128


class Best:
    """The best rows of each of n queries so far, at most k: a column each, best first. A row counts if it is as good as the query's
    bound; with the bound ``_LOWEST`` every row is."""

    def __init__(self, k: int, bounds: np.ndarray, bound_ids: np.ndarray) -> None:
        n = len(bounds)
        self.scores, self.ids = np.full((k, n), _LOWEST), np.full((k, n), _LAST)
        self.filled = np.zeros(n, np.int64)
        self.edge, self.edge_ids = bounds.copy(), bound_ids.copy()  # of the k-th row, or the bound

    def widen(self) -> None:
        """From now on scores are Python's integers, which have no bound."""
        if self.edge.dtype != object:
            open_ = (self.edge == _LOWEST) & (self.filled < len(self.scores))
            self.scores, self.edge = self.scores.astype(object), self.edge.astype(object)
            self.edge[open_] = _BELOW_ALL

    def wanted(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which of these rows, each for the query ``at``, belong to its best."""
        edge, edge_ids = self.edge[at], self.edge_ids[at]
        still = (ids < edge_ids) | ((ids == edge_ids) & (self.filled[at] < len(self.scores)))
        return ((scores > edge) | ((scores == edge) & still)).astype(bool)

    def offer(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Any number of rows for each query ``at``: one for each at a time."""
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        turn = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
        by_turn = np.argsort(turn, kind="stable")
        order, cuts = order[by_turn], np.cumsum(np.bincount(turn, minlength=1))
        for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
            some = order[a:b]
            some = some[self.wanted(at[some], scores[some], ids[some])]
            if len(some):
                self._insert(at[some], scores[some], ids[some])

    def _insert(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        old, old_ids, k = self.scores[:, at], self.ids[:, at], len(self.scores)
        row = np.arange(k)[:, None]
        before = ((old > scores) | ((old == scores) & (old_ids <= ids))).astype(bool) & (row < self.filled[at])
        place = np.count_nonzero(before, 0)
        later, here = row[1:] > place, np.flatnonzero(place < k)
        for all_, was, one in ((self.scores, old, scores), (self.ids, old_ids, ids)):
            was[1:] = np.where(later, was[:-1], was[1:])
            was[place[here], here] = one[here]
            all_[:, at] = was
        self.filled[at] = np.minimum(self.filled[at] + 1, k)
        full = at[self.filled[at] == k]
        self.edge[full], self.edge_ids[full] = self.scores[-1, full], self.ids[-1, full]


class Asked:
    """A block of queries; ``keys`` are those of their rows."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray) -> None:
        self.keys, self.vectors, self.kinds = keys, vectors, {}
        self.longest = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(1)).max(initial=0))

    def turned(self, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The vectors as columns, their positive and their negative parts."""
        if kind not in self.kinds:
            q = np.ascontiguousarray(self.vectors.astype(np.int64).T.astype(kind))
            self.kinds[kind] = q, np.maximum(q, 0), np.minimum(q, 0)
        return self.kinds[kind]


class Tree:
    """Median splits along the widest side; every node keeps the tight box of its points and their smallest id. ``keys`` tell rows
    with the same id apart."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, vectors: np.ndarray, leaf: int) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.keys, self.vectors = ids[order], keys[order], vectors[order]
        rows = np.arange(len(ids))
        low, high, first, self.spans, self.children = [], [], [], [], []
        todo, at = [(0, len(ids), -1)], 0
        while todo:
            a, b, parent = todo.pop()
            points = self.vectors[rows[a:b]]
            lo, hi = points.min(0), points.max(0)
            if parent >= 0:
                self.children[parent].append(at)
            low.append(lo)
            high.append(hi)
            first.append(self.ids[rows[a:b]].min())
            self.spans.append((a, b))
            self.children.append([])
            if b - a > leaf and (hi > lo).any():
                middle = (b - a) // 2
                side = int(np.argmax(hi.astype(np.float64) - lo))
                rows[a:b] = rows[a:b][np.argpartition(points[:, side], middle)]
                todo += [(a, a + middle, at), (a + middle, b, at)]
            at += 1
        self.ids, self.keys, self.vectors = self.ids[rows], self.keys[rows], self.vectors[rows]
        self.low, self.high, self.first = np.array(low), np.array(high), np.array(first)
        self.corner = float(np.sqrt((np.maximum(np.abs(self.low[0].astype(np.float64)), np.abs(self.high[0].astype(np.float64))) ** 2).sum()))

    def _below(self, nodes: list[int], levels: int) -> list[int]:
        for _ in range(levels):
            nodes = [c for n in nodes for c in self.children[n] or [n]]
        return nodes

    def search(self, asked: Asked, best: Best, piece: int) -> None:
        """Adds this shard's rows to the queries' best. No node whose box cannot reach a query's k-th is looked at for it; all
        queries go down the tree together, and rows of neighbouring leaves that most of them reach are one product of at most
        ``piece`` rows, best leaves first."""
        # every sum of products, also a part of one, is below this, so it is exact in each of these; Python's integers have no bound
        largest = self.corner * asked.longest * (1 + 1e-6)
        kind = np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64 if largest < 1 << 62 else object
        if kind is object:
            best.widen()
        q, up, down = asked.turned(kind)
        vectors = self.vectors.astype(kind) if kind is not object else self.vectors.astype(np.int64).astype(object)

        def reach(nodes: list[int]) -> np.ndarray:
            return self.high[nodes].astype(vectors.dtype) @ up + self.low[nodes].astype(vectors.dtype) @ down

        at_least: list[np.ndarray] = []

        def least(first: int | np.ndarray) -> np.ndarray:
            """The score that a row needs if no id is less than ``first``; in floats rounded, which keeps the order."""
            if not at_least:
                edge = np.clip(best.edge, _LOWEST, _LAST).astype(np.int64) if best.edge.dtype == object and kind is not object else best.edge
                at_least.extend((edge.astype(kind), (edge + (edge < _LAST)).astype(kind)))
            return np.where(first > best.edge_ids, at_least[1], at_least[0])

        def offered() -> None:
            best.offer(*(np.concatenate(x) for x in zip(*found)))
            found.clear()
            at_least.clear()

        nodes, reached = [0], reach([0])
        while True:
            alive = (reached >= least(self.first[nodes][:, None])).astype(bool)
            if not (open_ := alive.any(1)).any():
                return
            nodes = [n for n, x in zip(nodes, open_.tolist()) if x]
            if not any(self.children[n] for n in nodes):
                reached = reached[open_]
                break
            nodes = self._below(nodes, 4)
            reached = reach(nodes)
        places = np.array([self.spans[n][0] for n in nodes])
        order = np.argsort(places)
        nodes, reached = [nodes[i] for i in order.tolist()], reached[order]
        groups, size = [[]], 0
        for i, n in enumerate(nodes):
            a, b = self.spans[n]
            if groups[-1] and (size + b - a > piece or self.spans[nodes[i - 1]][1] != a):
                groups.append([])
                size = 0
            groups[-1].append(i)
            size += b - a
        room = np.empty(min(piece, len(vectors)) * q.shape[1], vectors.dtype)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for group in sorted(groups, key=lambda g: -float(reached[g].mean())):
            alive = (reached[group] >= least(int(self.first[[nodes[i] for i in group]].min()))).astype(bool)
            any_ = alive.any(0)
            if not any_.any():
                continue
            if 2 * np.count_nonzero(alive) >= alive.size:
                spans = [(self.spans[nodes[group[0]]][0], self.spans[nodes[group[-1]]][1], any_)]
            else:
                spans = [(*self.spans[nodes[i]], x) for i, x in zip(group, alive) if x.any()]
            for a, b, whose in spans:
                at = np.flatnonzero(whose)
                columns = q if len(at) == len(whose) else np.ascontiguousarray(q[:, at])
                for c in range(a, b, piece):
                    d = min(c + piece, b)
                    scores = np.matmul(vectors[c:d], columns, out=room[: (d - c) * len(at)].reshape(d - c, len(at)))
                    found.append(self._fit(c, scores, asked, at, best, least))
                    if sum(len(f[0]) for f in found) >= max(1024, len(best.edge)):
                        offered()
        if found:
            offered()

    def _fit(self, a: int, scores: np.ndarray, asked: Asked, at: np.ndarray, best: Best, least: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the rows from a on, with these scores for the queries ``at``: what may belong to their best."""
        ids, k = self.ids[a : a + len(scores)], len(best.scores)
        need = least(int(ids.min()))[at]
        some = np.flatnonzero(scores.max(0) >= need)
        if not len(some):
            return some, some, some
        if 8 * len(some) <= len(at):
            scores, at, need = scores[:, some], at[some], need[some]
        fit = (scores >= need).astype(bool)
        if len(ids) > k + 1 and scores.dtype != object and np.count_nonzero(fit) > 4 * k * len(at):  # no more than k can stay, besides the query's own row and ties
            fit &= scores >= np.partition(scores, len(ids) - k - 1, axis=0)[len(ids) - k - 1]
        row, column = np.divmod(np.flatnonzero(fit), max(1, len(at)))
        values, at = scores[row, column], at[column]
        if values.dtype != object:
            values = values.astype(np.int64).astype(best.edge.dtype)
        stay = (self.keys[a + row] != asked.keys[at]) & best.wanted(at, values, ids[row])
        return at[stay], values[stay], ids[row[stay]]


def _integers(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, ids, vectors) of the rows that take part."""
    ids, lists = batch.column(0), batch.column(1)
    starts = lists.offsets.to_numpy()
    values, lens = lists.values.to_numpy(zero_copy_only=False), np.diff(starts)  # nulls become nan
    taken = ids.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
    numbers = ids.fill_null(0).to_numpy()
    for dims in np.unique(lens[taken]).tolist():
        rows, most = np.flatnonzero(taken & (lens == dims)), max(1, (1 << 21) // max(dims, 1))
        for some in (rows[i : i + most] for i in range(0, len(rows), most)):
            x = values[starts[some][:, None] + np.arange(dims)].astype(np.float64)
            fine = np.isfinite(x).all(1)
            x, some = np.floor(x[fine] * scale), some[fine]
            if (wide := (np.abs(x) >= 2.0**63).any(1)).any():
                raise OverflowError(f"vector {numbers[some[wide][0]]}: a component leaves 64 bits")
            if len(some):
                yield dims, numbers[some].astype(np.int64), _narrow(x.astype(np.int64))


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """In two, four or eight bytes a number."""
    low, high = vectors.min(initial=0), vectors.max(initial=0)
    return vectors.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _widened(data: bytes, rows: int, dims: int) -> np.ndarray:
    """What ``_narrow(...).tobytes()`` wrote."""
    return np.frombuffer(data, f"<i{len(data) // max(rows * dims, 1) or 2}").reshape(rows, dims)


def _keys(shard: int, rows: int) -> np.ndarray:
    """A number of its own for each row of a shard."""
    return (shard << 14) + np.arange(rows, dtype=np.int64)


def _sharded(batches: Iterator[pa.RecordBatch], how: Search) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, turn = TaskContext.get().partitionId(), 0
    waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def shard(dims: int, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        nonlocal turn
        number = (task << 24) + turn + 1
        vectors, queries = _narrow(vectors), np.flatnonzero(ids % how.every == 0)
        keys = _keys(number, len(ids))
        bounds, bound_ids = np.full(len(queries), _LOWEST), np.full(len(queries), _LAST)
        if len(queries):
            best = Best(how.k, bounds, bound_ids)
            Tree(ids, keys, vectors, how.leaf_rows).search(Asked(keys[queries], vectors[queries]), best, how.piece_rows)
            # a weaker bound loses nothing
            worst = [(s, i) if full and s >= _LOWEST else (_LOWEST, _LAST) for s, i, full in zip(best.scores[-1].tolist(), best.ids[-1].tolist(), (best.filled == how.k).tolist())]
            bounds, bound_ids = (np.array(x, np.int64) for x in zip(*((min(s, _LAST), i if s <= _LAST else _LAST) for s, i in worst)))
        row = {
            "shard": number, "task": task, "turn": turn, "dims": dims, "size": ids.nbytes + vectors.nbytes, "ids": ids.tobytes(), "vectors": vectors.tobytes(),
            "query_keys": keys[queries].tolist(), "query_ids": ids[queries].tolist(),
            "query_vectors": [v.tobytes() for v in vectors[queries]], "bounds": bounds.tolist(), "bound_ids": bound_ids.tolist(),
        }
        turn += 1
        longs, kinds = pa.list_(pa.int64()), pa.list_(pa.binary())
        return pa.RecordBatch.from_pylist([row], pa.schema(
            [("shard", pa.int64()), ("task", pa.int32()), ("turn", pa.int32()), ("dims", pa.int32()), ("size", pa.int64()), ("ids", pa.binary()),
             ("vectors", pa.binary()), ("query_keys", longs), ("query_ids", longs), ("query_vectors", kinds), ("bounds", longs), ("bound_ids", longs)]
        ))

    def full_shards(whole: bool) -> Iterator[pa.RecordBatch]:
        for dims, parts in list(waiting.items()):
            most = max(1, min(how.shard_rows, how.shard_bytes // max(8 * dims, 1)))
            if sum(len(p[0]) for p in parts) < (most if whole else 1):
                continue
            ids, vectors = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            while len(ids) >= most or (len(ids) and not whole):
                yield shard(dims, ids[:most], vectors[:most])
                ids, vectors = ids[most:], vectors[most:]
            waiting[dims] = [(ids.copy(), vectors.copy())]

    for batch in batches:
        for dims, ids, vectors in _integers(batch, how.scale):
            waiting.setdefault(dims, []).append((ids, vectors))
        yield from full_shards(True)
    yield from full_shards(False)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of queries, each with its columns one after the other."""
    for batch in batches:
        for i in range(len(batch)):
            dims, block, queries = (batch.column(j)[i].as_py() for j in range(3))
            vectors = np.concatenate([_widened(q["vector"], 1, dims) for q in queries])
            column = lambda name: np.array([q[name] for q in queries], np.int64).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims], pa.int32()), pa.array([block], pa.int32()),
                 *(pa.array([x], pa.binary()) for x in (column("key"), column("id"), vectors.tobytes(), column("bound"), column("bound_id")))],
                ["dims", "block", "keys", "ids", "vectors", "bounds", "bound_ids"],
            )


def _searched(batches: Iterator[pa.RecordBatch], how: Search) -> Iterator[pa.RecordBatch]:
    """Of each cell first its shards, whose trees are built once, then its blocks of queries, each searched in one shard after
    the other: the k-th score so far is the bound in the next."""
    cell, trees = None, []
    for batch in batches:
        for i in range(len(batch)):
            row = {n: batch.column(n)[i] for n in batch.schema.names}
            if cell != (cell := row["cell"].as_py()):
                trees = []
            dims, ids = row["dims"].as_py(), np.frombuffer(row["ids"].as_py(), np.int64)
            vectors = _widened(row["vectors"].as_py(), len(ids), dims)
            if (shard := row["shard"].as_py()) is not None:
                trees.append(Tree(ids, _keys(shard, len(ids)), vectors, how.leaf_rows))
                continue
            keys, bounds, bound_ids = (np.frombuffer(row[n].as_py(), np.int64) for n in ("keys", "bounds", "bound_ids"))
            asked, best = Asked(keys, vectors), Best(how.k, bounds, bound_ids)
            for tree in trees:
                tree.search(asked, best, how.piece_rows)
            there = (np.arange(how.k)[:, None] < best.filled).T
            scores, ids_, beyond = best.scores.T[there], best.ids.T[there], b""
            if scores.dtype == object:
                if (scores > _LAST).any():  # no k rows are better, unless theirs are beyond as well
                    raise OverflowError("a score leaves 64 bits")
                low = (scores < _LOWEST).astype(bool)
                beyond, scores = low.tobytes(), np.where(low, _LOWEST, scores).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims], pa.int32()), pa.array([row["block"].as_py()], pa.int32()),
                 *(pa.array([x], pa.binary()) for x in (ids.tobytes(), best.filled.astype(np.int32).tobytes(), ids_.tobytes(), scores.tobytes(), beyond))],
                ["dims", "block", "query_ids", "filled", "ids", "scores", "beyond"],
            )


def _ranked(batches: Iterator[pa.RecordBatch], how: Search) -> Iterator[pa.RecordBatch]:
    """The best of all cells; rows of a block come one after the other."""
    block, best, query_ids = None, None, np.array([], np.int64)

    def done() -> Iterator[pa.RecordBatch]:
        if best is None:
            return
        there = (np.arange(how.k)[:, None] < best.filled).T
        scores = best.scores.T[there]
        if scores.dtype == object and (scores < _LOWEST).any():
            raise OverflowError("a score leaves 64 bits")
        query, rank = np.nonzero(there)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[query]), pa.array((rank + 1).astype(np.int32)), pa.array(best.ids.T[there]), pa.array(scores.astype(np.int64))],
            ["query_id", "rank", "vec_id", "score"],
        )

    for batch in batches:
        for i in range(len(batch)):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            if block != (block := (row["dims"], row["block"])):
                yield from done()
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                best = Best(how.k, np.full(len(query_ids), _LOWEST), np.full(len(query_ids), _LAST))
            scores, beyond = np.frombuffer(row["scores"], np.int64), np.frombuffer(row["beyond"], bool)
            if beyond.any():
                best.widen()
            if best.edge.dtype == object:
                scores = scores.astype(object)
                scores[: len(beyond)][beyond] = _LOWEST - 1
            best.offer(np.repeat(np.arange(len(query_ids)), np.frombuffer(row["filled"], np.int32)), scores, np.frombuffer(row["ids"], np.int64))
    yield from done()


def _grid(how: Search, tasks: int, shard_bytes: int, query_bytes: int, found_bytes: int, shards: int, blocks: int) -> tuple[int, int]:
    """(lanes of shards, groups of blocks). Each group gets all shards, each lane all queries and sends its best rows for them: the
    numbers that send the fewest bytes and make some ``tasks`` cells. No lane has more than about ``lane_bytes``."""
    least = -(-shard_bytes // how.lane_bytes)
    choices = []
    for groups in range(1, min(tasks, blocks) + 1):
        lanes = min(shards, max(1, least, -(-tasks // groups)))
        choices.append((groups * shard_bytes + lanes * (query_bytes + found_bytes), lanes, groups))
    return min(choices)[1:]


def nearest(rows: DataFrame, how: Search = Search(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every query the k rows with the highest integer inner product.

    Rows are packed into shards as they are read, each with a KD-tree: median splits along the widest side, tight boxes. No point
    of a box can have a higher inner product than the sum of the larger of q * low and q * high, so a node is left
    out for a query when that cannot beat its k-th best. A query is first searched in its own shard; the k-th score there is the
    bound with which it goes to all others.

    Shards are dealt to lanes of bounded size, blocks of ``block_queries`` queries to groups. A cell is a lane and a group, one task:
    it builds the trees of its lane once, then takes one block after the other through all of them, and sends the k best of
    the lane for each query. So a shard is sent once for each group and a block once for each lane, not once for each pair. What is
    sent grows with the rows as long as ``cells`` lanes hold them, then with lanes times queries. The work is that of a query set against all rows.

    Ties go to the smaller id. Candidates of a query: every row but its own. Fewer than k candidates: all. Vectors that are null or hold
    null or non-finite components take no part; nor do rows without id. Scores are exact; a component, or a score among the k best,
    that leaves 64 bits is an error. Vectors are compared with those of the same length only, so empty ones with empty ones, at score 0.
    Repeated rows, and rows that repeat an id, are candidates, and queries, each for itself: as query each has its own ranks from 1.
    Empty table: no rows. Extra columns play no part.
    """
    pairs = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    shards = stored(pairs.mapInArrow(lambda b: _sharded(b, how), SHARDS), "kd-shards")
    of_dims = shards.groupBy("dims").agg(
        F.count("*").alias("shards"), F.sum("size").alias("bytes"), F.sum(F.size("query_keys")).alias("queries"), F.max("task").alias("task"),
        F.sum(F.aggregate("query_vectors", F.lit(0).cast("long"), lambda n, v: n + F.length(v) + 32)).alias("query_bytes"),
    )
    sizes = {r.dims: r for r in of_dims.collect()}
    width = max((r.task for r in sizes.values()), default=0) + 1  # shards are numbered across tasks, so lanes are even
    sizes = {dims: r for dims, r in sizes.items() if r.queries}
    if not sizes:
        return rows.sparkSession.createDataFrame([], RANKED)
    blocks = {dims: -(-r.queries // how.block_queries) for dims, r in sizes.items()}
    tasks, cells, lanes, groups, base = min(partitions(rows), how.cells), 0, {}, {}, {}
    for dims, r in sizes.items():
        base[dims] = cells
        lanes[dims], groups[dims] = _grid(how, tasks, r.bytes, r.query_bytes, 16 * how.k * r.queries, r.shards, blocks[dims])
        cells += lanes[dims] * groups[dims]
    of = lambda numbers: F.element_at(F.create_map(*(F.lit(x) for kv in numbers.items() for x in kv)), F.col("dims"))
    queries = shards.select(
        "dims", F.explode(F.arrays_zip("query_keys", "query_ids", "query_vectors", "bounds", "bound_ids")).alias("q")
    ).select(
        "dims",
        F.struct(
            F.col("q.query_keys").alias("key"), F.col("q.query_ids").alias("id"), F.col("q.query_vectors").alias("vector"),
            F.col("q.bounds").alias("bound"), F.col("q.bound_ids").alias("bound_id"),
        ).alias("query"),
        F.pmod(F.xxhash64("q.query_keys"), of(blocks)).cast("int").alias("block"),
    )
    packs = stored(queries.groupBy("dims", "block").agg(F.collect_list("query").alias("queries")).mapInArrow(_packed, PACKS), "kd-queries")
    cell = lambda lane, group: (of(base) + lane * of(groups) + group).cast("int").alias("cell")
    every = lambda numbers: F.explode(F.sequence(F.lit(0), of(numbers) - 1))
    candidates = shards.where(F.col("dims").isin(*sizes)).withColumn("group", every(groups)).select(
        cell(F.pmod(F.col("turn").cast("long") * width + F.col("task"), of(lanes)), F.col("group")), "dims", "shard", "ids", "vectors"
    )
    asked = packs.withColumn("lane", every(lanes)).select(cell(F.col("lane"), F.pmod("block", of(groups))), *packs.columns)
    work = candidates.unionByName(asked, allowMissingColumns=True).repartitionById(cells, "cell")
    found = work.sortWithinPartitions("cell", F.col("shard").isNull(), "shard", "block").mapInArrow(lambda b: _searched(b, how), FOUND)
    merged = found.repartition(partitions(rows), "dims", "block").sortWithinPartitions("dims", "block")
    return merged.mapInArrow(lambda b: _ranked(b, how), RANKED)
