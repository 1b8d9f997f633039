"""Texts in blocks, and questions that blocks put to all others.

Work on every window, word or shingle of a corpus would shuffle many times its size if each were a row. Here the texts
lie in a table of blocks of bounded size. A block asks about its distinct digests: they go, packed, to buckets by digest,
and each bucket sends one small answer per digest back in the same order. A block finds its digests again from its text,
so neither the digests nor the documents they come from are ever sent back. A digest that many documents share is sent
once by each block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from rivulet.llm.common import id_and_text, partitions, stored
from rivulet.session import scratch_path

BLOCKS = "block bigint, ids array<bigint>, lens array<bigint>, data binary"
ASKED = "bucket int, block bigint, payload binary"
ANSWERED = "block bigint, bucket int, payload binary, question int"


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Block:
    """One block: ids (null: the greatest number), texts one after the other, and where each begins."""

    def __init__(self, number: int, ids: list, lens: list[int], data: bytes) -> None:
        self.number = number
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64)
        raw = zstandard.ZstdDecompressor().decompress(data) if data else b""
        self.data = np.frombuffer(raw, np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(np.array(lens, np.int64))]).astype(np.int64)


    def only(self, some: np.ndarray) -> Block:
        """The block with just these of its texts, in this order."""
        out = object.__new__(Block)
        out.number, out.known, out.ids = self.number, self.known[some], self.ids[some]
        out.data = np.concatenate([self.data[:0], *(self.data[self.starts[i] : self.starts[i + 1]] for i in some.tolist())])
        out.starts = np.concatenate([[0], np.cumsum(self.starts[some + 1] - self.starts[some])]).astype(np.int64)
        return out


def _packed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    ids, texts, size = [], [], 0
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())), ("data", pa.binary())])

    def row() -> pa.RecordBatch:
        data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts)) if size else b""
        return pa.RecordBatch.from_pylist([{"block": number, "ids": ids, "lens": [len(t) for t in texts], "data": data}], schema)

    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py().encode()
            if ids and size + len(text) > most:
                yield row()
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(i)
            texts.append(text)
            size += len(text)
    if ids:
        yield row()


def packed(docs: DataFrame, block_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts as a table of blocks of at most ``block_bytes``; a longer text is a block of its own.

    The table is written to the shared folder, laid out by block in as many files' groups as there are shuffle partitions, so
    it is never shuffled when answers come in. Its entry in the catalog goes at once; the files stay in the scratch folder.
    """
    spark = docs.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    rows = id_and_text(docs, id_col, text_col).mapInArrow(lambda b: _packed(b, block_bytes), BLOCKS)
    (
        rows.write.format("parquet").option("compression", "none").bucketBy(partitions(docs), "block")
        .option("path", scratch_path(spark, "blocks")).saveAsTable(name)
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def read(row: dict | pa.Table) -> Block:
    at = {n: row.column(n)[0].as_py() for n in ("block", "ids", "lens", "data")}
    return Block(at["block"], at["ids"], at["lens"], at["data"])


class Deal:
    """How distinct digests go to buckets: the order within each bucket is that in which they are given."""

    def __init__(self, digests: np.ndarray, buckets: int) -> None:
        self.buckets = buckets
        self.bucket = ((digests >> np.uint64(40)) % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
        self.order = np.argsort(self.bucket, kind="stable")
        self.cuts = np.searchsorted(self.bucket[self.order], np.arange(buckets + 1))

    def shares(self, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(bucket, the columns' values one after the other); every column is a number per digest. Each is compressed on its own: random
        bytes would spoil the code that compression finds for small numbers."""
        dealt = [c[self.order] for c in columns]
        for b in np.flatnonzero(np.diff(self.cuts)).tolist():
            parts = [squeezed(c[self.cuts[b] : self.cuts[b + 1]].tobytes()) for c in dealt]
            yield b, b"".join([np.array([len(p) for p in parts], "<u4").tobytes(), *parts])

    def gathered(self, answers: dict[int, bytes], kind: type, planes: bool = False) -> np.ndarray:
        """The answers in the order of the digests; ``planes`` as in ``answered``."""
        out = np.zeros(len(self.bucket), kind)
        for b in np.flatnonzero(np.diff(self.cuts)).tolist():
            data = opened(answers[b])
            out[self.order[self.cuts[b] : self.cuts[b + 1]]] = unplaned(data, kind) if planes else np.frombuffer(data, kind)
        return out


def planed(numbers: np.ndarray) -> bytes:
    """All first bytes of the numbers, then all second ones and so on: small numbers leave long runs of zeros."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.dtype.itemsize).T.tobytes()


def unplaned(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind)[:, 0]


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def opened(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def columns(payload: bytes, kinds: list[type]) -> list[np.ndarray]:
    ends = np.cumsum(np.frombuffer(payload, "<u4", len(kinds)), dtype=np.int64) + 4 * len(kinds)
    return [np.frombuffer(opened(payload[a:b]), k) for k, a, b in zip(kinds, [4 * len(kinds), *ends[:-1].tolist()], ends.tolist())]


def asked(blocks: DataFrame, ask: Callable[[Block, dict], Iterator[tuple[int, bytes]]], answers: DataFrame | None = None) -> DataFrame:
    """What each block asks, given the answers to its former questions: rows of ASKED."""
    return with_answers(blocks, lambda block, got: _asked_rows(block, ask(block, got)), ASKED, answers)


def _asked_rows(block: Block, shares: Iterator[tuple[int, bytes]]) -> pa.Table:
    rows = list(shares)
    return pa.table(
        {"bucket": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([block.number] * len(rows), pa.int64()),
         "payload": pa.array([r[1] for r in rows], pa.binary())}
    )


def with_answers(blocks: DataFrame, run: Callable[[Block, dict], pa.Table], schema: str, answers: DataFrame | None = None) -> DataFrame:
    """``run`` on every block; its second argument has the answers by question and bucket."""
    if answers is None:

        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    yield from run(read(pa.Table.from_batches([batch.slice(i, 1)])), {}).to_batches()

        return blocks.mapInArrow(mapped, schema)

    def grouped(left: pa.Table, right: pa.Table) -> pa.Table:
        got: dict[int, dict[int, bytes]] = {}
        for q, b, p in zip(right.column("question").to_pylist(), right.column("bucket").to_pylist(), right.column("payload").to_pylist()):
            got.setdefault(q, {})[b] = p
        return run(read(left), got)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(grouped, schema)


def answered(
    questions: DataFrame, kinds: list[type], answer: Callable[..., np.ndarray], number: int,
    summary: Callable[..., list[int]] | None = None, planes: bool = False,
) -> tuple[DataFrame, list[list[int]]]:
    """Each bucket's answers, written once, and the buckets' summaries (a few numbers each).

    ``answer`` and ``summary`` get the columns of all blocks' digests in a bucket, then the block that each came from;
    ``answer`` returns one number per digest, which ``planes`` writes byte by byte. It may return a pair of them; the second ones are
    answers to the question ``-number``, so that a later step can go without.
    """

    def group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        parts = [columns(p, kinds) for p in rows.column("payload").to_pylist()]
        sizes = [len(p[0]) for p in parts]
        joined = [np.concatenate(c) for c in zip(*parts)]
        asker = np.repeat(np.arange(len(parts)), sizes)
        told = answer(*joined, asker)
        told = {number: told[0], -number: told[1]} if isinstance(told, tuple) else {number: told}
        bucket = rows.column("bucket")[0].as_py()
        out = [
            (block, squeezed(planed(x) if planes else x.tobytes()), question)
            for question, numbers in told.items()
            for block, x in zip(rows.column("block").to_pylist(), np.split(numbers, np.cumsum(sizes)[:-1]))
        ]
        if summary:
            out.append((-1, squeezed(np.array(summary(*joined, asker), np.int64).tobytes()), number))
        block, payload, question = zip(*out)
        return pa.table(
            {"block": pa.array(block, pa.int64()), "bucket": pa.array([bucket] * len(out), pa.int32()), "payload": pa.array(payload, pa.binary()),
             "question": pa.array(question, pa.int32())}
        )

    done = stored(questions.groupBy("bucket").applyInArrow(group, ANSWERED), f"answers-{number}")
    sums = [np.frombuffer(opened(bytes(r.payload)), np.int64).tolist() for r in done.where("block < 0").collect()] if summary else []
    return done.where("block >= 0"), sums
