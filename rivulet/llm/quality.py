"""Quality classifier: a byte-level convolutional network, trained and applied with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rivulet.llm.common import held_out, id_and_text, stored

SCHEMA = "id bigint, score double"


@dataclass(frozen=True)
class Shape:
    """``filters`` see ``width`` bytes, each as a learned vector of ``dims``. Chunks of ``chunk`` bytes begin every
    ``chunk - width + 1`` bytes, so every window of a filter lies within a chunk."""

    width: int = 6
    dims: int = 4
    filters: int = 12
    chunk: int = 512
    seed: int = 11


@dataclass(frozen=True)
class Training:
    """Bounds of the sample: ``rows`` labelled documents of each class, ``chunks`` chunks spread over each whole text."""

    rows: int = 1200
    chunks: int = 6
    epochs: int = 12
    batch: int = 128
    rate: float = 0.01


def chunked(data: np.ndarray, shape: Shape) -> np.ndarray:
    """The overlapping chunks of one text, filled with zero bytes."""
    step = shape.chunk - shape.width + 1
    count = max(1, -(-max(0, len(data) - shape.width + 1) // step))
    padded = np.zeros((count - 1) * step + shape.chunk, np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.as_strided(padded, (count, shape.chunk), (step, 1)).copy()


class Network:
    """bytes -> vectors -> filters -> maximum over the chunk -> chunk logit -> mean and extremes over the document."""

    def __init__(self, shape: Shape) -> None:
        self.shape = shape
        rng = np.random.default_rng(shape.seed)
        draw = lambda *size, scale: (rng.standard_normal(size) * scale).astype(np.float32)
        self.embed = draw(256, shape.dims, scale=0.5)
        self.kernel = draw(shape.width * shape.dims, shape.filters, scale=(shape.width * shape.dims) ** -0.5)
        self.bias = np.zeros(shape.filters, np.float32)
        self.out = draw(shape.filters, scale=shape.filters**-0.5)
        self.offset = np.zeros(1, np.float32)
        self.document = np.array([0.0, 1.0, 0.0, 0.0])  # intercept, mean, least and greatest chunk logit

    def _tables(self) -> np.ndarray:
        """What a byte at a place in the window adds to every filter: width x 256 x filters."""
        s = self.shape
        return np.einsum("bd,wdf->wbf", self.embed, self.kernel.reshape(s.width, s.dims, s.filters)).astype(np.float32)

    def pooled(self, chunks: np.ndarray, tables: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter in each chunk and where it was."""
        tables = self._tables() if tables is None else tables
        width, n = self.shape.width, chunks.shape[1] - self.shape.width + 1
        response = tables[0][chunks[:, :n]]
        for w in range(1, width):
            response += tables[w][chunks[:, w : w + n]]
        where = response.argmax(1)
        return np.take_along_axis(response, where[:, None, :], 1)[:, 0, :], where

    def most(self, chunks: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """As ``pooled``, without the places: 64 chunks at a time stay in the cache."""
        width, n = self.shape.width, chunks.shape[1] - self.shape.width + 1
        out = np.empty((len(chunks), self.shape.filters), np.float32)
        for at in range(0, len(chunks), 16):
            some = chunks[at : at + 16]
            response = tables[0].take(some[:, :n], axis=0)
            for w in range(1, width):
                response += tables[w].take(some[:, w : w + n], axis=0)
            out[at : at + 16] = response.max(1)
        return out

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.offset[0]

    def fit_chunks(self, chunks: np.ndarray, labels: np.ndarray, how: Training) -> None:
        """Adam on the chunks, each with its document's label; the gradient goes to the place of each maximum."""
        s, rng = self.shape, np.random.default_rng(self.shape.seed + 1)
        weights = [self.embed, self.kernel, self.bias, self.out, self.offset]
        first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        span = np.arange(s.width)
        for _ in range(how.epochs):
            order = rng.permutation(len(chunks))
            for at in range(0, len(order), how.batch):
                pick = order[at : at + how.batch]
                x, y = chunks[pick], labels[pick]
                top, where = self.pooled(x)
                active = np.maximum(top + self.bias, 0)
                error = (1 / (1 + np.exp(-(active @ self.out + self.offset[0]))) - y).astype(np.float32) / len(pick)
                back = (error[:, None] * self.out) * (active > 0)
                seen = x[np.arange(len(x))[:, None, None], where[:, :, None] + span]  # chunk, filter, place
                vectors = self.embed[seen].reshape(len(x), s.filters, -1)
                kernel = np.einsum("cf,cfk->kf", back, vectors)
                inner = np.einsum("cf,kf->cfk", back, self.kernel).reshape(-1, s.dims)
                embed = np.zeros_like(self.embed)
                np.add.at(embed, seen.reshape(-1), inner)
                t += 1
                for w, g, a, b in zip(weights, [embed, kernel, back.sum(0), active.T @ error, error.sum(keepdims=True)], first, second):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    w -= how.rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-7)

    def fit_documents(self, features: np.ndarray, labels: np.ndarray, prior: float, steps: int = 200) -> None:
        """Logistic regression on mean, least and greatest chunk logit by Newton's method; ``prior`` is the log odds of
        the classes in all rows over those in the sample."""
        x = np.column_stack([np.ones(len(features)), features])
        w = np.array([0.0, 1.0, 0.0, 0.0])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (p - labels) + 1e-1 * w
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-1 * np.eye(4), gradient)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.document = w + np.array([prior, 0, 0, 0])

    def score(self, features: np.ndarray) -> np.ndarray:
        x = np.column_stack([np.ones(len(features)), features])
        return 1 / (1 + np.exp(-np.clip(x @ self.document, -30, 30)))


def _features(network: Network, texts: list[bytes]) -> np.ndarray:
    """Mean, least and greatest chunk logit of each whole text."""
    tables, out = network._tables(), []
    pending, sizes, room = [], [], 0

    def flush() -> None:
        nonlocal pending, sizes, room
        if sizes:
            z = network.logits(network.most(np.concatenate(pending), tables)).astype(np.float64)
            at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            out.append(np.column_stack([np.add.reduceat(z, at) / sizes, np.minimum.reduceat(z, at), np.maximum.reduceat(z, at)]))
        pending, sizes, room = [], [], 0

    for text in texts:
        chunks = chunked(np.frombuffer(text, np.uint8), network.shape)
        pending.append(chunks)
        sizes.append(len(chunks))
        room += len(chunks)
        if room >= 4096:
            flush()
    flush()
    return np.concatenate(out) if out else np.zeros((0, 3))


def _by_batch(batches: Iterator[pa.RecordBatch], network: Network, kind: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [batch.column(0)]
        f = _features(network, [x.as_py().encode() for x in batch.column(1)])
        if kind == "score":
            yield pa.RecordBatch.from_arrays([*kept, pa.array(network.score(f))], [batch.schema.names[0], "score"])
        else:
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(f[:, i]) for i in range(3))], ["id", "mean", "least", "greatest"])


def _drawn(batches: Iterator[pa.RecordBatch], shape: Shape, most: int) -> Iterator[pa.RecordBatch]:
    """Up to ``most`` chunks of each text, evenly spread over all of it."""
    for batch in batches:
        ids, out = [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            chunks = chunked(np.frombuffer(text.as_py().encode(), np.uint8), shape)
            for k in np.unique(np.linspace(0, len(chunks) - 1, min(most, len(chunks))).round().astype(int)):
                ids.append(i)
                out.append(chunks[k].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["id", "chunk"])


def fitted(
    docs: DataFrame, labels: DataFrame, shape: Shape = Shape(), how: Training = Training(),
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Network | None:
    """A network that has learned from a bounded sample of the labelled rows (``how.rows`` of each class, chosen by hash).

    The chunk network learns on chunks spread over the whole texts of the sample, then the document level on all of their
    chunks. What reaches the driver is bounded by the sample: rows * 2 * chunks chunks and three numbers a row. None
    without labels. Documents whose labels disagree and null labels or ids are left out; of the texts of a repeated id the least one is learned from.
    """
    known = (
        labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .dropna()
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where(F.col("label") == F.col("most"))
    )
    known = stored(known.select("id", "label"), "quality-labels")
    counts = {r.label: r["count"] for r in known.where("label in (0, 1)").groupBy("label").count().collect()}
    if not counts:
        return None
    picked = None
    for label in counts:
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(how.rows)
        picked = some if picked is None else picked.unionByName(some)
    # at most 2 * how.rows rows of two numbers
    sample = id_and_text(docs, id_col, text_col).join(F.broadcast(stored(picked, "quality-picked")), "id")
    sample = stored(sample.groupBy("id", "label").agg(F.min("text").alias("text")), "quality-sample")
    label_of = {r.id: float(r.label) for r in sample.select("id", "label").collect()}
    if not label_of:
        return None
    network = Network(shape)
    texts = sample.select("id", "text")
    drawn = texts.mapInArrow(lambda b: _drawn(b, shape, how.chunks), "id bigint, chunk binary").toArrow()
    ids = drawn["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    chunks = np.frombuffer(b"".join(x.as_py() for x in drawn["chunk"]), np.uint8).reshape(-1, shape.chunk)[order]
    network.fit_chunks(chunks, np.array([label_of[i] for i in ids[order].tolist()], np.float32), how)
    f = texts.mapInArrow(lambda b: _by_batch(b, network, "features"), "id bigint, mean double, least double, greatest double").toPandas()
    f = f.sort_values("id")
    y = np.array([label_of[i] for i in f["id"]])
    odds = lambda good, bad: np.log((good + 0.5) / (bad + 0.5))
    prior = odds(counts.get(1, 0), counts.get(0, 0)) - odds((y == 1).sum(), (y == 0).sum())
    network.fit_documents(f[["mean", "least", "greatest"]].to_numpy(), y, prior)
    return network


def scored(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``score`` (0 to 1; higher: label 1 likelier) of each whole text, one row per row of ``docs``.

    Null text: empty; an empty text is one chunk of zero bytes. Without a network every score is 0.5. Null ids and
    repeated rows each get their score. A task holds one Arrow batch and 4096 chunks at a time.
    """
    rows = id_and_text(docs, id_col, text_col)
    if network is None:
        return rows.select("id", F.lit(0.5).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(network)
    return rows.mapInArrow(lambda b: _by_batch(b, sent.value, "score"), SCHEMA)


def accepted(docs: DataFrame, network: Network | None, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``least`` or more."""
    if network is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(network)
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("score", T.DoubleType())])
    done = rows.mapInArrow(lambda b: _by_batch(b, sent.value, "score"), schema)
    return done.where(F.col("score") >= least).select("row.*")


def classified(
    docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, shape: Shape = Shape(), how: Training = Training(),
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; learns only from labelled rows outside the fold.

    Nulls, empty texts and repeated rows as in ``scored``; long texts are scored whole, equal texts equally. Empty table: no rows;
    without labels all scores are 0.5. Extra columns of any name play no part.
    """
    network = fitted(docs, labels.where(~held_out(F.col("doc_id"), folds, fold)), shape, how)
    return scored(docs, network).select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id"), folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
